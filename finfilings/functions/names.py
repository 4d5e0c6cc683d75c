"""Column names and file names."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words for the two signs that carry meaning in a column name.
SIGN_WORDS = {"#": "_number_", "%": "_percent_"}

# Fixed value: YYYYMM, type, extension.
FILE_NAME = r"(?i)^(\d{6})(.*)\.(csv|xlsx|xls)$"


def clean_name(name: str) -> str:
    """One column name in snake case, plain ASCII."""
    text = name.replace("'", "").replace('"', "")
    for sign, word in SIGN_WORDS.items():
        text = text.replace(sign, word)
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^A-Za-z0-9]+", "_", text).strip("_").lower()
    if not text or text[0].isdigit():
        text = "x" + text
    return text


def unique_names(names) -> list[str]:
    """Later copies of a name get _2, _3, …"""
    taken: set[str] = set()
    out = []
    for name in names:
        candidate, n = name, 1
        while candidate in taken:
            n += 1
            candidate = f"{name}_{n}"
        taken.add(candidate)
        out.append(candidate)
    return out


def clean_names(df: DataFrame) -> DataFrame:
    """The same table under clean, unique column names."""
    return df.toDF(*unique_names(clean_name(n) for n in df.columns))


def rename_matching(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """For each pattern, rename the first column that matches it (any case)."""
    names = list(df.columns)
    for pattern, target in rules.items():
        for i, name in enumerate(df.columns):
            if re.search(pattern, name, re.IGNORECASE):
                names[i] = target
                break
    return df.toDF(*names)


def drop_listed(df: DataFrame, names) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*names)


def require_columns(df: DataFrame, names) -> DataFrame:
    """Fail at analysis time if a column is missing, naming all that are."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError("missing required columns: " + ", ".join(missing))
    return df


def base_name(c: Column) -> Column:
    """Last part of a path."""
    return F.substring_index(c, "/", -1)


def plain_file_name(c: Column) -> Column:
    """File name without folders and underscores; the input files keep theirs."""
    return F.translate(base_name(c), "_", "")


def file_period(c: Column) -> Column:
    """YYYYMM of a conforming file name, else NULL."""
    return F.nullif(F.regexp_extract(c, FILE_NAME, 1), F.lit(""))


def file_type(c: Column) -> Column:
    """Institution type of a conforming file name, else NULL."""
    return F.when(c.rlike(FILE_NAME), F.upper(F.regexp_extract(c, FILE_NAME, 2)))


def is_type_file(c: Column, inst_type: str) -> Column:
    """Is this the CSV of the given type, in any case?"""
    return c.rlike(r"(?i)^\d{6}" + re.escape(inst_type) + r"\.CSV$")


def file_of_period(period: Column, inst_type: Column, suffix: str) -> Column:
    return F.concat(period, F.lit("_"), inst_type, F.lit(suffix))


def safe_name(c: Column) -> Column:
    """A name that is safe inside a path."""
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_")
