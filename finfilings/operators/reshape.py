"""Long to wide and back, per-type views, load summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finfilings.operators.numbering import number_rows

#: Up to this many names a pivot is written as conditional aggregates.
NARROW = 50
#: About so many names share one map of a wider pivot, so that a cell is found among few.
MAP_NAMES = 64


def distinct_values(df: DataFrame, name: str, max_values: int = 10_000) -> list:
    """Sorted distinct non-NULL values of a vocabulary column, checked to be one."""
    rows = (
        df.where(F.col(name).isNotNull()).select(name).distinct().orderBy(name).limit(max_values + 1).collect()
    )
    if len(rows) > max_values:
        raise ValueError(f"{name} has more than {max_values} values; pass the wanted ones instead")
    return [r[0] for r in rows]


def duplicate_cells(df: DataFrame, ids, names_from: str) -> DataFrame:
    """Cells of the wide table that several rows claim."""
    return df.groupBy(*ids, names_from).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def pivot_wide(
    df: DataFrame,
    ids,
    names_from: str = "conta",
    values_from: str = "saldo",
    values=None,
    on_duplicate: str = "error",
    names=None,
) -> DataFrame:
    """One row per ``ids``, one column per value of ``names_from``; absent cells NULL.

    ``values`` lists the wanted names (default: all, sorted), ``names`` their column
    names.  Rows that claim the same cell are settled by ``on_duplicate``:

    * ``error`` – fail, naming the cell (the default),
    * ``sum`` – add them up,
    * ``first`` – the smallest value,
    * ``rows`` – keep them all: a wide row per copy, numbered by ``copy``.

    Up to ``NARROW`` names the cells are conditional aggregates: one shuffle of
    partially aggregated rows, so a hot institution arrives as one row per task.  More
    names are reduced to one row per cell first; the cells of a row then travel as maps of
    what is there, so that no task holds rows of all columns.
    """
    ids = list(ids)
    if values is None:
        values = distinct_values(df, names_from)
    names = list(names or [str(v) for v in values])
    value = F.col(f"`{values_from}`")

    if on_duplicate == "rows":
        return _pivot_copies(df, ids, names_from, values_from, values, names)
    if on_duplicate not in ("error", "sum", "first"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")

    if len(values) <= NARROW:
        cells = [_settled(ids, names_from, v, value, on_duplicate).alias(n) for v, n in zip(values, names)]
        return df.groupBy(*ids).agg(*cells) if cells else df.select(*ids).distinct()

    reduce = F.sum(value) if on_duplicate == "sum" else F.min(value)
    # unwanted names stay as a null one: they keep the row of their ids and claim no cell
    wanted = F.when(F.col(f"`{names_from}`").isin(list(values)), F.col(f"`{names_from}`"))
    cell = df.withColumn(names_from, wanted).groupBy(*ids, names_from).agg(reduce.alias("_v"), F.count("*").alias("_n"))
    v = F.col("_v")
    if on_duplicate == "error":
        v = F.when((F.col("_n") > 1) & F.col(f"`{names_from}`").isNotNull(), _refuse([*ids, names_from])).otherwise(v)
    return _pivot_maps(cell.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(ids)], F.col(f"`{names_from}`").alias("_name"), v.alias("_v")), ids, values, names)


def _pivot_maps(cell: DataFrame, ids, values, names) -> DataFrame:
    """Wide rows out of unique cells ``_k0, …, _name, _v``.

    Cells are brought together by row before they are collected, so the aggregate sorts
    narrow rows; names are dealt over maps by their hash and looked up there.
    """
    keys = [f"_k{i}" for i in range(len(ids))]
    kind, n = cell.schema["_name"].dataType, -(-len(values) // MAP_NAMES)
    map_of = lambda name: F.pmod(F.hash(name), F.lit(n))
    there = F.when(F.col("_name").isNotNull(), F.struct("_name", "_v"))
    rows = (cell.repartition(*keys) if keys else cell).groupBy(*keys).agg(F.collect_list(there).alias("_cells"))
    dealt = lambda m: F.map_from_entries(F.filter("_cells", lambda x: map_of(x["_name"]) == m))
    maps = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), dealt)
    # behind a generator the maps are made once, however many columns look into them
    rows = rows.select(*keys, F.explode(F.array(maps)).alias("_maps"))
    wanted = [F.lit(v).cast(kind) for v in values]
    found = [F.try_element_at(F.get("_maps", map_of(v)), v).alias(name) for v, name in zip(wanted, names)]
    return rows.select(*[F.col(k).alias(c) for k, c in zip(keys, ids)], *found)


def _settled(ids, names_from: str, name, value: Column, on_duplicate: str) -> Column:
    """One cell of a narrow pivot as a conditional aggregate."""
    claimed = _cell(names_from, name, value)
    if on_duplicate == "sum":
        return F.sum(claimed)
    if on_duplicate == "first":
        return F.min(claimed)
    copies = F.count_if(F.col(f"`{names_from}`") == F.lit(name))
    return F.when(copies > 1, _refuse(ids, F.lit(name))).otherwise(F.min(claimed))


def _refuse(names, *more: Column) -> Column:
    """Fail with the key of a cell that several rows claim."""
    key = F.concat_ws(" / ", *[F.col(f"`{c}`").cast("string") for c in names], *[m.cast("string") for m in more])
    return F.raise_error(F.concat(F.lit("several rows for one cell: "), key))


def _cell(names_from: str, name, value: Column) -> Column:
    return F.when(F.col(f"`{names_from}`") == F.lit(name), value)


def _pivot_copies(df, ids, names_from, values_from, values, names):
    """Wide rows with every copy kept: column ``x`` holds a value, ``x_n`` its count.

    Equal values of a cell are counted first.  The distinct values are numbered
    through one parallel sort of the whole table, so even a cell that holds a third
    of all rows is spread over tasks.
    """
    cell = [*ids, names_from]
    distinct = df.groupBy(*cell, values_from).agg(F.count("*").alias("_n"))
    numbered = number_rows(distinct, [*cell, values_from], "_row")
    first = numbered.groupBy(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(cell)]).agg(
        F.min("_row").alias("_first")
    )
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(cell)]
    placed = numbered.join(first, same).select(
        *cell, values_from, "_n", (F.col("_row") - F.col("_first") + 1).alias("copy")
    )
    cells = []
    for v, n in zip(values, names):
        cells.append(F.max(_cell(names_from, v, F.col(f"`{values_from}`"))).alias(n))
        cells.append(F.max(_cell(names_from, v, F.col("_n"))).alias(f"{n}_n"))
    return placed.groupBy(*ids, "copy").agg(*cells)


def unpivot_long(df: DataFrame, ids, names_to: str = "conta", values_to: str = "saldo", columns=None) -> DataFrame:
    """Wide back to long; NULL cells give no row."""
    ids = list(ids)
    columns = columns or [c for c in df.columns if c not in ids]
    return df.unpivot(ids, columns, names_to, values_to).where(F.col(values_to).isNotNull())


def split_by_type(df: DataFrame, name: str = "inst_type", values=None) -> dict[str, DataFrame]:
    """One lazy view per value of a type column."""
    values = distinct_values(df, name) if values is None else list(values)
    return {v: df.where(F.col(name) == v) for v in values}


def distinct_types(df: DataFrame, name: str, alias: str = "inst_type") -> DataFrame:
    """Distinct values of a type column, in upper case."""
    return df.select(F.upper(F.col(name)).alias(alias)).distinct()


def filter_document(df: DataFrame, document: int, name: str = "documento") -> DataFrame:
    """Rows of one document; rows without a document number drop out."""
    return df.where(F.col(name) == document)


def document_counts(df: DataFrame, document: int, type_col: str = "inst_type", name: str = "documento") -> DataFrame:
    """Rows of the document per type, zero for the types that have none."""
    hit = F.count_if(F.col(name) == document)
    return df.groupBy(type_col).agg(hit.alias("n_rows"), (hit == 0).alias("is_empty"))


def load_summary(df: DataFrame, institution: str = "cnpj", inst_type: str | None = "tipo_instituicao") -> DataFrame:
    """Total rows, distinct institutions, distinct types.

    Each distinct count reduces its own (key) pairs, so a hot key is one pair.
    """
    types = F.count_distinct(inst_type) if inst_type else F.lit(None).cast("bigint")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(institution).alias("n_institutions"),
        types.alias("n_types"),
    )


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; a column a table lacks is NULL, columns in first-seen order."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out
