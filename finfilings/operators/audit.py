"""Expected against landed files.

The expected grid is small and its size measured; the landed list may be huge.  It
is first cut down to expected names (a broadcast semi join when the grid is small),
then reduced to one row per name before anything is joined to the grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finfilings.functions.names import plain_file_name
from finfilings.session import settle, small_side
from finfilings.vocab import LANDING_SUFFIXES


def landed_names(files: DataFrame) -> DataFrame:
    """Landed files under their plain upper-case names."""
    return files.withColumn("name_key", F.upper(plain_file_name(F.col("file_name"))))


def _name_key(grid: DataFrame) -> DataFrame:
    return settle(grid.withColumn("name_key", F.upper(plain_file_name(F.col("expected_name")))))


def landing_audit(grid: DataFrame, files: DataFrame) -> DataFrame:
    """Each expected file with ``present``."""
    expected = _name_key(grid)
    wanted = small_side(expected.select("name_key").distinct())
    found = (
        landed_names(files).join(wanted, "name_key", "left_semi").select("name_key").distinct()
    ).withColumn("found", F.lit(True))
    return expected.join(found, "name_key", "left").select(
        *grid.columns, F.coalesce("found", F.lit(False)).alias("present")
    )


def missing_files(grid: DataFrame, files: DataFrame) -> DataFrame:
    return landing_audit(grid, files).where("NOT present").drop("present")


def suffix_rank(suffix: Column) -> Column:
    """Place of a suffix in the order of preference; unknown suffixes come last."""
    order = F.array(*[F.lit(s) for s in LANDING_SUFFIXES])
    at = F.array_position(order, F.upper(suffix))
    return F.when(at > 0, at).otherwise(len(LANDING_SUFFIXES) + 1).cast("int")


def choose_variant(files: DataFrame, keys=("period", "institution")) -> DataFrame:
    """The file to use for each period: the usable variant of best suffix, else the
    name of the first variant.

    ``files`` has the keys and ``file_name, suffix, usable``.  One partial aggregate;
    a period with many copies is reduced before the shuffle.
    """
    rank = suffix_rank(F.col("suffix"))
    best = F.min(F.when(F.col("usable"), F.struct(rank.alias("rank"), F.col("file_name"))))
    first = F.concat(*[F.col(k) if i == 0 else F.concat(F.lit("_"), F.col(k)) for i, k in enumerate(keys)])
    chosen = files.groupBy(*keys).agg(best.alias("best"), F.count("*").alias("n_variants"))
    return chosen.select(
        *keys,
        F.coalesce("best.file_name", F.concat(first, F.lit(LANDING_SUFFIXES[0]))).alias("file_name"),
        F.col("best").isNotNull().alias("usable"),
        "n_variants",
    )


def landing_report(grid: DataFrame, files: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """One row per expected file: did it land, with what status, and a note.

    ``files`` has ``file_name`` and optionally ``status`` and ``existed`` (landed before
    this run).  Success takes a status of 200, or presence before the fetch; a file
    without any status counts as present.  ``rejects`` (``file_name, reason``) turn a
    landed file into a failure.
    """
    expected = _name_key(grid)
    wanted = small_side(expected.select("name_key").distinct())
    landed = landed_names(files)
    status = F.col("status") if "status" in files.columns else F.lit(None).cast("int")
    existed = F.col("existed") if "existed" in files.columns else status.isNull()
    landed = (
        landed.join(wanted, "name_key", "left_semi")
        .groupBy("name_key")
        .agg(
            F.min("file_name").alias("file_name"),
            F.max(F.when(existed | (status == 200), 1).otherwise(0)).alias("ok"),
            F.max(existed.cast("int")).alias("existed"),
            F.min(F.when(status == 200, F.lit(0)).otherwise(status)).alias("bad_status"),
            F.max(F.when(status == 200, status)).alias("good_status"),
        )
    )
    out = expected.join(landed, "name_key", "left")
    reason = F.lit(None).cast("string")
    if rejects is not None:
        bad = (
            landed_names(rejects)
            .join(wanted, "name_key", "left_semi")
            .groupBy("name_key")
            .agg(F.min("reason").alias("reject_reason"))
        )
        out = out.join(bad, "name_key", "left")
        reason = F.col("reject_reason")
    final = F.coalesce("good_status", "bad_status")
    success = F.coalesce(F.col("ok") == 1, F.lit(False)) & reason.isNull()
    error = (
        F.when(reason.isNotNull(), reason)
        .when(F.col("file_name").isNull(), F.lit("not landed"))
        .when((F.col("existed") == 1) & final.isNull(), F.lit("landed earlier and kept"))
        .when(~success, F.concat(F.lit("status "), final.cast("string")))
    )
    return out.select(
        *grid.columns, "file_name", success.alias("success"), final.alias("status"), error.alias("error")
    )
