"""Strict pairing of two passes: a full outer join whose unmatched sides are counted, not dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vantagrid.errors import PairingRefused

#: Unmatched indices that a refusal names.
LISTED = 5


def paired(left: DataFrame, right: DataFrame, group: list[str], index: str) -> DataFrame:
    """``left`` and ``right`` (group, index, path) as (group, index, left_path, right_path); a side without partner is null."""
    a = left.select(*group, index, F.col("path").alias("left_path"))
    b = right.select(*group, index, F.col("path").alias("right_path"))
    return a.join(b, [*group, index], "full_outer")


def pairing_report(pairs: DataFrame, group: list[str], index: str) -> DataFrame:
    """For each group: pairs, frames without right or left partner, and the first few of each."""
    no_right, no_left = F.col("right_path").isNull(), F.col("left_path").isNull()
    counts = pairs.groupBy(*group).agg(
        F.count_if(~no_right & ~no_left).alias("n_pairs"),
        F.count_if(no_right).alias("n_missing_right"),
        F.count_if(no_left).alias("n_missing_left"),
    )
    side = F.when(no_right, "right").otherwise("left")
    lone = pairs.where(no_right | no_left).withColumn("__side", side)
    place = F.row_number().over(Window.partitionBy(*group, "__side").orderBy(index))
    few = lone.withColumn("__place", place).where(F.col("__place") <= LISTED).withColumn("__name", F.col(index).cast("string"))

    def named(s: str):
        rows = F.collect_list(F.when(F.col("__side") == s, F.struct("__place", "__name")))
        return F.array_join(F.transform(F.array_sort(rows), lambda r: r["__name"]), ",").alias(f"first_missing_{s}")

    names = few.groupBy(*group).agg(named("right"), named("left"))
    return counts.join(names, group, "left").na.fill("", ["first_missing_right", "first_missing_left"])


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_paired(pairs: DataFrame, what: str) -> None:
    r = pairs.withColumn("g", F.lit(0))
    bad = pairing_report(r, ["g"], "frame_index").first()
    if bad is None:
        raise PairingRefused(f"{what}: no frames")
    parts = []
    for n, names, side in ((bad.n_missing_right, bad.first_missing_right, "mask"), (bad.n_missing_left, bad.first_missing_left, "normal")):
        if n:
            parts.append(f"{n} frames lack a {side} render, first {names}")
    if parts:
        raise PairingRefused(f"{what}: " + "; ".join(parts))
