"""Operators over runs: splits, comparability, leaks, hold-outs, counts, pruning, sky audit."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vantagrid.functions import text

# The neighbourhood audit's reach and limits, in rows, hours and blue-red units.
NEIGHBOURS, SUSPICIOUS, FLAT, SAME_HOUR, AGREES = 5, 15.0, 5.0, 0.15, 5.0
# The draw of a stratified hold-out.
DRAW_SEED = 20260728


def gathered(wanted: DataFrame, key: str, documents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``wanted`` with a struct column for each kind of document (frame, its key column): null where a row has none."""
    out = wanted
    for name, (rows, own) in documents.items():
        held = rows.select(F.col(own).alias(f"__{name}"), F.struct("*").alias(name))
        out = out.join(held, F.col(key) == F.col(f"__{name}"), "left").drop(f"__{name}")
    return out


def first_problem(*checks: tuple[Column, Column | str]) -> Column:
    """What the first check that holds says; null if none does."""
    return F.coalesce(*[F.when(holds, F.lit(says) if isinstance(says, str) else says) for holds, says in checks])


def split_subsets(runs: DataFrame, val: DataFrame, key: str) -> DataFrame:
    """``runs`` with ``subset``: val for those that ``val`` (key) names, else train."""
    held = val.select(F.col(key).alias("__held")).distinct()
    out = runs.join(held, runs[key] == held["__held"], "left")
    return out.withColumn("subset", F.when(F.col("__held").isNotNull(), "val").otherwise("train")).drop("__held")


def unknown_members(named: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``named`` whose key ``known`` does not have."""
    return named.join(known.select(key).distinct(), key, "left_anti")


def comparability(rows: DataFrame, under: Column, key: str) -> DataFrame:
    """(under, n, first): how many rows carry each setting, and the least key of them."""
    return rows.groupBy(under.alias("setting")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))


def scene_leaks(rows: DataFrame, scene: str, key: str) -> DataFrame:
    """Scenes on both sides of the split: (scene, n_train, n_val, first_train, first_val)."""
    train, val = F.col("subset") == "train", F.col("subset") == "val"
    sides = rows.groupBy(scene).agg(
        F.count_if(train).alias("n_train"),
        F.count_if(val).alias("n_val"),
        F.min(F.when(train, F.col(key))).alias("first_train"),
        F.min(F.when(val, F.col(key))).alias("first_val"),
    )
    return sides.where("n_train > 0 AND n_val > 0")


def subset_totals(rows: DataFrame, key: str, size: Column) -> DataFrame:
    """(subset, runs, frames) of rows that carry a subset."""
    return rows.groupBy("subset").agg(F.count_distinct(key).alias("runs"), F.sum(size).alias("frames"))


def hashed_holdout(members: DataFrame, strata: list[str], key: str, want: Column) -> DataFrame:
    """``want`` members of each stratum, in the order of a hash of stratum and key: blind, and stable under new strata."""
    order = F.md5(F.concat_ws("|", *strata, F.col(key).cast("string")))
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy(order, key))
    return members.withColumn("draw", rank).where(F.col("draw") <= want).drop("draw")


def drawn_holdout(groups: dict[tuple[str, str], list[str]], recession: int, crossing: int) -> list[tuple[str, str, str]]:
    """The published draw: one seeded generator over the strata in order; a driver function over run names."""
    draw, out = random.Random(DRAW_SEED), []
    for (preset, kind), members in sorted(groups.items()):
        want = recession if kind == "recession" else crossing
        out += [(run, preset, kind) for run in draw.sample(sorted(members), min(want, len(members)))]
    return sorted(out)


def matching_seed(runs: DataFrame, prefix: str, key: str = "run_id") -> DataFrame:
    """Runs whose last part has five characters and begins with ``prefix``."""
    tail = text.seed_suffix(F.col(key))
    return runs.where((F.length(tail) == 5) & tail.startswith(prefix))


def kth_of_each(rows: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """The row at place k (from 0) of each group, or its last where it has fewer."""
    window = Window.partitionBy(group).orderBy(*order)
    every = Window.partitionBy(group)
    placed = rows.withColumn("__at", F.row_number().over(window)).withColumn("__n", F.count(F.lit(1)).over(every))
    return placed.where(F.col("__at") == F.least(F.lit(k + 1), F.col("__n"))).drop("__at", "__n")


def top_with_ties(rows: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """Rows at least as large as the k-th largest of their group, with their rank."""
    window = Window.partitionBy(group).orderBy(F.desc(value))
    return rows.withColumn("rank", F.rank().over(window)).where(F.col("rank") <= k)


def prefix_counts(keys: DataFrame, prefix: Column) -> DataFrame:
    """(prefix, n) of the keys that have one."""
    return keys.select(prefix.alias("prefix")).where("prefix <> ''").groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))


def owned_keys(keys: DataFrame, runs: DataFrame) -> DataFrame:
    """The distinct keys that the named runs own: the run is read off the key, so the join is on equality."""
    owned = keys.withColumn("run_id", text.run_of_owned_key(F.col("key"))).where("run_id IS NOT NULL")
    return owned.join(runs.select("run_id").distinct(), "run_id", "left_semi").select("run_id", "key").distinct()


def object_counts(keys: DataFrame, runs: DataFrame, frames: int, extra: int = 0) -> DataFrame:
    """(run_id, raw, dataset, qc, complete): objects of each named run against what a run of so many frames owns."""
    owned = keys.select(text.run_of_owned_key(F.col("key")).alias("run_id"), F.substring_index("key", "/", 1).alias("area"))
    counted = owned.groupBy("run_id").agg(*[F.count_if(F.col("area") == a).alias(n) for a, n in (("raw", "raw"), ("datasets", "dataset"), ("qc", "qc"))])
    out = runs.select("run_id").distinct().join(counted, "run_id", "left").na.fill(0, ["raw", "dataset", "qc"])
    want = (F.col("raw") == 2 * frames + 2) & (F.col("dataset") == 2 + extra) & (F.col("qc") == frames + 1)
    return out.withColumn("complete", want)


def _middle(values: Column) -> Column:
    """Median of an array of numbers; null of an empty one."""
    s = F.array_sort(values)
    n = F.size(s)
    low, high = F.floor((n + 1) / 2).cast("int"), F.floor(n / 2).cast("int") + 1
    return F.when(n > 0, (F.try_element_at(s, low) + F.try_element_at(s, high)) / 2)


def neighbour_medians(rows: DataFrame, order: list[str], value: str, reach: int = NEIGHBOURS) -> DataFrame:
    """``rows`` with expected (median of the neighbours in order, without the row itself), off, and testable.

    One row a run, put in one order; a corpus of runs is small beside its frames.
    """
    window = Window.orderBy(*order)
    before = F.collect_list(value).over(window.rowsBetween(-reach, -1))
    after = F.collect_list(value).over(window.rowsBetween(1, reach))
    out = rows.withColumn("__others", F.concat(before, after)).withColumn("expected", _middle(F.col("__others")))
    spread = _middle(F.transform("__others", lambda v: F.abs(v - F.col("expected"))))
    return out.withColumn("off", F.col(value) - F.col("expected")).withColumn("testable", F.coalesce(spread < FLAT, F.lit(False))).drop("__others")


def twins(rows: DataFrame, key: str, at: str, value: str, near: float = SAME_HOUR, agrees: float = AGREES) -> DataFrame:
    """(key, twin): for each row the first other one, by (at, key), close in both ``at`` and ``value``.

    A band join as an equality join: rows fall into bins as wide as the band, and
    each is looked for in its own bin and the two beside it.
    """
    bins = rows.select(F.col(key).alias("k"), F.col(at).alias("a"), F.col(value).alias("v"), F.floor(F.col(at) / near).cast("long").alias("bin"))
    wide = bins.withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    other = bins.select(F.col("k").alias("twin"), F.col("a").alias("ta"), F.col("v").alias("tv"), "bin")
    close = (F.col("k") != F.col("twin")) & (F.abs(F.col("a") - F.col("ta")) < near) & (F.abs(F.col("v") - F.col("tv")) < agrees)
    found = wide.join(other, "bin").where(close).groupBy("k").agg(F.min_by("twin", F.struct("ta", "twin")).alias("twin"))
    return found.withColumnRenamed("k", key)


def nearest(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, nearest): the other row whose value is closest, ties to the least key.

    Along the order of values the closest are the neighbours; equal values are one
    step of that order, so no row is compared with all others.
    """
    steps = rows.groupBy(F.col(value).alias("v")).agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
    second = rows.join(steps, rows[value] == steps["v"]).where(F.col(key) != F.col("first")).groupBy("v").agg(F.min(key).alias("second"))
    order = Window.orderBy("v")
    steps = steps.join(second, "v", "left")
    for side, shift in (("below", 1), ("above", -1)):
        steps = steps.withColumn(side, F.struct(F.lag("v", shift).over(order).alias("v"), F.lag("first", shift).over(order).alias("first")))
    down, up = F.col("v") - F.col("below.v"), F.col("above.v") - F.col("v")
    beside = (
        F.when(up.isNull() | (down < up), F.col("below.first"))
        .when(down.isNull() | (up < down), F.col("above.first"))
        .otherwise(F.least("below.first", "above.first"))
    )
    steps = steps.select("v", "first", "second", beside.alias("beside"))
    out = rows.join(steps, rows[value] == steps["v"])
    same = F.when(F.col(key) != F.col("first"), F.col("first")).otherwise(F.col("second"))
    return out.select(key, F.coalesce(same, "beside").alias("nearest"))


def sky_verdicts(rows: DataFrame) -> DataFrame:
    """(run_id, ..., verdict) of rows (run_id, place, tod, tint): ok, corroborated, wrong or unclear."""
    audited = neighbour_medians(rows, ["tod", "place"], "tint").join(twins(rows, "run_id", "tod", "tint"), "run_id", "left")
    verdict = (
        F.when(F.coalesce(F.abs("off") <= SUSPICIOUS, F.lit(True)), "ok")
        .when(F.col("twin").isNotNull(), "corroborated")
        .when(F.col("testable"), "wrong")
        .otherwise("unclear")
    )
    return audited.withColumn("verdict", verdict)
