"""Plans are what they should be: columns pruned, filters pushed, hot paths in the JVM."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from vantagrid.operators import runs
from vantagrid.plans import queries
from vantagrid.sources.store import read_bytes, write_bytes
from vantagrid.workspace import shared_path

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def columns_read(df):
    """Columns of each scan, by table."""
    text = df._jdf.queryExecution().optimizedPlan().toString() + plan(df)
    return [set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<([^>]*)", text)]


@pytest.mark.parametrize(
    "name,wanted",
    [
        ("split_by_group", {"source"}),
        ("comparability_groups", {"p_brand", "p_type", "p_partkey"}),
        ("topk_with_ties", {"l_suppkey", "l_quantity"}),
        ("corpus_rollup", {"l_orderkey", "l_quantity"}),
        ("json_props", {"event_type", "props"}),
        ("kth_per_group", {"l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, wanted):
    for read in columns_read(queries.QUERIES[name](spark, DATA)):
        assert read <= wanted


@pytest.mark.parametrize("name", ["pair_full_outer", "gather_join", "scene_leak", "twin_band_join", "neighbour_median", "prune_semi_join", "flag_histogram"])
def test_no_products_of_tables(spark, name):
    text = plan(queries.QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["split_by_group", "scene_leak", "gather_join", "kth_per_group", "stratified_holdout", "object_counts", "nearest_row", "sky_verdicts"])
def test_relational_queries_stay_in_the_jvm(spark, name):
    assert not re.search("Python|Pandas|MapInArrow", plan(queries.QUERIES[name](spark, DATA)))


def test_filters_reach_the_scan(spark):
    lines = queries.table(spark, DATA, "lineitem")
    text = plan(runs.top_with_ties(lines.where(F.col("l_quantity") > 40), "l_suppkey", "l_quantity", 3))
    assert "GreaterThan(l_quantity,40.0)" in text


def test_counts_are_summed_before_they_are_shuffled(spark):
    text = plan(runs.prefix_counts(queries.table(spark, DATA, "pages").select(F.col("url").alias("key")), F.substring("key", 1, 9)))
    assert text.index("partial_count") > text.index("Exchange")  # the partial sum stands below the exchange


@pytest.mark.parametrize("shape", ["{}", "file:{}", "file://{}/"])
def test_shared_folder_with_and_without_a_scheme(spark, tmp_path, monkeypatch, shape):
    """What tasks write there is what Spark reads back, however the session names the folder."""
    own = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda conf, key, *a: shape.format(tmp_path) if key == "spark.checkpoint.dir" else own(conf, key, *a))
    got = queries.QUERIES["raster_annotate"](spark, "/root/testdata/sf0.001").select("vec_id", "normal", "problem").collect()
    assert shared_path(spark, "x").startswith(f"file://{tmp_path}/x-")
    assert sorted(tuple(r) for r in got) == [(k, f"frame_{k:06d}.png", None) for k in range(500)]
    assert all(p.suffix == ".png" for p in tmp_path.glob("pictures-*/run/*/frame*"))


def test_tasks_take_a_path_without_a_scheme_as_local(tmp_path):
    write_bytes(f"{tmp_path}/a b/c%20.txt", b"x")
    assert (tmp_path / "a b/c%20.txt").read_bytes() == b"x" and read_bytes(f"{tmp_path}/a b/c%20.txt") == b"x"


def test_rasters_that_lack_pixels_are_annotated(spark, tmp_path):
    """No embedding, an empty and a short one, and values beyond the range, against the SQL."""
    lit, table = [0.9] * 64, f"{tmp_path}/embeddings.parquet"
    rows = [(0, lit), (1, None), (2, []), (3, lit[:20]), (4, [1.5, -2.0, None, *([0.0] * 61)])]
    spark.createDataFrame([(k, 1, e) for k, e in rows], "vec_id long, label int, embedding array<float>").coalesce(1).write.parquet(table)
    got = queries.QUERIES["raster_annotate"](spark, str(tmp_path))
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{table}/*.parquet'")
    found = sql.execute(queries.ORACLE_SQL["raster_annotate"])
    names = [c[0] for c in found.description]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(found.fetchall())
