"""The registered queries of the corpus operators: each applies its operator to a whole table.

Operators return real outputs (texts, spans, pictures); the queries derive digest
columns from them where a contract asks for digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantagrid.llm import fingerprints, lines, media, mixing, neardup, pieces, pii, secrets, suffixes, toxicity
from vantagrid.llm.common import table


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_is(kinds: list[str]) -> Callable[[Column], Column]:
    return lambda s: s["kind"].isin(kinds)


def with_span_digests(df: DataFrame, base: list[str], *more: Column) -> DataFrame:
    """doc_id, n_<kind> of each base kind, base_sha256, spans, and more."""
    counts = [F.size(F.filter("spans", kind_is([k]))).cast("long").alias(f"n_{k}") for k in base]
    own = F.filter("spans", kind_is(base))
    return df.select("doc_id", *counts, F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), *more)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clean_sha256`` is the digest of the sanitised text."""
    clean = F.when(F.size("spans") > 0, F.sha2(pii.cleaned(F.col("text"), F.col("spans")), 256)).otherwise(F.col("sha256"))
    found = pii.personal_spans(table(spark, sf_dir, "documents")).withColumn("clean_sha256", clean)
    return with_span_digests(found, list(pii.KINDS[: pii.BASE]), F.col("clean_sha256"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    return with_span_digests(found, [r.name for r in secrets.RULES[: secrets.BASE]])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    got = toxicity.scored(docs, model)
    return got.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded and decoded again: ``decoded_sha256`` is the digest of the text."""
    back = pieces.decoded(pieces.encoded(table(spark, sf_dir, "documents")))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
    return got.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.edited_texts(table(spark, sf_dir, "documents")).withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    own, other = F.col("sketch"), F.col("edited_sketch")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(own).alias("fingerprint"),
        fingerprints.as_text(other).alias("edited_fingerprint"),
        fingerprints.likeness(own, other).alias("near_edited"),
        fingerprints.likeness(own, F.col("next_sketch")).alias("near_next"),
        fingerprints.containment(own, other).alias("kept_in_edited"),
    )


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.with_copies(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return got.select("doc_id", "__vg.size", "__vg.source_size", "__vg.target", (F.col("__vg.size") * F.col("__vg.copies")).alias("taken"), "source", F.col("__vg.copies").alias("copies"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = media.stored_texts(table(spark, sf_dir, "documents"))
    return got.withColumn("tile_sha256", F.sha2("tile", 256)).drop("tile")


def media_colour_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as colour pictures in both formats, read back: what is the same of either, and the digests of both tiles."""
    drawn = media.vector_pictures(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    one = media.media_columns(drawn.select("vec_id", "bmp"), "vec_id", "bmp")
    two = media.media_columns(drawn.select("vec_id", "ppm"), "vec_id", "ppm")
    shown = lambda df, name: df.select("vec_id", F.lit(name).alias("format"), "height", "width", "channels", "dhash", F.sha2("tile", 256).alias("tile_sha256"), "error")
    return shown(one, "bmp").unionByName(shown(two, "ppm"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.sha2("text", 256).alias("kept_sha256"), F.length("text").cast("long").alias("n_chars"), F.col("__vg.chunks").cast("long").alias("n_chunks_removed"), F.col("__vg.lines").cast("long").alias("n_lines_removed"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_secret_scan": op2_secret_scan,
    "op3_toxicity": op3_toxicity,
    "op4_pieces": op4_pieces,
    "op5_near_dedup": op5_near_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_source_mix": op7_source_mix,
    "op8_media": op8_media,
    "media_colour_pictures": media_colour_pictures,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_line_dedup": op10_line_dedup,
}
