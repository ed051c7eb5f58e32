"""Frame scans: files of a pass by index, and decoded image pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantagrid.errors import PairingRefused
from vantagrid.functions.text import frame_index, stem
from vantagrid.operators.pairing import duplicates, paired, require_paired


def scan_frames(spark: SparkSession, root: str) -> DataFrame:
    """(path, name, frame_index) of all PNG files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").option("recursiveFileLookup", True).load(root).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), frame_index(F.col("path")).alias("frame_index"))


def checked_frames(spark: SparkSession, root: str, exists: bool) -> DataFrame:
    """Frames of one pass, or a refusal: no folder, no frames, a frame without index, an index twice."""
    if not exists:
        raise PairingRefused(f"no folder {root}")
    frames = scan_frames(spark, root)
    odd = frames.where("frame_index IS NULL").orderBy("path").first()
    if odd:
        raise PairingRefused(f"{odd.name} does not end in a frame index")
    twice = duplicates(frames, ["frame_index"]).orderBy("frame_index").first()
    if twice:
        raise PairingRefused(f"frame index {twice.frame_index} occurs {twice.n} times below {root}")
    if frames.isEmpty():
        raise PairingRefused(f"no PNG files below {root}")
    return frames


def paired_run(normal: DataFrame, mask: DataFrame, what: str) -> DataFrame:
    """(frame_index, normal_path, mask_path, normal_name): strictly paired, or a refusal."""
    pairs = paired(normal, mask, [], "frame_index")
    require_paired(pairs, what)
    name = F.element_at(F.split("left_path", "/"), -1)
    return pairs.select("frame_index", F.col("left_path").alias("normal_path"), F.col("right_path").alias("mask_path"), name.alias("normal_name"))


def sequence_of(pairs: DataFrame) -> str:
    from vantagrid.functions.text import sequence_name

    return pairs.agg(F.min_by(sequence_name(F.col("normal_path")), "frame_index")).first()[0]


def images(spark: SparkSession, root: str) -> DataFrame:
    """(path, stem, image) of the decoded PNG files below a folder."""
    got = spark.read.format("image").option("pathGlobFilter", "*.png").option("recursiveFileLookup", True).load(root)
    return got.select(F.col("image.origin").alias("path"), stem(F.col("image.origin")).alias("stem"), "image")


def kth_image(spark: SparkSession, raw_root: str, run_ids: DataFrame, k: int = 30) -> DataFrame:
    """(run_id, image): the normal frame at place k of each run, or its last; one decoded frame a run."""
    from vantagrid.operators.runs import kth_of_each

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(f"{raw_root.rstrip('/')}/*/normal/").select("path")
    files = files.withColumn("run_id", F.element_at(F.split("path", "/"), -3)).join(run_ids.select("run_id").distinct(), "run_id", "left_semi")
    picked = [r.path for r in kth_of_each(files, "run_id", ["path"], k).select("path").collect()]
    if not picked:
        return spark.createDataFrame([], "run_id string, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    got = spark.read.format("image").load(picked)
    return got.select(F.element_at(F.split("image.origin", "/"), -3).alias("run_id"), "image")
