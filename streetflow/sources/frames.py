"""Camera frames and their annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.functions.media import box_line, camera_of
from streetflow.operators.windows import first_of_groups

# Default frame size, image pattern, layout of an annotation document.
FRAME_WIDTH, FRAME_HEIGHT = 960, 540
IMAGE_NUMBER = r"img(\d+)\.jpg$"
ANNOTATION = """_name string, _width int, _height int,
 frame array<struct<_num: int, target_list: struct<target: array<struct<
   box: struct<_left: double, _top: double, _width: double, _height: double>>>>>>"""


def list_images(spark: SparkSession, root: str) -> DataFrame:
    """`(camera_id, frame_id, sequence, frame, path)` of every image; contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg")
             .option("recursiveFileLookup", "true").load(root).select("path"))
    parts = F.split("path", "/")
    named = files.select("path", F.get(parts, F.size(parts) - 2).alias("sequence"),
                         F.get(parts, F.size(parts) - 1).alias("frame_id"))
    return named.select("path", F.col("sequence").alias("camera_id"), "frame_id", "sequence",
                        F.regexp_extract("frame_id", IMAGE_NUMBER, 1).try_cast("int").alias("frame"))


def read_frames(spark: SparkSession, root: str, cameras: int, frames: int, layout: str = "sequences",
                up_to_first_underscore: bool = True) -> DataFrame:
    """`(camera_id, frame_id, frame_b64)` of the first frames of the first cameras by name.

    Layout "sequences": one folder per camera. Layout "flat": the camera is part of the file
    name, and the first `cameras * frames` files by name are taken. Names are chosen before
    any content is kept: contents come in by a join on the path, so names may hold any character.
    """
    listed = list_images(spark, root)
    if layout == "flat":
        chosen = (listed.withColumn("camera_id", camera_of(F.col("frame_id"), up_to_first_underscore))
                  .orderBy("frame_id", "path").limit(cameras * frames))
    else:
        chosen = first_of_groups(listed, "camera_id", ["frame_id", "path"], cameras, frames)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option("recursiveFileLookup", "true")
    contents = reader.load(root).select("path", "content")
    return chosen.join(contents, "path").select("camera_id", "frame_id", F.base64("content").alias("frame_b64"))


def read_annotations(spark: SparkSession, root: str) -> DataFrame:
    """One row per labelled box with its frame size."""
    docs = (spark.read.format("xml").option("rowTag", "sequence").option("pathGlobFilter", "*.xml")
            .option("recursiveFileLookup", "true").schema(ANNOTATION).load(root)
            .withColumn("_file", F.col("_metadata.file_name")))
    frames = docs.select(F.regexp_replace("_file", r"\.xml$", "").alias("sequence"),
                         F.coalesce("_width", F.lit(FRAME_WIDTH)).alias("frame_width"),
                         F.coalesce("_height", F.lit(FRAME_HEIGHT)).alias("frame_height"),
                         F.explode("frame").alias("f"))
    boxes = frames.select("sequence", "frame_width", "frame_height", F.col("f._num").alias("frame"),
                          F.posexplode("f.target_list.target").alias("box", "t"))
    return boxes.filter(F.col("t.box").isNotNull()).select(
        "sequence", "frame", "box", "frame_width", "frame_height", F.col("t.box._left").alias("left"),
        F.col("t.box._top").alias("top"), F.col("t.box._width").alias("width"), F.col("t.box._height").alias("height"))


def label_lines(boxes: DataFrame) -> DataFrame:
    """Add the normalised label line of each box."""
    size = [F.col(c) for c in ("left", "top", "width", "height", "frame_width", "frame_height")]
    return boxes.withColumn("line", box_line(*size))
