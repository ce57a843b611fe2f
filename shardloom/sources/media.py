"""Directories of images: ``<modality>/<subject>/.../<sample>.<ext>``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.hashing import path_stem

# Fixed value: file extensions that count as images, case-sensitive.
IMAGE_GLOB = "*.{jpg,jpeg,png,bmp}"


def scan_media(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """(modality, subject_id, stem, path, length[, content]) of every image below ``root``.

    Without ``content`` only the listing is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", IMAGE_GLOB)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    # Anchored at the root, whose own path may contain a folder of either name.
    below = re.sub(r"^[A-Za-z0-9+.-]+:/*", "", root).strip("/")
    place = rf"\Q{below}\E/(iris|fingerprint)/([^/]+)/(?:.*/)?[^/]+$"
    found = files.select(
        F.regexp_extract("path", place, 1).alias("modality"),
        F.regexp_extract("path", place, 2).alias("subject_id"),
        path_stem(F.col("path")).alias("stem"),
        "path",
        "length",
        *(["content"] if content else []),
    )
    return found.filter(F.length("modality") > 0)


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Spark's decoded image rows for every image below ``root``; bad files have height -1."""
    return (
        spark.read.format("image")
        .option("pathGlobFilter", IMAGE_GLOB)
        .option("recursiveFileLookup", "true")
        .load(root)
    )


def write_media(df: DataFrame, root: str) -> None:
    """Write (name, content) rows as files below ``root``, from the tasks, in any file system."""

    def write(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root if "://" in root or ":/" in root else f"file://{root}")
        for batch in batches:
            for name, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist(), strict=True):
                target = f"{base}/{name}"
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(target) as out:
                    out.write(content)
            yield batch.select(["name"])

    df.select("name", "content").mapInArrow(write, "name string").agg(F.count("*")).collect()
