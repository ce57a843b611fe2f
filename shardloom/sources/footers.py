"""Parquet files' own schemas, read from their footers by the executors.

A read with a fixed schema turns a missing column into nulls and may cast a retyped one, so checks
of structure must look at each file's footer. Files are listed without their contents; every task
opens the files of its partition and reads only the footer, so the job spreads like the files do.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from shardloom.functions.hashing import path_stem
from shardloom.sources.shards import list_files

#: One row per file and column; a file whose footer cannot be read has one row with its problem.
FOOTER = "path string, column string, type string, nullable boolean, problem string"


def _spark_type(arrow: pa.DataType) -> str:
    try:
        return from_arrow_type(arrow).simpleString()
    except TypeError:
        return str(arrow)


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"path": [], "column": [], "type": [], "nullable": [], "problem": []}
        for path in batch.column("path").to_pylist():
            try:
                filesystem, inner = pafs.FileSystem.from_uri(path)
                with filesystem.open_input_file(inner) as handle:
                    schema = pq.read_schema(handle)
            except (OSError, ValueError, pa.ArrowException) as failed:
                for key, value in zip(out, (path, None, None, None, f"unreadable: {failed}")):
                    out[key].append(value)
                continue
            for field in schema:
                for key, value in zip(out, (path, field.name, _spark_type(field.type), field.nullable, None)):
                    out[key].append(value)
        yield pa.RecordBatch.from_pydict(
            out,
            schema=pa.schema(
                [("path", pa.string()), ("column", pa.string()), ("type", pa.string()), ("nullable", pa.bool_()),
                 ("problem", pa.string())]
            ),
        )


def footers(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, shard_id, column, type, nullable, problem) of every Parquet file below ``root``.

    ``shard_id`` comes from a ``source_shard=<id>`` folder or else the file's name; ``type`` is the
    Spark type the column reads as. Paths must be of a file system that Arrow opens (local, HDFS,
    S3, GCS, Azure).
    """
    listing = list_files(spark, root, pattern).select("path")
    read = listing.mapInArrow(_columns, FOOTER)
    in_folder = F.regexp_extract("path", r"/source_shard=([^/]+)/", 1)
    shard = F.when(F.length(in_folder) > 0, in_folder).otherwise(path_stem(F.col("path")))
    return read.select("path", shard.alias("shard_id"), "column", "type", "nullable", "problem")
