"""Rows without a key of their own: decide on a digest of the whole row, then repeat or drop rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("_k1", "_k2")


def row_keys(df: DataFrame) -> DataFrame:
    """Add ``_k1`` and ``_k2``, two 64-bit digests of all columns. Only equal rows share both."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in df.columns if c not in KEYS]
    return df.withColumns(
        {"_k1": F.xxhash64(F.lit(1), *columns), "_k2": F.xxhash64(F.lit(2), *reversed(columns))}
    )


def repeat_rows(keyed: DataFrame, decisions: DataFrame) -> DataFrame:
    """``decisions`` has the keys, ``n`` (rows with that key) and ``copies`` (of all these together).
    Rows with a key of their own need no second look; of equal rows one is repeated for all."""
    wanted = decisions.filter(F.col("copies") > 0).select(
        *KEYS, F.col("n").alias("_n"), F.col("copies").alias("_copies")
    )
    joined = keyed.join(wanted, list(KEYS))
    single = joined.filter(F.col("_n") == 1)
    equal = joined.filter(F.col("_n") > 1).dropDuplicates(list(KEYS))
    many = F.sequence(F.lit(1).cast("long"), F.col("_copies"))
    return single.unionByName(equal).withColumn("_copy", F.explode(many)).drop("_copy", "_copies", "_n")
