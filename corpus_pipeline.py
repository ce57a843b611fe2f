"""Corpus preparation: the documents that are worth training on, balanced over sources and placed on shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next one's ``docs``. All but the last return the columns of ``documents``, extra ones included, with
their values. Empty tables, nulls in any column, repeated rows and texts of any length pass through all
stages; what each of them decides is stated in its operator's module. Columns beyond ``documents``' own
travel under names no operator uses and get their names back after the stage, so an extra column
named like an operator's inner or result column neither breaks a stage nor has its values replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shardloom.llm import decontaminate, mixing, quality_rules, sharding, simhash
from shardloom.llm.frames import stored


def by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the weakly supervised rules keep."""
    judged = quality_rules.judge(docs, keep=docs.columns)
    return judged.filter("kept").select(*docs.columns)


def by_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (4-word shingles, at most 4 bits apart)."""
    return simhash.one_of_each(docs, shingle=simhash.SHINGLE)


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exact or edited."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def by_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the balanced mix takes them."""
    return mixing.mix(docs)


def by_shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard."""
    return sharding.place(docs)


#: The columns of ``documents``; the operators read them by these names.
OWN = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def shielded(stage: Stage) -> Stage:
    """``stage`` with every column beyond ``OWN`` renamed out of the way and back afterwards."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        extra = [c for c in docs.columns if c not in OWN]
        taken = set(docs.columns)
        hidden = {}
        for k, name in enumerate(extra):
            inner = f"extra_column_{k}"
            while inner in taken:
                inner += "_"
            hidden[name] = inner
            taken.add(inner)
        result = stage(spark, docs.withColumnsRenamed(hidden), sf_dir)
        # Stage results named like an extra column give way to the extra column.
        back = {inner: name for name, inner in hidden.items()}
        result = result.drop(*[c for c in result.columns if c in hidden])
        return result.withColumnsRenamed(back)

    run.__name__ = stage.__name__
    run.__doc__ = stage.__doc__
    return run


STAGES = [
    ("quality rules", shielded(by_quality_rules)),
    ("simhash near-dedup", shielded(by_simhash)),
    ("benchmark decontamination", shielded(by_benchmark)),
    ("mixing", shielded(by_mix)),
    ("sharding", shielded(by_shard)),
]

# Expectation-maximisation, component search, edit verification and balanced sampling are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
