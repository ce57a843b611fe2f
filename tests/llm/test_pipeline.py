import collections

import pytest
from fixtures import DOCS, awkward, frame, split
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline
from shardloom.llm import decontaminate, mixing, quality_rules, sharding
from shardloom.llm.frames import stored

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(("documents", docs.collect(), docs.columns))
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER))
        out.append((name, docs.collect(), docs.columns))
    return out


def test_stages_in_order(steps):
    assert [s[0] for s in steps[1:]] == [
        "quality rules",
        "simhash near-dedup",
        "benchmark decontamination",
        "mixing",
        "sharding",
    ]
    for _, _, columns in steps[1:-1]:
        assert columns == steps[0][2]
    assert corpus_pipeline.ORACLE_SQL is None


def test_rules_stage_keeps_what_the_operator_keeps(spark, steps):
    docs = frame(spark, steps[0][1], DOCS)
    kept = {r["doc_id"] for r in quality_rules.judge(docs, keep=["doc_id"]).filter("kept").collect()}
    assert {r["doc_id"] for r in steps[1][1]} == kept
    assert set(map(tuple, steps[1][1])) <= set(map(tuple, steps[0][1]))


def test_one_of_each_near_duplicate_group(steps):
    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in steps[1][1]}
    root = plain_components(list(fps.values()))
    low = {}
    for i, f in fps.items():
        low[root[f]] = min(low.get(root[f], i), i)
    assert sorted(r["doc_id"] for r in steps[2][1]) == sorted(low.values())


def test_no_item_is_left(spark, steps):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    leaks = decontaminate.find(frame(spark, steps[2][1], DOCS), bench, keep=["doc_id"])
    gone = {r["doc_id"] for r in leaks.collect()}
    assert gone and {r["doc_id"] for r in steps[3][1]} == {r["doc_id"] for r in steps[2][1]} - gone


def test_mix_and_shards(spark, steps):
    before, mixed, placed = steps[3][1], steps[4][1], steps[5][1]
    sized = mixing.sizes(frame(spark, before, DOCS)).select("doc_id", "source", "size")
    targets = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
    words = collections.Counter()
    for r in mixed:
        words[r["source"]] += len(split(r["text"]))
    assert all(abs(words[s] / t - 1) < 0.05 for s, t in targets.items())
    assert max(collections.Counter(r["doc_id"] for r in mixed).values()) <= mixing.MOST_COPIES
    table = sharding.lookup_table([f"shard-{k:05d}" for k in range(sharding.SHARDS)])
    assert len(placed) == len(mixed) and all(table[r["slot"]] == r["shard"] for r in placed)
    assert collections.Counter(tuple(r)[:5] for r in placed) == collections.Counter(map(tuple, mixed))


def test_awkward_and_empty_documents(spark):
    for rows in (awkward(), []):
        docs = frame(spark, rows, DOCS).selectExpr("*", "'x' AS n_words", "'y' AS slot", "1 AS n", "'f' AS fp")
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, FOLDER))
        assert docs.count() <= 3 * len(rows)


CLASHING = ("_text", "_n", "_k1", "_k2", "_copies", "_copy", "votes", "kept", "n_words", "fp", "_id", "_vector",
            "slot", "shard", "size", "extra_column_0", "posterior", "base_failed")


def test_extra_columns_with_clashing_names(spark, steps):
    """Every stage stands extra columns named like inner or result columns and keeps their values."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for k, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.concat(F.lit(f"{k}:"), F.col("doc_id").cast("string")))
    for (name, stage), (_, before, _) in zip(corpus_pipeline.STAGES, steps[1:]):
        out = stored(stage(spark, docs, FOLDER))
        if name != "sharding":
            assert out.columns == docs.columns
        values = out.select("doc_id", *CLASHING).collect()
        assert all(r[n] == f"{k}:{r['doc_id']}" for r in values for k, n in enumerate(CLASHING) if r["doc_id"] is not None)
        ids = collections.Counter(r["doc_id"] for r in out.collect())
        if name in ("quality rules", "benchmark decontamination"):
            # Decided by the text alone; elsewhere a group's representative may follow the whole row.
            assert ids == collections.Counter(r["doc_id"] for r in before)
        else:
            assert sum(ids.values()) == len(before)
        docs = out if name != "sharding" else docs
