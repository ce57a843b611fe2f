import base64
import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.errors import RegistryFault
from shardloom.functions import checks as c
from shardloom.functions import hashing as h
from shardloom.operators import fusion as fu
from shardloom.operators import guard as g
from shardloom.operators import metrics as mt
from shardloom.operators import registry as r
from shardloom.operators import scoring as sc
from shardloom.sources.log import read_requests, write_provenance

rng = np.random.default_rng(4)


# --- requests ---------------------------------------------------------------------------------------


def test_strict_base64_equals_python(spark):
    texts = ["", "YQ==", "YWI=", "YWJj", "abc", "aGk", "aG k=", "YQ=", "====", "=", "YQ==YQ==", "YW-j", "YWJj\n",
             "not-valid-b64!!!", "A===", "AA=A", "é+==", base64.b64encode(bytes(range(256))).decode()]

    def valid(text):
        try:
            base64.b64decode(text, validate=True)
            return True
        except Exception:
            return False

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", c.is_base64(F.col("t")).alias("ok"), c.decode_base64(F.col("t")).alias("b")).collect()
    for row in rows:
        assert row.ok == valid(row.t), row.t
        assert not row.ok or bytes(row.b) == base64.b64decode(row.t)
    long = spark.createDataFrame([(bytes(range(256)),)], "b binary")
    assert long.select(c.encode_base64(F.col("b"))).first()[0] == texts[-1]


def test_request_source_rules_and_responses(spark, tmp_path):
    good = base64.b64encode(b"x").decode()
    rows = [
        {"request_id": "a", "iris_b64": good, "fingerprint_b64": good, "top_k": 3},
        {"request_id": "b", "iris_b64": good, "fingerprint_b64": good},
        {"request_id": "b", "iris_b64": good, "fingerprint_b64": good, "top_k": 2},
        {"request_id": "c", "iris_b64": "!", "fingerprint_b64": good, "top_k": 11},
        {"request_id": "d", "iris_b64": good, "top_k": 0},
    ]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(x) for x in rows))
    valid, broken = g.separate(read_requests(spark, str(tmp_path)), c.request_rules())
    assert {x.request_id: x.violations for x in broken.collect()} == {
        "c": ["iris_b64", "top_k"], "d": ["fingerprint_b64", "top_k"],
    }
    scored = valid.withColumn("logits", F.array(F.lit(0.0), F.lit(2.0), F.lit(1.0)))
    names = spark.createDataFrame([(1, "Ada")], "label int, subject_id string")
    nested = sc.responses(scored, "logits", F.col("top_k"), names, "v1")
    found = sorted((x.request_id, [tuple(p) for p in x.predictions]) for x in nested.collect())
    p = [round(math.exp(v) / sum(map(math.exp, (0, 2, 1))), 6) for v in (0, 2, 1)]
    first, second, third = (1, "Ada", 1, p[1]), (2, "S0002", 2, p[2]), (3, "S0000", 0, p[0])
    assert found == [("a", [first, second, third]), ("b", [first]), ("b", [first, second])]
    body = json.loads(sc.response_json(nested.filter("request_id = 'a'")).first().body)
    assert body["predictions"][0] == {"rank": 1, "subject_id": "Ada", "label": 1, "confidence": p[1]}
    assert body["model_version"] == "v1"


def test_top_k_is_limited_by_the_classes_and_breaks_ties_by_label(spark):
    df = spark.createDataFrame([(1, [1.0, 1.0])], "id int, logits array<double>")
    names = spark.createDataFrame([], "label int, subject_id string")
    rows = sc.top_k(df, ["id"], "logits", 5, names).orderBy("rank").collect()
    assert [(x.rank, x.label, x.confidence) for x in rows] == [(1, 0, 0.5), (2, 1, 0.5)]


# --- evaluation and classifier ------------------------------------------------------------------------


def test_evaluation(spark):
    logits, labels = rng.normal(size=(40, 5)), rng.integers(0, 5, 40)
    rows = [(x.tolist(), int(y), i // 16) for i, (x, y) in enumerate(zip(logits, labels, strict=True))]
    df = spark.createDataFrame(rows, "logits array<double>, label int, batch int")
    logp = logits - np.log(np.exp(logits).sum(1, keepdims=True))
    loss, hit = -logp[np.arange(40), labels], logits.argmax(1) == labels
    found = sc.evaluate(df, "logits", "label").first()
    assert found.n == 40
    assert found.val_loss == pytest.approx(loss.mean()) and found.val_accuracy == pytest.approx(hit.mean())
    empty = sc.evaluate(df.limit(0), "logits", "label").first()
    assert empty.n == 0 and math.isnan(empty.val_loss) and math.isnan(empty.val_accuracy)
    batches = {x.batch: x for x in sc.batch_metrics(df, "batch", "logits", "label").collect()}
    assert batches[2].n == 8 and batches[2].loss == pytest.approx(loss[32:].mean())
    extreme = spark.createDataFrame([([-1e4, 1e4], 0)], "logits array<double>, label int")
    assert sc.evaluate(extreme, "logits", "label").first().val_loss == pytest.approx(2e4)


def test_classifier_learns_fused_features(spark):
    centres = rng.normal(size=(3, 8)) * 4
    rows = [(i % 3, (centres[i % 3] + rng.normal(size=8)).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "label int, v array<double>").withColumn(
        "features", fu.fuse(F.slice("v", 1, 4), F.slice("v", 5, 4))
    )
    model = fu.fit_classifier(df, "features", "label", max_steps=30)
    scored = fu.apply_classifier(model, df, "features")
    assert scored.columns == [*df.columns, "logits"]
    assert sc.evaluate(scored, "logits", "label").first().val_accuracy > 0.9


def test_gate_needs_every_metric(spark):
    rows = [("a", "acc", 0.9), ("a", "f1", 0.8), ("b", "acc", 0.9), ("b", "f1", 0.1), ("c", "acc", 1.0)]
    df = spark.createDataFrame(rows, "run string, metric string, value double")
    found = {x.run: x.passed for x in mt.promotion_gate(df, {"acc": 0.9, "f1": 0.5}, "run").collect()}
    assert found == {"a": True, "b": False, "c": False}


# --- registry and provenance ----------------------------------------------------------------------------


def test_versions_continue_and_compare_as_numbers(spark):
    df = spark.createDataFrame([("m", i) for i in range(11)] + [("n", 50)], "name string, run int")
    first = r.register(df, "run")
    more = r.register(spark.createDataFrame([("m", 99), ("o", 1)], "name string, run int"), "run", first)
    assert {(x.name, x.version) for x in more.collect()} == {("m", 12), ("o", 1)}
    table = first.unionByName(more).withColumn("version", F.col("version").cast("string"))
    assert r.latest_uri(table, "m") == "models:/m/12"
    assert [x.version for x in r.list_versions(table, "m").collect()] == [str(i) for i in range(12, 0, -1)]
    with pytest.raises(RegistryFault):
        r.latest_uri(table, "unknown")


def test_config_hash_equals_sorted_json(spark):
    config = {"b": {"y": 1.5, "x": None}, "a": "te\"xt\\", "n": 3, "t": True}
    inner = F.create_map(F.lit("y"), F.lit("1.5"), F.lit("x"), F.lit(None).cast("string"))
    column = F.create_map(
        F.lit("n"), F.lit("3"), F.lit("b"), h.config_document(inner),
        F.lit("a"), h.json_text(F.lit(config["a"])), F.lit("t"), F.lit("true"),
    )
    row = spark.range(1).select(h.config_document(column).alias("d"), h.config_hash(column).alias("x")).first()
    text = json.dumps(config, sort_keys=True)
    assert row.d == text and row.x == hashlib.sha256(text.encode()).hexdigest()[:16]
    nulls = spark.range(1).select(h.json_text(F.lit(None).cast("string")).alias("j")).first()
    assert nulls.j == "null"


def test_derived_keys(spark):
    import struct

    row = spark.range(1).select(
        h.shard_name(F.lit(42), F.lit(3)).alias("shard"), h.sample_name(F.lit(7), F.lit(2)).alias("sample"),
        h.path_stem(F.lit("/a/b.c/shard_0.x.parquet")).alias("stem"), h.path_stem(F.lit("plain")).alias("plain"),
        h.record_checksum(F.lit("a"), F.lit(None).cast("string"), F.lit("b")).alias("none"),
    ).first()
    assert row.shard == "shard_0003_" + hashlib.sha256(struct.pack(">II", 42, 3)).hexdigest()[:8]
    assert (row.sample, row.stem, row.plain, row.none) == ("S0007_s02", "shard_0.x", "plain", None)


def manifest(spark):
    extra = F.create_map(F.lit("val_accuracy"), F.lit("0.5"), F.lit("profile"), F.lit("mine"))
    return spark.range(1).select(
        *r.run_manifest(
            F.lit("abc"), F.lit("0f1e2d3c"), F.lit("0000"), F.lit(5), F.lit("local"), F.lit("fusion"),
            F.lit(20), F.lit(50), F.lit(None), F.lit("2024-01-01").cast("timestamp"), extra,
        )
    )


def test_tags_are_strings_and_extra_tags_win(spark):
    tags = {x.key: x.value for x in r.run_tags(manifest(spark)).collect()}
    assert tags == {
        "run_id": "abc", "git_sha": "0f1e2d3c", "config_hash": "0000", "delta_log_offset": "5", "profile": "mine",
        "model_name": "fusion", "schema_version": "1", "val_accuracy": "0.5",
    }


def test_provenance_is_written_twice(spark, tmp_path):
    write_provenance(manifest(spark), str(tmp_path))
    row = spark.read.json(f"{tmp_path}/run_manifest").first().asDict(recursive=True)
    assert row["run_id"] == "abc" and row["best_val_loss"] is None and row["extra_tags"]["profile"] == "mine"
    assert spark.read.parquet(f"{tmp_path}/run_tags").count() == 8
