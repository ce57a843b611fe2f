"""Scoring, evaluation, fusion, registry and run provenance."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions import hashing as h
from shardloom.functions.arrays import total
from shardloom.functions.checks import broken_rules, encode_base64, request_rules
from shardloom.operators import fusion as fu
from shardloom.operators import guard as g
from shardloom.operators import manifest as m
from shardloom.operators import metrics as mt
from shardloom.operators import registry as r
from shardloom.operators import sampling as sp
from shardloom.operators import scoring as sc
from shardloom.session import new_folder, stored
from shardloom.sources.log import read_requests
from shardloom.workloads import tables as t

CLASSES = 10
BATCH = 32
GATE = {"accuracy": 0.1, "neg_loss": -2.3}


def _logits(spark: SparkSession, folder: str) -> DataFrame:
    """A class's score is the sum of every tenth number of the vector, beginning at the class's own."""
    vectors = t.table(spark, folder, "embeddings")

    def score(k):
        return total(F.filter("embedding", lambda _, i: i % CLASSES == k))

    return vectors.select("vec_id", F.array(*[score(k) for k in range(CLASSES)]).alias("logits"), "label")


def _names(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the first classes; the others get default names."""
    regions = t.table(spark, folder, "region")
    return regions.select(F.col("r_regionkey").alias("label"), F.col("r_name").alias("subject_id"))


def score_topk(spark: SparkSession, folder: str) -> DataFrame:
    return sc.top_k(_logits(spark, folder), ["vec_id"], "logits", 3, _names(spark, folder))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as scoring requests; every third one has a damaged picture, some ask for too much."""
    damaged = (F.col("conv_id") + F.col("turn")) % 3 == 0
    text = encode_base64(F.col("text"))
    return t.table(spark, folder, "conversations").select(
        "conv_id",
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        F.when(damaged, F.concat(text, F.lit("!"))).otherwise(text).alias("iris_b64"),
        encode_base64(F.col("role")).alias("fingerprint_b64"),
        (F.col("turn") * 4).cast("int").alias("top_k"),
    )


def request_validate(spark: SparkSession, folder: str) -> DataFrame:
    broken = F.array_join(broken_rules(request_rules()), ",")
    return _requests(spark, folder).select("request_id", broken.alias("violations"))


def score_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Valid requests, scored by the vector of their conversation."""
    valid, _ = g.separate(_requests(spark, folder), request_rules())
    scored = valid.select("request_id", "top_k", F.col("conv_id").alias("vec_id")).join(
        _logits(spark, folder), "vec_id"
    )
    return sc.top_k(scored, ["request_id"], "logits", F.col("top_k"), _names(spark, folder))


MODEL_VERSION = "v1"


def _request_files(spark: SparkSession, folder: str) -> str:
    """The requests as a client sends them: JSON lines in the shared folder."""
    path = new_folder(spark, "requests")
    _requests(spark, folder).drop("conv_id").write.json(path)
    return path


def response_json(spark: SparkSession, folder: str) -> DataFrame:
    """Requests read from JSON lines, answered as nested JSON lines, and read back: one row per
    prediction of every valid request. Scores come from the vector of the request's conversation."""
    requests = read_requests(spark, _request_files(spark, folder))
    valid, _ = g.separate(requests, request_rules())
    conv = F.split("request_id", "-").getItem(0).cast("bigint")
    scored = valid.select("request_id", "top_k", conv.alias("vec_id")).join(_logits(spark, folder), "vec_id")
    nested = sc.responses(scored, "logits", F.col("top_k"), _names(spark, folder), MODEL_VERSION)
    out = new_folder(spark, "responses")
    sc.response_json(nested).select("body").write.text(out)
    back = spark.read.schema(nested.schema).json(out)
    return back.select("request_id", F.explode("predictions").alias("p")).select(
        "request_id", "p.rank", "p.label", "p.subject_id", "p.confidence"
    )


def request_reject(spark: SparkSession, folder: str) -> DataFrame:
    """Requests read from JSON lines that break a rule, with the rules they break."""
    requests = read_requests(spark, _request_files(spark, folder))
    _, broken = g.separate(requests, request_rules())
    return broken.select("request_id", F.array_join("violations", ",").alias("reason"))


def evaluate(spark: SparkSession, folder: str) -> DataFrame:
    result = sc.evaluate(_logits(spark, folder), "logits", "label")
    return result.withColumns(t.rounded("val_loss", "val_accuracy"))


def batch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    # Two numbers a row go on; the vectors stay where they are.
    outcome = sc.with_outcome(_logits(spark, folder), "logits", "label").select("vec_id", "loss", "correct")
    placed = sp.make_batches(outcome, ["vec_id"], batch_size=BATCH, carry=["loss", "correct"])
    return sc.batch_averages(placed, "batch_id").withColumns(t.rounded("loss", "accuracy"))


def promotion_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Each class is a candidate: its accuracy and negated loss must both clear the bar."""
    outcome = sc.with_outcome(_logits(spark, folder), "logits", "label")
    averaged = outcome.groupBy("label").agg(
        F.avg("correct").alias("accuracy"), (-F.avg("loss")).alias("neg_loss")
    )
    long = averaged.unpivot("label", ["accuracy", "neg_loss"], "metric", "value")
    return mt.promotion_gate(long, GATE, "label")


def _fused(spark: SparkSession, folder: str) -> DataFrame:
    """The vector of a document joined with measures of its text."""
    docs = t.table(spark, folder, "documents")
    measures = docs.select(
        F.col("doc_id").alias("vec_id"),
        F.array(
            F.log(F.col("n_chars") + 1.0), F.log(F.size(F.split("text", " ")) + 1.0)
        ).alias("measures"),
    )
    joined = t.table(spark, folder, "embeddings").join(measures, "vec_id")
    return joined.select("vec_id", "label", fu.fuse(F.col("embedding"), F.col("measures")).alias("features"))


def late_fusion(spark: SparkSession, folder: str) -> DataFrame:
    weighted = total(F.transform("features", lambda x, i: x * (i + 1)))
    return _fused(spark, folder).select("vec_id", F.round(weighted, 6).alias("weighted_sum"))


def _held_out() -> Column:
    """Every fifth vector is kept from the fit and judges it."""
    return F.col("vec_id") % 5 == 4


def _stored_features(spark: SparkSession, folder: str) -> DataFrame:
    """Fused features written once; the fit's passes and the checks all read them."""
    return stored(_fused(spark, folder), "features")


def fit_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on four fifths of the fused features; accuracy and loss per class on the fifth held out."""
    rows = _stored_features(spark, folder)
    model = fu.fit_classifier(rows.filter(~_held_out()), "features", "label", max_steps=20)
    scored = fu.apply_classifier(model, rows.filter(_held_out()), "features")
    outcome = sc.with_outcome(scored, "logits", "label")
    return outcome.groupBy("label").agg(
        F.count("*").alias("n"), F.avg("correct").alias("accuracy"), F.avg("loss").alias("loss")
    )


def classifier_stationarity(spark: SparkSession, folder: str) -> DataFrame:
    """Per class: training rows and whether the fitted objective's gradient vanishes on its weights
    (every component within ``fu.TOLERANCE``), which proves the fit reached its optimum."""
    rows = _stored_features(spark, folder).filter(~_held_out())
    model = fu.fit_classifier(rows, "features", "label")
    grad, _ = fu.gradient(model, rows, "features", "label")
    still = [(k, bool(np.abs(grad[k]).max() <= fu.TOLERANCE)) for k in range(grad.shape[0])]
    proof = spark.createDataFrame(still, "label long, stationary boolean")
    counts = rows.groupBy(F.col("label").cast("bigint").alias("label")).agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(proof), "label", "left").select(
        "label", "n", F.coalesce("stationary", F.lit(False)).alias("stationary")
    )


def _registry(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as registered runs: the customer is the model, the order is the run."""
    runs = t.table(spark, folder, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderkey").alias("run"),
        F.col("o_orderstatus").alias("status"),
    )
    return r.register(runs, "run")


def list_versions(spark: SparkSession, folder: str) -> DataFrame:
    return r.list_versions(_registry(spark, folder)).select("name", "version", "run", "status")


def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    return r.latest(_registry(spark, folder))


def latest_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """A user's events as checkpoints of a run."""
    listing = t.table(spark, folder, "events").select(
        "user_id",
        F.col("event_id").alias("step"),
        F.format_string("ckpt_step_%06d.pt", F.col("event_id")).alias("path"),
    )
    return r.latest_checkpoint(listing, "user_id")


def _config():
    model = h.config_document(
        F.create_map(F.lit("name"), h.json_text(F.lit("late_fusion")), F.lit("classes"), F.lit("10"))
    )
    return F.create_map(
        F.lit("profile"), h.json_text(F.col("o_orderpriority")),
        F.lit("seed"), F.col("o_custkey").cast("string"),
        F.lit("model"), model,
        F.lit("final"), F.when(F.col("o_orderstatus") == "F", "true").otherwise("false"),
    )


def config_hash(spark: SparkSession, folder: str) -> DataFrame:
    orders = t.table(spark, folder, "orders")
    return orders.select("o_orderkey", h.config_hash(_config()).alias("config_hash"))


def run_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Tags of every run; finished runs override their profile and add an accuracy."""
    finished = F.create_map(F.lit("profile"), F.lit("final"), F.lit("val_accuracy"), F.lit("0.5"))
    orders = t.table(spark, folder, "orders")
    manifests = orders.select(
        *r.run_manifest(
            run_id=F.col("o_orderkey").cast("string"),
            git_sha=F.sha1(F.col("o_orderkey").cast("string").cast("binary")),
            config_hash=h.config_hash(_config()),
            log_offset=F.col("o_orderkey") + 1,
            profile=F.col("o_orderpriority"),
            model_name=F.col("o_custkey").cast("string"),
            classes=F.lit(CLASSES),
            max_steps=F.lit(fu.MAX_STEPS),
            best_val_loss=F.lit(None),
            created_at=F.col("o_orderdate"),
            extra_tags=F.when(F.col("o_orderstatus") == "F", finished),
        )
    )
    return r.run_tags(manifests)


def run_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of one run over the current tables: data position, classes, validation loss."""
    rows = _logits(spark, folder)
    measured = sc.evaluate(rows, "logits", "label")
    classes = rows.agg(F.max("label") + 1).scalar()
    config = F.create_map(F.lit("name"), h.json_text(F.lit("late_fusion")))
    one = measured.select(
        *r.run_manifest(
            run_id=F.lit("run"),
            git_sha=F.lit("unknown"),
            config_hash=h.config_hash(config),
            log_offset=m.stamp(t.log(spark, folder)),
            profile=F.lit("cluster"),
            model_name=F.lit("late_fusion"),
            classes=classes,
            max_steps=F.lit(fu.MAX_STEPS),
            best_val_loss=F.col("val_loss"),
            created_at=F.lit(None).cast("timestamp"),
            extra_tags=F.create_map(
                F.lit("val_accuracy"), F.round("val_accuracy", 6).cast("string")
            ),
        )
    )
    return one.select(
        "schema_version", "run_id", "git_sha", "config_hash", "delta_log_offset", "profile",
        "model_name", "num_classes", "max_steps", F.round("best_val_loss", 6).alias("best_val_loss"),
        F.col("extra_tags")["val_accuracy"].cast("double").alias("val_accuracy"),
    )


QUERIES = {
    fn.__name__: fn
    for fn in (
        score_topk, request_validate, score_requests, response_json, request_reject, evaluate, batch_metrics, promotion_gate,
        late_fusion, fit_classifier, classifier_stationarity, list_versions, latest_version, latest_checkpoint, config_hash,
        run_tags, run_manifest,
    )
}

_STATIONARITY_SQL = """
SELECT CAST(e.label AS BIGINT) AS label, count(*) AS n, true AS stationary
FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id
WHERE e.vec_id % 5 <> 4
GROUP BY e.label"""

_LOGITS_SQL = """
logits AS (
  SELECT vec_id, list_transform(range(1, 11), lambda k: list_sum(list_transform(
           embedding[k:64:10], lambda x: CAST(x AS DOUBLE)))) AS logits, label
  FROM embeddings
),
outcome AS (
  SELECT vec_id, label,
         list_max(logits) + ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits)))))
           - logits[label + 1] AS loss,
         CAST(list_position(logits, list_max(logits)) - 1 = label AS INTEGER) AS correct
  FROM logits
)"""
_RANKED_SQL = """
spread AS (
  SELECT {key}, {k} AS k, unnest(logits) AS x, CAST(unnest(range(10)) AS BIGINT) AS label,
         list_max(logits) AS top,
         list_sum(list_transform(logits, lambda v: exp(v - list_max(logits)))) AS norm
  FROM {source}
),
ranked AS (
  SELECT {key}, k, label, exp(x - top) / norm AS p,
         row_number() OVER (PARTITION BY {key} ORDER BY exp(x - top) / norm DESC, label) AS rank
  FROM spread
)"""
_RANKED_BODY = """
SELECT {key}, CAST(rank AS INTEGER) AS rank, label,
       coalesce(r_name, printf('S%04d', label)) AS subject_id, round(p, 6) AS confidence
FROM ranked LEFT JOIN region ON r_regionkey = label WHERE rank <= k"""
_REQUESTS_SQL = """
requests AS (
  SELECT conv_id, conv_id || '-' || turn AS request_id,
         base64(encode(text)) || CASE WHEN (conv_id + turn) % 3 = 0 THEN '!' ELSE '' END AS iris_b64,
         base64(encode(role)) AS fingerprint_b64, turn * 4 AS top_k
  FROM conversations
),
checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN NOT (regexp_full_match(iris_b64, '[A-Za-z0-9+/]*={0,2}') AND length(iris_b64) % 4 = 0)
         THEN 'iris_b64' END,
    CASE WHEN NOT (regexp_full_match(fingerprint_b64, '[A-Za-z0-9+/]*={0,2}')
                   AND length(fingerprint_b64) % 4 = 0) THEN 'fingerprint_b64' END,
    CASE WHEN top_k NOT BETWEEN 1 AND 10 THEN 'top_k' END) AS violations
  FROM requests
)"""
_REGISTRY_SQL = """
registry AS (
  SELECT 'model_' || o_custkey AS name, o_orderkey AS run, o_orderstatus AS status,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS version
  FROM orders
)"""
_CONFIG_SQL = """
configured AS (
  SELECT *, substr(sha256('{"final": ' || CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END
    || ', "model": {"classes": 10, "name": "late_fusion"}, "profile": "' || o_orderpriority
    || '", "seed": ' || o_custkey || '}'), 1, 16) AS config_hash
  FROM orders
)"""

SQL = {
    "score_topk": t.with_ctes(
        _LOGITS_SQL,
        _RANKED_SQL.format(key="vec_id", k=3, source="logits"),
        body=_RANKED_BODY.format(key="vec_id"),
    ),
    "request_validate": t.with_ctes(_REQUESTS_SQL, body=" SELECT request_id, violations FROM checked"),
    "score_requests": t.with_ctes(
        _REQUESTS_SQL,
        _LOGITS_SQL,
        """
scored AS (
  SELECT request_id, top_k, logits FROM checked JOIN logits ON vec_id = conv_id WHERE violations = ''
)""",
        _RANKED_SQL.format(key="request_id", k="top_k", source="scored"),
        body=_RANKED_BODY.format(key="request_id"),
    ),
    "response_json": t.with_ctes(
        _REQUESTS_SQL,
        _LOGITS_SQL,
        """
scored AS (
  SELECT request_id, top_k, logits FROM checked JOIN logits ON vec_id = conv_id WHERE violations = ''
)""",
        _RANKED_SQL.format(key="request_id", k="top_k", source="scored"),
        body=_RANKED_BODY.format(key="request_id"),
    ),
    "request_reject": t.with_ctes(
        _REQUESTS_SQL, body=" SELECT request_id, violations AS reason FROM checked WHERE violations <> ''"
    ),
    "evaluate": t.with_ctes(
        _LOGITS_SQL,
        body="""
SELECT count(*) AS n, count(*) FILTER (loss IS NULL) AS n_unscored, round(avg(loss), 6) AS val_loss, round(avg(correct), 6) AS val_accuracy
FROM outcome""",
    ),
    "batch_metrics": t.with_ctes(
        _LOGITS_SQL,
        """
numbered AS (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) // 32 AS batch_id FROM outcome)""",
        body="""
SELECT batch_id, count(*) AS n, round(avg(loss), 6) AS loss, round(avg(correct), 6) AS accuracy
FROM numbered GROUP BY batch_id""",
    ),
    "promotion_gate": t.with_ctes(
        _LOGITS_SQL,
        body="""
SELECT label, avg(correct) >= 0.1::DOUBLE AND -avg(loss) >= -2.3::DOUBLE AS passed
FROM outcome GROUP BY label""",
    ),
    "classifier_stationarity": _STATIONARITY_SQL,
    "late_fusion": """
WITH joined AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE))
    || [ln(n_chars + 1.0::DOUBLE), ln(len(string_split(text, ' ')) + 1.0::DOUBLE)] AS f
  FROM embeddings JOIN documents ON doc_id = vec_id
),
centred AS (SELECT vec_id, list_transform(f, lambda x: x - list_sum(f) / len(f)) AS d FROM joined),
scaled AS (
  SELECT vec_id, list_transform(d, lambda x: x
    / sqrt(list_sum(list_transform(d, lambda y: y * y)) / len(d) + 1e-5::DOUBLE)) AS z FROM centred
)
SELECT vec_id, round(list_sum(list_transform(z, lambda x, i: x * i)), 6) AS weighted_sum FROM scaled""",
    "list_versions": t.with_ctes(
        _REGISTRY_SQL, body=" SELECT name, version, run, status FROM registry ORDER BY name, version DESC"
    ),
    "latest_version": t.with_ctes(
        _REGISTRY_SQL,
        body="""
SELECT name, max(version) AS version, 'models:/' || name || '/' || max(version) AS uri
FROM registry GROUP BY name""",
    ),
    "latest_checkpoint": """
SELECT user_id, max(event_id) AS step, printf('ckpt_step_%06d.pt', max(event_id)) AS path
FROM events GROUP BY user_id""",
    "config_hash": t.with_ctes(_CONFIG_SQL, body=" SELECT o_orderkey, config_hash FROM configured"),
    "run_tags": t.with_ctes(
        _CONFIG_SQL,
        body="""
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, unnest(['run_id', 'git_sha', 'config_hash',
         'delta_log_offset', 'profile', 'model_name', 'schema_version']) AS key,
       unnest([CAST(o_orderkey AS VARCHAR), sha1(CAST(o_orderkey AS VARCHAR)), config_hash,
         CAST(o_orderkey + 1 AS VARCHAR),
         CASE WHEN o_orderstatus = 'F' THEN 'final' ELSE o_orderpriority END,
         CAST(o_custkey AS VARCHAR), '1']) AS value
FROM configured
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 'val_accuracy', '0.5' FROM orders WHERE o_orderstatus = 'F'""",
    ),
    "run_manifest": t.with_ctes(
        _LOGITS_SQL,
        body="""
SELECT CAST(1 AS INTEGER) AS schema_version, 'run' AS run_id, 'unknown' AS git_sha,
       substr(sha256('{"name": "late_fusion"}'), 1, 16) AS config_hash,
       (SELECT max(event_id + 1) FROM events) AS delta_log_offset, 'cluster' AS profile,
       'late_fusion' AS model_name, CAST(max(label) + 1 AS BIGINT) AS num_classes,
       CAST(100 AS BIGINT) AS max_steps, round(avg(loss), 6) AS best_val_loss,
       round(avg(correct), 6) AS val_accuracy
FROM outcome""",
    ),
}
