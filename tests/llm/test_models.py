import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from fixtures import LOWER, awkward, frame, split
from pyspark.sql import functions as F

from shardloom.llm import context_mixing, lm_scoring, quality_model
from shardloom.llm.frames import unsqueeze
from shardloom.llm.queries import QUERIES
from shardloom.llm.text import words

FOLDER = "/root/testdata/sf0.01"


def test_quality_on_rows_it_has_not_learned_from(spark):
    rows = QUERIES["op1_quality"](spark, FOLDER).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    usual = max(collections.Counter(labels[r["doc_id"]] for r in held).values()) / len(held)
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held)
    assert right > max(0.9, usual)


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    changed = labels.withColumn("quality", F.when(fold == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality_model.score(docs, x, fold != 2, keep=["doc_id"]).collect() for x in (labels, changed))
    assert sorted(one) == sorted(two)


def test_quality_of_awkward_rows(spark):
    docs = frame(spark, awkward()).selectExpr("*", "'x' AS score", "'v' AS _vector")
    labels = frame(spark, [(1, 0), (4, 1), (4, 1), (10, 0), (5, None), (None, 1), (77, 1)], "doc_id long, quality int")
    rows = quality_model.score(docs, labels, F.lit(True)).collect()
    assert len(rows) == len(awkward()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not split(r["text"])}) == 1
    nothing = quality_model.score(docs, labels.limit(0), F.lit(True)).collect()
    assert {r["score"] for r in nothing} == {0.5}
    assert quality_model.score(docs.limit(0), labels, F.lit(True)).count() == 0


def test_temperature_makes_scores_probabilities():
    made = np.random.default_rng(8)
    x = made.normal(size=(4000, 2 * quality_model.DIM)).astype(np.float32)
    chance = 1 / (1 + np.exp(-2 * x[:, 0] - 1))
    y = (made.random(4000) < chance).astype(float)
    net = quality_model.fit(x[:3000], y[:3000], np.arange(3000) % 5 == 0)
    scores = net.scores(x[3000:])
    for low in (0.0, 0.25, 0.5, 0.75):
        part = (scores >= low) & (scores < low + 0.25)
        assert abs(scores[part].mean() - chance[3000:][part].mean()) < 0.12


# --- language model ---------------------------------------------------------------------------------------


def plain_base(rows, held):
    tokens = [[*split((t or "").translate(LOWER)), "\n"] for t in rows]
    counts = collections.Counter(x for t, h in zip(tokens, held) if not h for x in t)
    n, v = sum(counts.values()), len(counts)
    size = math.log10(n + 0.5 * (v + 1))
    return [(len(t), sum(counts[x] > 0 for x in t), n, sum(math.log10(counts[x] + 0.5) - size for x in t)) for t in tokens]


def check_base(rows, docs, held):
    want = collections.Counter()
    for d, h, (n, known, all_, base) in zip(docs, held, plain_base([d["text"] for d in docs], held)):
        want[d["doc_id"], h, n, known, all_, round(base, 5)] += 1
    got = collections.Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows
    )
    assert got == want


@pytest.mark.parametrize("size, beats", [("sf0.01", False), ("sf0.1", True)])
def test_base_is_exact_and_what_the_model_is_worth(spark, size, beats):
    """The base gives every new token the mass of one class, the model spells it out: with little to learn
    from, most rare tokens are new and the base is ahead; from some millions of tokens on the model is."""
    folder = f"/root/testdata/{size}"
    rows = QUERIES["op2_lm_scoring"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    check_base(rows, docs, [zlib.crc32(str(d["doc_id"]).encode()) % 5 == 1 for d in docs])
    held = [r for r in rows if r["held_out"]]
    share = sum(r["score"] for r in held) / sum(r["base_score"] for r in held)
    assert share < (1.0 if beats else 1.1)
    assert all(r["score"] < 0 for r in rows)


def test_awkward_texts_and_nothing_to_learn_from(spark):
    docs = frame(spark, awkward()).selectExpr("*", "coalesce(doc_id = 5, false) AS held_out", "1 AS score", "'k' AS k1")
    rows = lm_scoring.score(docs, ~F.col("held_out")).collect()
    check_base(rows, [r.asDict() for r in docs.collect()], [r["held_out"] for r in docs.collect()])
    assert len({round(r["score"], 9) for r in rows if not split(r["text"])}) == 1
    nothing = lm_scoring.score(docs, F.lit(False)).collect()
    assert all(math.isfinite(r["score"]) and r["n_known"] == 0 and abs(r["base_score"]) < 1e-9 for r in nothing)
    assert lm_scoring.score(docs.limit(0), F.lit(True)).count() == 0


def test_chances_of_a_bit_add_up_and_spelling_is_learned():
    texts = pa.array(["the cat sat on the mat " * 30, "a dog sat on the cat " * 40])
    learner = context_mixing.Learner()
    before = learner.model.costs(context_mixing.Units(words(texts))).sum()
    for _ in range(3):
        learner.add(context_mixing.Units(words(texts)))
    units = context_mixing.Units(words(texts))
    assert learner.model.costs(units).sum() > 0.3 * before
    for slots, node, _ in context_mixing._bits(units, 0, len(units.place)):
        p = learner.model.refined(node, learner.model.mixed(slots)[2])
        assert ((p > 0) & (p < 1)).all()
    # Over all next bytes the chances add up to one.
    total = 0.0
    for b in range(256):
        one = context_mixing.Units(words(pa.array(["xyz"])))
        one.data = one.data.copy()
        one.data[one.place[0]] = b
        chance = 1.0
        for slots, node, bit in context_mixing._bits(one, 0, 1):
            p = learner.model.refined(node, learner.model.mixed(slots)[2])[0]
            chance *= p if bit[0] else 1 - p
        total += chance
    assert abs(total - 1) < 1e-5  # probabilities are 32-bit floats


def test_little_text_corrects_every_bit_and_untaught_weights_do_not_count():
    learner = context_mixing.Learner()
    learner.add(context_mixing.Units(words(pa.array(["the cat sat on the mat with a hat and a bat in a vat " * 30]))))
    cases = learner.model.cases.reshape(256, -1).sum(axis=1)
    of_bit = [cases[1 << j : 2 << j].sum() for j in range(8)]
    assert of_bit[0] > 0 and max(of_bit) == min(of_bit)
    idle = context_mixing.Learner()
    idle.add(context_mixing.Units(words(pa.array(["x"]))))
    built, summed = context_mixing.Assembly(), {}
    for one in (learner, idle):
        for batch in one.blocks():
            for block, payload in zip(*(c.to_pylist() for c in batch.columns)):
                summed[block] = summed.get(block, 0) + unsqueeze(payload, "float64")
    for block, cells in summed.items():
        built.add(block, cells)
    assert np.allclose(built.done().weights, learner.model.weights, atol=1e-6)
    assert not np.allclose(learner.model.weights, 0.3)


def test_every_byte_of_a_long_new_token_counts(spark):
    made = np.random.default_rng(3)
    texts = ["".join(made.choice(list("abcdefghijklmnop"), n)) for n in (2_000, 20_000, 200_000)]
    docs = frame(spark, [(k, t, "en", "s", len(t)) for k, t in enumerate(["some words to learn from " * 50, *texts])])
    rows = {r["doc_id"]: r for r in lm_scoring.score(docs, F.col("doc_id") == 0).collect()}
    for k in (2, 3):
        assert 8 < rows[k]["score"] / rows[k - 1]["score"] < 12
        assert abs(rows[k]["bits_per_byte"] / rows[1]["bits_per_byte"] - 1) < 0.1
