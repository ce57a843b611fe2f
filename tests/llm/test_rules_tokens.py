import collections
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from fixtures import awkward, frame, split

from shardloom.llm import quality_rules, tokens
from shardloom.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


def plain_counts(text):
    w = split(text)
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, again, len(covered)


@pytest.mark.parametrize("source", ["awkward", "documents"])
def test_counts_equal_the_plain_ones(spark, source):
    docs = frame(spark, awkward()) if source == "awkward" else spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = quality_rules.judge(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n, chars, symbols, again, twice = plain_counts(r["text"])
        assert (n, chars, symbols, again, twice) == tuple(r[c] for c in quality_rules.COUNTS)
        assert r["base_failed"] == (n < 50 or 100 * twice > 50 * n)
        assert not (r["kept"] and r["base_failed"])


def test_verdicts_follow_the_labels(spark):
    judged = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), keep=["doc_id"])
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = judged.filter("not base_failed").join(labels, "doc_id").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows) / len(rows)
    assert right > 0.98 and {r["quality"] for r in rows} == {0, 1}


def test_estimate_by_hand():
    """Two good patterns and one bad: the posterior separates them whatever the order of patterns."""
    n = len(quality_rules.RULES)
    good, bad = sum(2 * 3**k for k in range(n)), sum(2 * 3**k for k in range(2, n))
    one = quality_rules.estimate(np.array([good, bad]), np.array([900.0, 100.0]))["posterior"]
    two = quality_rules.estimate(np.array([bad, good]), np.array([100.0, 900.0]))["posterior"]
    assert one[0] > 0.9 > 0.1 > one[1] and np.allclose(one, two[::-1], atol=1e-6)
    assert len(quality_rules.estimate(np.zeros(0, int), np.zeros(0))["posterior"]) == 0


def test_clashing_columns_and_empty_tables(spark):
    docs = frame(spark, awkward()).selectExpr("*", "'x' AS kept", "'y' AS votes", "1 AS posterior", "'z' AS n_words")
    rows = quality_rules.judge(docs).collect()
    assert len(rows) == len(awkward()) and isinstance(rows[0]["kept"], bool)
    assert quality_rules.judge(docs.limit(0)).count() == 0
    clashing = tokens.count_tokens(docs.withColumn("n_tokens", docs.kept), MODEL)
    assert clashing.columns.count("n_tokens") == 1 and clashing.count() == len(awkward())
    assert tokens.count_tokens(docs.limit(0), MODEL).count() == 0


def test_token_counts_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").union(frame(spark, awkward()))
    for r in tokens.count_tokens(docs, MODEL).collect():
        assert r["n_tokens"] == len(library.encode(r["text"] or ""))
        assert r["n_bytes"] == len((r["text"] or "").encode())
        assert r["over_limit"] == (r["n_tokens"] > 4096)


def test_token_counts_of_odd_texts():
    library, work = tokens.model(MODEL), tokens._counter(MODEL)
    made = np.random.default_rng(3)
    parts = [" ", "  ", "\n", "a", "the", "▁", "é", "<s>", "</s>", "<0x0A>", "\t", "　", "日本", "\x00", " \n", "\n ", "😀", "1234", "\r\n"]
    texts = ["".join(made.choice(parts, made.integers(0, 12))) for _ in range(5000)] + [None, "", " "]
    counts = work(pa.array(texts))[1].to_pylist()
    assert counts == [len(x) for x in library.encode([t or "" for t in texts])]


def test_every_string_taken_as_one_token_is_one():
    library, known = tokens.model(MODEL), tokens.facts(MODEL)
    assert known.splits
    for s in sorted(known.alone)[::97]:
        ids = library.encode(s[1:]) if s.startswith(" ") and len(s) > 1 else library.encode("\n" + s)[2:]
        assert len(ids) == 1


def test_registered(spark):
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert QUERIES["op4_token_counts"](spark, FOLDER).count() == n
    assert QUERIES["op6_quality_rules"](spark, FOLDER).count() == n
