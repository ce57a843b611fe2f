import collections
import hashlib
import os

import pytest
from fixtures import awkward, doc, frame, sentence, split

from shardloom.llm import substrings
from shardloom.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(texts, window=35):
    words = [split(t) for t in texts]
    counts = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_equals_the_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = {d["doc_id"]: p for d, p in zip(docs, plain([d["text"] for d in docs]))}
    rows = QUERIES["op9_substring_dedup"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, gone, left = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"]) == (n, gone)
        assert r["kept_sha256"] == hashlib.sha256(left.encode()).hexdigest()


def shared_passages():
    p, q = sentence(50, 60), sentence(51, 34)
    rows = awkward()
    rows += [doc(20, f"{sentence(60, 40)} {p} {sentence(61, 20)}"), doc(21, f"{p}\n\n{sentence(62, 50)}")]
    rows += [doc(22, f"{q} {sentence(63, 3)}"), doc(23, f"{q} {sentence(64, 3)}")]  # one word too short
    rows += [doc(24, " ".join(["same"] * 200)), doc(25, f"{sentence(65, 36)} {sentence(65, 36)}")]
    rows += [doc(30 + k, f"{sentence(70 + k, 9)} {sentence(49, 44)}") for k in range(60)]
    return rows


@pytest.mark.parametrize("width, chunk", [(None, None), (1 << 16, None), (None, 50), (1 << 16, 1000)])
def test_awkward_texts_and_small_sketches(spark, monkeypatch, width, chunk):
    """A sketch with hardly any cells and tiny chunks give the same result."""
    if chunk:
        monkeypatch.setattr(substrings, "CHUNK", chunk)
    rows = shared_passages()
    docs = frame(spark, rows).repartition(5).selectExpr("*", "'x' AS n_words", "'k' AS k1", "1 AS payload")
    out = substrings.remove_repeats(docs, width=width).collect()
    want = collections.Counter((r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows])))
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in out) == want
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_equal_windows_have_equal_anchors():
    import pyarrow as pa

    from shardloom.llm.text import words

    p = sentence(5, 35)
    found = words(pa.array([f"{sentence(6, 11)} {p} {sentence(7, 5)}", p]))
    first, anchors, _ = substrings.anchored(found)
    at = {int(f): int(a) for f, a in zip(first, anchors)}
    assert at[11] == at[int(found.first[1])]


def test_a_short_passage_in_all_texts_fills_no_bucket():
    """Windows over it share their anchors and are distinct: they spread over all buckets."""
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    from shardloom.llm.frames import unsqueeze

    n, buckets, width = 600, 64, 1 << 16
    passage = sentence(1, 30)
    texts = [f"{sentence(2 * k + 10, 24)} {passage} {sentence(2 * k + 11, 24)}" for k in range(n)]
    keys = pa.array(range(n), pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, keys, pa.array(texts)], ["k1", "k2", "_text"])
    bits = SimpleNamespace(value=np.full((substrings.ROWS, width // 8), 255, np.uint8))
    sizes = collections.Counter()
    for part in substrings._candidates(bits, width, buckets, substrings.WINDOW, substrings.ANCHOR)(iter([batch])):
        for bucket, k1, payload in zip(*(part.column(c).to_pylist() for c in ("bucket", "k1", "payload"))):
            if k1 is None:
                data = unsqueeze(payload, np.uint8)
                texts_in = int(data[:8].view("<i8")[0])
                sizes[bucket] += (len(data) - 8 - 16 * texts_in) // substrings._WINDOWS.itemsize
    assert sum(sizes.values()) == n * (78 - 35 + 1)
    assert max(sizes.values()) < 1.5 * sum(sizes.values()) / buckets
