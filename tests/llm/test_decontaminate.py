import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward, doc, frame, sentence

from shardloom.llm import decontaminate
from shardloom.llm.queries import QUERIES


def plain_best(item, text):
    cost = [0] * (len(text) + 1)
    for k, x in enumerate(item):
        new = [k + 1]
        for j, y in enumerate(text):
            new.append(min(cost[j] + (x != y), cost[j + 1] + 1, new[j] + 1))
        cost = new
    return min(cost)


def test_edit_distance_equals_the_plain_one():
    made = np.random.default_rng(6)
    for _ in range(300):
        item = made.integers(0, 5, made.integers(1, 12)).astype(np.uint64)
        text = made.integers(0, 5, made.integers(0, 20)).astype(np.uint64)
        edits, first, end = decontaminate.best_place(item, text)
        assert edits == plain_best(item, text)
        assert 0 <= first <= end <= len(text)
        # The place reported holds that many edits from end to end.
        assert plain_best(item, text[first:end]) == edits


def test_recall_reaches_the_target(spark):
    items = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()
    ids, texts = [r["item_id"] for r in items], [r["text"] for r in items]
    walks, recall = decontaminate.repetitions(ids, texts)
    assert recall >= decontaminate.RECALL and walks <= decontaminate.MOST_WALKS
    # On other edits than those the number of walks was chosen with.
    index, made = decontaminate.build(ids, texts, walks), np.random.Generator(np.random.PCG64(12345))
    found = 0
    for i, size in enumerate(index.sizes.tolist()):
        item = index.stream[index.first[i] : index.first[i] + size]
        copy = decontaminate._edited(item, int(size * decontaminate.RATE), made)
        stream = np.concatenate([made.integers(1 << 60, size=30).astype(np.uint64) | np.uint64(1), copy, [np.uint64(0)]])
        found += any(m[1] == i for m in decontaminate.matches(index, stream, np.array([0, len(stream)])))
    assert found / len(index.ids) > 0.95


def planted():
    items = [(1, sentence(200, 20)), (2, sentence(201, 40)), (3, "too short"), (4, None), (None, sentence(202, 30)), (2, sentence(201, 40))]
    w = items[1][1].split()
    edited = " ".join(["other" if k in (3, 17, 30) else x for k, x in enumerate(w) if k != 25] + ["!"])
    rows = awkward() + [
        doc(50, f"{sentence(300, 40)} {items[0][1].upper()} {sentence(301, 10)}"),
        doc(51, edited),
        doc(52, f"{sentence(302, 400)}\n{' '.join(w[:19])}"),  # half of an item is none
        doc(53, f"too short {sentence(303, 50)} {items[4][1]}"),
        doc(54, f"{items[0][1]} {sentence(304, 30)} {items[0][1]}"),
    ]
    return items, rows


@pytest.mark.parametrize("block_words", [200_000, 4])
def test_planted_items(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    items, rows = planted()
    bench = frame(spark, items, "item_id long, text string")
    docs = frame(spark, rows).selectExpr("*", "'x' AS item_id", "5 AS edits")
    found = decontaminate.find(docs, bench).collect()
    got = sorted((r["doc_id"], r["item_id"] or 0, r["first_word"], r["end_word"], r["edits"]) for r in found)
    assert [g for g in got if g[0] != 51] == [
        (50, 1, 40, 60, 0),
        (53, 0, 52, 82, 0),
        (54, 1, 0, 20, 0),
        (54, 1, 50, 70, 0),
    ]
    assert [(g[1], g[4]) for g in got if g[0] == 51] == [(2, 4), (2, 4)]  # the item is there twice
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    assert ids == sorted(str(r[0]) for r in rows if r[0] not in (50, 51, 53, 54))


def test_empty_tables(spark):
    items, rows = planted()
    bench, docs = frame(spark, items, "item_id long, text string"), frame(spark, rows)
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.clean(docs.limit(0), bench).count() == 0


def test_query_finds_what_documents_hold_word_by_word(spark):
    folder = "/root/testdata/sf0.01"
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op3_decontamination"](spark, folder).collect()}
    items = {r["item_id"]: r["text"].lower().split() for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: r["text"].lower().split() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = set()
    for i, w in items.items():
        rare = set(w)
        for d, text in docs.items():
            if len(rare & set(text)) >= 0.75 * len(rare) and plain_best(w, text) <= int(0.2 * len(w)):
                want.add((d, i))
    assert found == want and found


def test_walks_of_equal_words_agree():
    a = decontaminate.symbols(pa.array([sentence(9, 40)]))[0]
    b = decontaminate.symbols(pa.array([f"{sentence(8, 13)} {sentence(9, 40).upper()}"]))[0]
    one = list(decontaminate.signatures(a, np.array([0, 5]), 2))
    two = list(decontaminate.signatures(b, np.array([13, 18]), 2))
    assert all((x[1] == y[1]).all() for x, y in zip(one, two))
