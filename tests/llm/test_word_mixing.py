import numpy as np
import pyarrow as pa
import pytest
from fixtures import frame, split
from pyspark.sql import functions as F

from shardloom.llm import context_mixing, lm_scoring, word_mixing
from shardloom.llm.text import kinds, sorting, words

TALE = "the cat sat on a mat while some dog ran over that hill to find its old red ball . "


def tokens_of(symbols, topic=None):
    n = len(symbols)
    topic = np.zeros(n, np.int64) if topic is None else topic
    return word_mixing.Tokens(np.array(symbols), topic, np.array(symbols, np.uint64) + np.uint64(7), np.zeros(n, np.int64))


def taught(counts, symbols):
    learner = word_mixing.Learner(word_mixing.Model(word_mixing.Code(np.array(counts, float)), 2, 16))
    for _ in range(3):
        learner.add(tokens_of(symbols))
    return learner


def test_the_word_before_decides_about_frequent_words_too(spark):
    """The same words in another order have the same counts, topics and base, but not the same score."""
    shuffled = " ".join(np.random.default_rng(5).permutation((TALE * 20).split()))
    docs = frame(spark, [(k, t, "en", "s", len(t)) for k, t in enumerate([TALE * 300, TALE * 20, shuffled])])
    rows = {r["doc_id"]: r for r in lm_scoring.score(docs, F.col("doc_id") == 0).collect()}
    assert abs(rows[1]["base_score"] - rows[2]["base_score"]) < 1e-6
    assert rows[1]["n_known"] == rows[1]["n_tokens"] == len(split(TALE * 20)) + 1
    assert rows[1]["score"] > 0.3 * rows[2]["score"] and rows[1]["score"] > 0.3 * rows[1]["base_score"]


@pytest.mark.parametrize("counts", [[5, 5], [0, 0], [900, 3, 1, 40, 40, 7, 0, 0, 2], list(range(70))])
def test_chances_of_all_codes_add_up(counts):
    made = np.random.default_rng(2).integers(0, len(counts), 500)
    model = taught(counts, made).model
    for before in (0, len(counts) - 1):
        total = sum(np.exp(model.costs(tokens_of([before, before, k]))[2]) for k in range(len(counts)))
        assert abs(total - 1) < 1e-4


def test_codes_are_those_of_huffman_and_differ():
    code = word_mixing.Code(np.array([50, 20, 10, 10, 5, 5], float))
    paths = ["".join(map(str, code.bit[s : s + n])) for s, n in zip(code.start, code.size)]
    assert sorted(map(len, paths)) == [1, 2, 4, 4, 4, 4] or sum(2.0 ** -len(p) for p in paths) == 1
    assert not any(a != b and b.startswith(a) for a in paths for b in paths)
    assert len(paths[0]) == 1 and code.odds.shape == (5,)


def test_every_bit_teaches_and_merging_tasks_keeps_what_one_task_learned():
    made = np.random.default_rng(4).integers(0, 9, 800)
    learner = taught([30] * 9, made)
    model = learner.model
    first = learner.model.code.size[made[: word_mixing.FIRST_STEP]].sum()  # counted before anything could be predicted
    assert model.cases.sum() == 3 * model.code.size[made].sum() - first == learner.taught
    built = word_mixing.Assembly(word_mixing.Model(model.code, 2, 16))
    for batch in learner.blocks():
        for block, payload in zip(*(c.to_pylist() for c in batch.columns)):
            built.add(block, lm_scoring.unsqueeze(payload, "float64"))
    done = built.done()
    assert (done.odds == model.odds).all() and np.allclose(done.weights, model.weights)
    assert np.allclose(done.costs(tokens_of(made)), model.costs(tokens_of(made)))


def test_frequent_tokens_are_found_by_both_digests():
    rng = np.random.default_rng(6)
    frequent = np.zeros(500, lm_scoring.TOTALS)
    frequent["a"], frequent["b"], frequent["n"] = rng.integers(2, 1 << 47, 500), rng.integers(0, 1 << 32, 500), 9
    frequent[0] = (1, 1, 0)
    frequent = np.sort(frequent, order=["a", "b"])
    known = lm_scoring.Known(1000, 500, 1, frequent, np.arange(3), 1)
    asked = rng.permutation(500)
    assert (known.places(frequent["a"][asked], frequent["b"][asked]) == asked).all()
    assert (known.places(frequent["a"], frequent["b"] + np.uint32(1)) == -1).all()
    assert (known.places(frequent["a"] + np.uint64(1 << 50), frequent["b"]) == -1).all()


def test_words_cut_out_are_spelled_as_in_a_text():
    text = "one twoé three"
    found = words(pa.array([text]))
    whole = context_mixing.Units(found)
    learner = context_mixing.Learner()
    learner.add(whole)
    start, size = lm_scoring.spans(found)
    assert size.tolist() == [3, 5, 5, 0]
    data = lm_scoring.cut_out(found.data, start[1:3], size[1:3])
    assert data.tobytes() == "twoéthree".encode()
    # "three" stands behind a letter of two bytes, which counts like any letter.
    alone = context_mixing.Units.of_words(data, size[1:3], np.ones(2))
    want = learner.model.costs(whole)[whole.of[1:3]]
    assert np.allclose(learner.model.costs(alone), want, atol=1e-6)


def test_equal_bytes_in_equal_contexts_are_priced_once_and_cost_the_same(monkeypatch):
    made = np.random.default_rng(8)
    text = ["".join(made.choice(["tion", "er", "an", "th", "é", "x"], n)) for n in made.integers(1, 9, 400)]
    size = np.array([len(t.encode()) for t in text])
    data = np.frombuffer("".join(text).encode(), np.uint8)
    learner = context_mixing.Learner()
    learner.add(context_mixing.Units.of_words(data, size, made.integers(1, 5, len(size))))
    model, plain, priced = learner.model, context_mixing.Model.mixed, []
    start = np.cumsum(size) - size
    want = [
        model.costs(context_mixing.Units.of_words(data[s : s + n], size[k : k + 1], np.ones(1)))[0]
        for k, (s, n) in enumerate(zip(start, size))
    ]
    monkeypatch.setattr(context_mixing.Model, "mixed", lambda m, slots: priced.append(slots.shape[1]) or plain(m, slots))
    got = model.costs(context_mixing.Units.of_words(data, size, np.ones(len(size))))
    assert np.allclose(got, want, atol=1e-12)
    different = {(t[max(k - 6, 0) : k], min(k, 6), t[k]) for t in ((" " + t + " ").encode() for t in text) for k in range(1, len(t))}
    assert sum(priced) == 8 * len(different) < 8 * (size + 1).sum() / 2


def test_tokens_cost_the_same_together_and_one_by_one():
    made = np.random.default_rng(9).integers(0, 70, 700)
    model = taught(list(range(70)), made).model
    tokens = tokens_of(made)
    alone = tokens_of(made[:1])
    want = []
    for k in range(len(made)):
        alone.symbols, alone.topic, alone.contexts = made[k : k + 1], tokens.topic[k : k + 1], tokens.contexts[:, k : k + 1]
        want.append(model.costs(alone)[0])
    assert np.allclose(model.costs(tokens), want, atol=1e-12)


def test_topics_are_counted_as_bit_by_bit():
    made = np.random.default_rng(10).integers(0, 9, 500)
    topic = np.random.default_rng(11).integers(0, 2, 500)
    learner = word_mixing.Learner(word_mixing.Model(word_mixing.Code(np.full(9, 30.0)), 2, 16))
    code, nodes = learner.model.code, learner.model.nodes
    for _ in range(2):  # the first piece is counted bit by bit, others by equal tokens of a topic
        learner.add(tokens_of(made, topic))
    want = np.zeros((2 * nodes, 2))
    for s, t in zip(made, topic):
        path = slice(code.start[s], code.start[s] + code.size[s])
        want[t * nodes + code.node[path], code.bit[path]] += 2
    assert (learner.counts[: 4 * nodes].reshape(-1, 2) == want).all()


@pytest.mark.parametrize("shift", [0, 1, 40])
def test_digests_are_sorted_by_all_their_bits(shift):
    made = np.random.default_rng(12).integers(0, 300, 2000).astype(np.uint64) << np.uint64(shift)
    assert (sorting(made) == np.argsort(made, kind="stable")).all()
    first, of, times = kinds(made)
    values, want, inverse, n = np.unique(made, return_index=True, return_inverse=True, return_counts=True)
    assert (first == want).all() and (of == inverse).all() and (times == n).all()
    assert len(sorting(made[:0])) == 0 and [len(x) for x in kinds(made[:0])] == [0, 0, 0]
