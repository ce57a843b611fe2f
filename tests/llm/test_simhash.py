import numpy as np
import pytest
import xxhash
from fixtures import LOWER, awkward, doc, frame, sentence, split

from shardloom.llm import simhash
from shardloom.llm.components import roots
from shardloom.llm.queries import QUERIES


def plain_fingerprint(text):
    w = split((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in distinct}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_the_plain_version(spark, folder):
    rows = {r["doc_id"]: r for r in QUERIES["op8_simhash"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    fps = {d["doc_id"]: plain_fingerprint(d["text"]) for d in docs}
    root = plain_components(list(fps.values()))
    low = {}
    for i, f in fps.items():
        low[root[f]] = min(low.get(root[f], i), i)
    assert len(rows) == len(docs)
    for i, f in fps.items():
        assert rows[i]["fingerprint"] == f"{f:016x}"
        assert rows[i]["component_id"] == low[root[f]]


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def near_and_far():
    """Dense and loose clusters, chains of four bits, and fingerprints of their own."""
    made = np.random.default_rng(4)
    fps = set()
    for spread, n in ((3, 90), (6, 60), (2, 5)):
        base = int(made.integers(1 << 63))
        for _ in range(n):
            x = base
            for b in made.integers(0, 64, made.integers(0, spread)):
                x ^= 1 << int(b)
            fps.add(x)
    x = int(made.integers(1 << 63))
    for k in range(12):
        x ^= 0b1111 << (4 * k)
        fps.add(x)
    return fps | {int(v) for v in made.integers(1 << 63, size=60)} | {0, (1 << 64) - 1, 0xF}


@pytest.mark.parametrize("crowd", [2, 8, 48])
def test_no_link_is_lost(spark, crowd):
    fps = sorted(near_and_far())
    found = simhash.classes(frame(spark, [(_signed(f),) for f in fps], "fp long"), crowd).collect()
    got = {r["fp"] % (1 << 64): r["root"] for r in found}
    want = plain_components(fps)
    groups, plain = {}, {}
    for f in fps:
        groups.setdefault(got.get(f, _signed(f)), set()).add(f)
        plain.setdefault(want[f], set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_components_of_chains_and_stars(spark):
    links = [(k + 1, k) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2)]
    found = {r["node"]: r["root"] for r in roots(frame(spark, links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}}
    assert roots(frame(spark, [], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    docs = frame(spark, awkward())
    marked = simhash.fingerprints(docs.selectExpr("*", "'x' AS fp", "9 AS component_id"))
    rows = simhash.components(marked).collect()
    assert len(rows) == len(awkward())
    for r in rows:
        assert r["fp"] % (1 << 64) == plain_fingerprint(r["text"])
    assert {r["component_id"] for r in rows if not split(r["text"])} == {1}
    assert simhash.components(simhash.fingerprints(docs.limit(0))).count() == 0


def test_one_row_of_each_group_stays(spark):
    same = sentence(2, 80)
    docs = frame(spark, [*awkward(), doc(None, "alone without an id " + sentence(8, 60)), doc(6, same, "t")])
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, [1, 4, 5, 8, 9, 10, None]))
    assert simhash.one_of_each(docs.limit(0)).count() == 0
    twice = frame(spark, [doc(3, same), doc(3, same), doc(3, same, "t")])
    assert simhash.one_of_each(twice).count() == 1
