"""Tokenizer alignment against a plain version that compares every A token with every B token."""

import hashlib

import public_tokenizers as P
import pyarrow.parquet as pq
import sentencepiece
from fixtures import awkward, doc, frame, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shardloom.llm import alignment
from shardloom.llm.queries import QUERIES

A_PATH, B_PATH = (str(P.path(f)) for f in (alignment.A_FILE, alignment.B_FILE))

def tables():
    t = Tokenizer.from_file(A_PATH); t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    bs = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    cs = bs[:]; n = 0
    for x in range(256):
        if x not in bs: bs.append(x); cs.append(256 + n); n += 1
    dec = {chr(c): x for x, c in zip(bs, cs)}
    A = {i: bytes(dec[ch] for ch in s) for s, i in t.get_vocab(with_added_tokens=True).items()}
    B = {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        B[i] = bytes([int(p[3:5], 16)]) if (len(p) == 6 and p.startswith('<0x')) else p.replace('▁', ' ').encode()
    return t, sp, A, B

def one(text, t, sp, A, B):
    if not text:
        return None
    a = t.encode(' ' + text, add_special_tokens=False).ids
    b = sp.encode(text)
    full = (' ' + text).encode()
    if b''.join(A[i] for i in a) != full or b''.join(B[i] for i in b) != full:
        return None
    ra, pos = [], 0
    for i in a: ra.append((pos, pos + len(A[i]), i)); pos += len(A[i])
    rb, pos = [], 0
    for i in b: rb.append((pos, pos + len(B[i]), i)); pos += len(B[i])
    links = [(x[2], y[2]) for x in ra for y in rb if x[0] < y[1] and y[0] < x[1]] if len(ra) * len(rb) < 4e6 else None
    if links is None:  # long texts: the same relation by a sweep
        links, j = [], 0
        for x in ra:
            while j < len(rb) and rb[j][1] <= x[0]: j += 1
            k = j
            while k < len(rb) and rb[k][0] < x[1]:
                if rb[k][1] > x[0] and x[1] > x[0] and rb[k][1] > rb[k][0]: links.append((x[2], rb[k][2]))
                k += 1
    ea, eb = {x[1] for x in ra}, {y[1] for y in rb}
    cuts = sorted(ea & eb)
    groups, gi, ia, ib = [], 0, 0, 0
    for c in cuts:
        ga, gb = [], []
        while ia < len(ra) and ra[ia][1] <= c: ga.append(ra[ia][2]); ia += 1
        while ib < len(rb) and rb[ib][1] <= c: gb.append(rb[ib][2]); ib += 1
        groups.append(','.join(map(str, ga)) + '|' + ','.join(map(str, gb)))
    return len(a), len(b), len(cuts), links, ';'.join(groups)

def plain(rows):
    """rows: (doc_id, text) -> sorted (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    t, sp, A, B = tables()
    done = [(d, one(x, t, sp, A, B)) for d, x in rows]
    count = {}
    for _, r in done:
        if r:
            for pair in set(r[3]): count[pair] = count.get(pair, 0) + 1
    most = {}
    for (a, b), c in count.items(): most[a] = max(most.get(a, 0), c)
    out = []
    for d, r in done:
        if not r:
            out.append((d, 0, 0, 0, 0, 0, 0, '')); continue
        links = r[3]
        out.append((d, r[0], r[1], r[2], len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(r[4].encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_awkward_rows(spark):
    rows = awkward() + [
        doc(30, "<|endoftext|> and <s> or </s> stay text"),
        doc(31, "ﬁne ligature, Ａ wide letter, no-break\xa0space"),
        doc(32, "two  spaces   and\ttabs\nand lines"),
        doc(33, "Zürich 東京 🙂 ünïcödé"),
        doc(34, "the the the the the"),
        doc(35, "the the the the the"),
    ]
    docs = frame(spark, rows)
    out = alignment.align(docs, A_PATH, B_PATH)
    assert got(out) == plain([(r[0], r[1]) for r in rows])
    ranked = alignment.align(docs, A_PATH, B_PATH, a_ranks=str(P.path(alignment.A_RANKS)))
    assert got(ranked) == got(out)
    none = out.filter("doc_id IN (1, 2)").collect()
    assert [(r["n_a"], r["n_links"], r["groups_sha256"]) for r in none] == [(0, 0, "")] * 2


def test_many_chunks_and_planes(spark):
    """Chunks of four documents and repeated links: containers cross chunks and planes, as lists and maps."""
    rows = [doc(k, (sentence(k % 3, 20) + " ") * (1 + k % 5)) for k in range(30)]
    docs = frame(spark, rows).repartition(3)
    assert got(alignment.align(docs, A_PATH, B_PATH, chunk_bits=2)) == plain([(r[0], r[1]) for r in rows])


def test_sets_round_trip():
    import numpy as np

    for places in (np.array([0, 5, 65535]), np.arange(0, 65536, 3)):
        assert np.array_equal(alignment.decode_set(alignment.encode_set(places)), places)
    assert np.array_equal(alignment.decode_set(alignment.encode_set(np.array([0, 2, 3]), 2)), [0, 2, 3])


def test_empty_and_clashing_names(spark):
    assert alignment.align(frame(spark, []), A_PATH, B_PATH).count() == 0
    rows = [doc(1, "alpha beta"), doc(2, "beta gamma")]
    docs = frame(spark, rows)
    for name in ("_in", "_text", "_kind", "_doc", "_pair", "_chunk", "_plane", "_payload", "_bits", "_count", "_top", "_sum"):
        docs = docs.withColumn(name, F.lit(name))
    out = alignment.align(docs.withColumn("n_links", F.lit(-1)), A_PATH, B_PATH, spelled=True)
    assert got(out) == plain([(r[0], r[1]) for r in rows])
    first = out.filter("doc_id = 1").first()
    assert first["_pair"] == "_pair" and first["_in"] == "_in"
    assert hashlib.sha256(first["groups"].encode()).hexdigest() == first["groups_sha256"]


def test_query_on_testdata(spark):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    expected = plain([(r["doc_id"], r["text"]) for r in table])
    assert got(QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.01")) == expected
