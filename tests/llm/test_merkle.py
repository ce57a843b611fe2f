"""The Merkle manifest against a plain tree built level by level in Python."""

import hashlib
import zlib

import pytest
from fixtures import awkward, doc, frame
from pyspark.sql import functions as F

from shardloom.llm import merkle
from shardloom.llm.queries import QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    if v is None:
        return "-"
    s = str(v)
    return f"{len(s.encode())}:{s}"


def leaf(row):
    return h("".join(field(row[k]) for k in ("doc_id", "source", "lang", "n_chars", "text")))


def levels(nodes):
    """All levels from ``nodes`` up to a single node."""
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return out


def siblings(tree, index):
    """Sibling segments (left, right) per level of the node at ``index`` of level 0."""
    segs = []
    for level in tree[:-1]:
        start = index // 8 * 8
        run = level[start : start + 8]
        segs.append(("".join(run[: index - start]), "".join(run[index - start + 1 :])))
        index //= 8
    return segs


def plain(rows, tamper):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per row (order of ``rows``)."""
    rows = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]
    if not rows:
        return []
    for r in rows:
        r["leaf"] = leaf(r)
        alt = dict(r)
        if tamper(r) and r["text"] is not None:
            alt["text"] = r["text"].translate(LOWER)
        r["alt"] = leaf(alt)
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subtrees = {}
    for g in order:
        members = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"], r["alt"]))
        groups[g] = members
        subtrees[g] = levels([r["leaf"] for r in members])
    top = levels([subtrees[g][-1][0] for g in order])
    root = top[-1][0]
    out = {}
    for gi, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            segs = siblings(subtrees[g], i) + siblings(top, gi)
            cur = r["alt"]
            for left, right in segs:
                cur = h(left + cur + right)
            proof = "".join(a + b for a, b in segs)
            out[id(r)] = (r["doc_id"], r["leaf"], subtrees[g][-1][0], root, h(proof), cur, cur == root)
    return sorted(out.values(), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


def spark_rows(df):
    rows = [tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


def tamper_every_third(r):
    return r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0


def run(spark, rows, levels=merkle.LEVELS, **columns):
    docs = frame(spark, rows)
    for name, value in columns.items():
        docs = docs.withColumn(name, value)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    lowered = F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    built = merkle.build(docs, altered={"text": lowered.otherwise(F.col("text"))}, levels=levels)
    return built.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified"
    )


def test_awkward_rows(spark):
    rows = awkward() + [doc(20, "Upper AND lower", lang=None), doc(21, "ÄBC xyz", lang="de")]
    assert spark_rows(run(spark, rows)) == plain(rows, tamper_every_third)


@pytest.mark.parametrize("levels", [1, 2])
def test_rounds_recurse(spark, levels):
    """Small blocks make many rounds out of few rows; groups of 1, 8, 9, 64, 65 and 300 rows."""
    rows = []
    for lang, n in (("a", 1), ("b", 8), ("c", 9), ("d", 64), ("e", 65), ("f", 300), (None, 3)):
        rows += [doc(len(rows) + k, f"Text {k} Of {lang}", lang=lang) for k in range(n)]
    assert spark_rows(run(spark, rows, levels)) == plain(rows, tamper_every_third)


def test_one_row_and_empty(spark):
    one = [doc(7, "ONLY")]
    got = spark_rows(run(spark, one))
    assert got == plain(one, tamper_every_third)
    assert got[0][1] == got[0][2] == got[0][3]
    assert run(spark, []).count() == 0


def test_clashing_columns_pass_unchanged(spark):
    rows = [doc(k, f"t {k}") for k in range(20)]
    docs = frame(spark, rows)
    for name in ("_g", "_h", "_p", "_in", "_pos", "_n", "_s", "_b", "_alt", "_rank", "_id", "_part"):
        docs = docs.withColumn(name, F.lit(name))
    built = merkle.build(docs.withColumn("leaf", F.lit("mine")))
    assert set(built.columns) >= {"_g", "_in", "_pos", "leaf", "verified"}
    values = {r["doc_id"]: r for r in built.collect()}
    assert all(r["_g"] == "_g" and r["_s"] == "_s" for r in values.values())
    assert values[3]["leaf"] == leaf(dict(zip(("doc_id", "text", "lang", "source", "n_chars"), rows[3])))


def test_stored_blocks_hold_a_digest_once(spark, monkeypatch):
    """Blocks are written, dealt out and sorted as rows of 512 nodes; with every node's siblings spelled
    out such a row took some 700 KB, and tasks that held a few of them ran out of memory."""
    frames = []

    def recorded(df, purpose, store=merkle.stored):
        frames.append(store(df, purpose))
        return frames[-1]

    monkeypatch.setattr(merkle, "stored", recorded)
    rows = [doc(k, f"Text {k}", lang="a" if k < 1100 else "b") for k in range(1109)]
    got = spark_rows(run(spark, rows))
    blocks = [f for f in frames if "_nodes" in f.columns]
    assert sum(f.filter(F.size("_nodes") == 512).count() for f in blocks) == 2
    for f in blocks:
        payload = ["_p"] if "_p" in f.schema["_nodes"].dataType.elementType.names else []
        bare = f.withColumn("_nodes", F.transform("_nodes", lambda x: x.dropFields(*payload) if payload else x))
        text = F.to_json(F.struct(*bare.columns))
        for r in bare.select(F.octet_length(text).alias("size"), F.size("_nodes").alias("n")).collect():
            assert r["size"] <= 1000 + 200 * r["n"]
    assert got == plain(rows, tamper_every_third)


def test_query_on_testdata(spark):
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in table]
    got = spark_rows(QUERIES["op13_merkle"](spark, "/root/testdata/sf0.01"))
    assert got == plain(rows, tamper_every_third)
