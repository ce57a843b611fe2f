"""The metric range join of embeddings against all pairs compared plainly."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import metric_join
from shardloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.95):
    """(vec_id, n_links, component_id, kept) per row, all pairs compared in double precision."""
    vectors = []
    for _, e, _ in rows:
        ok = e is not None and len(e) > 0 and all(x is not None and math.isfinite(x) for x in e)
        v = np.array(e, np.float64) if ok else None
        vectors.append(v if ok and np.linalg.norm(v) > 0 else None)
    n = len(rows)
    linked = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i + 1, n):
            u, v = vectors[i], vectors[j]
            if u is None or v is None or len(u) != len(v):
                continue
            if float(u @ v) / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                linked[i].append(j)
                linked[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        cid = min(ids) if ids else None
        out.append((rows[i][0], len(linked[i]), cid, rows[i][0] == cid))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def awkward():
    rng = np.random.default_rng(5)
    base = rng.normal(size=8)
    near = base + rng.normal(scale=0.05, size=8)
    far = rng.normal(size=8)
    rows = [
        (1, base.tolist(), 0),
        (2, base.tolist(), 0),  # exact copy
        (3, (3 * base).tolist(), 1),  # scalar multiple: cosine 1
        (4, near.tolist(), 1),
        (5, far.tolist(), 2),
        (6, None, 2),
        (7, [], 2),
        (8, [0.0] * 8, 2),
        (9, [1.0, None] + [0.0] * 6, 2),
        (10, [float("nan")] + [1.0] * 7, 2),
        (11, [float("inf")] + [1.0] * 7, 2),
        (None, base.tolist(), 3),
        (None, None, 3),
        (12, base[:4].tolist(), 3),  # another length
        (13, base[:4].tolist(), 3),
        (5, far.tolist(), 2),  # repeated row
    ]
    return rows


@pytest.mark.parametrize("pivots, tile", [(16, 4096), (4, 2), (1, 1)])
def test_awkward_rows(spark, pivots, tile):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(metric_join.links(df, pivots=pivots, tile=tile)) == plain(rows)


@pytest.mark.parametrize("pivots, tile", [(16, 4096), (8, 7)])
def test_clusters_and_noise(spark, pivots, tile):
    """Near-copy groups of 2 to 40 vectors among random ones, cut into many tiles."""
    rng = np.random.default_rng(11)
    rows, k = [], 0
    for size in (2, 3, 5, 40):
        centre = rng.normal(size=16)
        for _ in range(size):
            rows.append((k, (centre + rng.normal(scale=0.08, size=16)).astype(np.float32).tolist(), 0))
            k += 1
    for _ in range(150):
        rows.append((k, rng.normal(size=16).astype(np.float32).tolist(), 1))
        k += 1
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(metric_join.links(df, pivots=pivots, tile=tile)) == plain(rows)


def test_empty_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert metric_join.links(empty).count() == 0
    rows = awkward()[:6]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("_e", "_v", "_in", "_ok", "_node", "_rep", "_m", "_len", "_cell", "_root", "_cid", "_links", "a", "b"):
        df = df.withColumn(name, F.lit(name))
    df = df.withColumn("n_links", F.lit(-1))
    out = metric_join.links(df)
    assert got(out) == plain(rows)
    assert all(r["_e"] == "_e" and r["_rep"] == "_rep" and r["label"] is not None for r in out.collect())


def test_query_on_testdata(spark):
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.01/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table]
    assert got(QUERIES["op11_embedding_dedup"](spark, "/root/testdata/sf0.01")) == plain(rows)
