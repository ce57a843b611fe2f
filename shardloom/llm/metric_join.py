"""Near-duplicate embeddings by an exact metric range join.

Cosine similarity of at least ``threshold`` is, for vectors scaled to length one, a Euclidean distance of
at most ``r = sqrt(2 - 2 * threshold)``. A bounded set of pivots, drawn from the vectors by hash,
partitions them: every vector lives in the cell of its nearest pivot (its home). If ``u`` lives in cell
``i`` and ``d(u, v) <= r``, the triangle inequality gives ``d(v, p_i) <= d(v, p_home(v)) + 2r``; so ``v`` is
copied into every cell of a lower index that meets this margin, and each pair is compared once, in the
lower of its two home cells. Cells then join independently: a cell is cut into tiles of at most
``TILE`` homes (and as many copies), every pair of tiles is one group, and cosines are computed exactly in
double precision with NumPy inside the group; only links leave it, as counts per vector and as the edges
of a spanning forest of the group's links, never as all pairs.

Exact copies (equal components) are one vector with a multiplicity before any of this, so a vector that
a third of all rows repeat costs one row in the join; its copies link with each other. Where the data
has no metric structure (uniform directions in many dimensions) the margin holds for most cells and
most vectors are copied into most lower cells; the result stays exact, the work approaches all pairs.

Defined results: vectors that are null, empty, all zero, or hold a null, NaN or infinite component link
with nothing (``n_links`` 0, their own ``vec_id`` as component). Vectors of different lengths never
link. ``n_links`` counts the other rows linked directly, copies included; ``component_id`` is the
smallest ``vec_id`` reachable by links (nulls ignored; null where the component holds no id); ``kept``
is ``vec_id`` equal to ``component_id``, null-safe. Repeated rows and repeated ``vec_id`` values are
rows of their own. An empty table gives no rows. Input columns keep their names and values; one named
like a result column gives way to it; internal names cannot clash because the input travels nested.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.components import roots
from shardloom.llm.frames import stored
from shardloom.session import BROADCAST_ROWS

THRESHOLD = 0.95
#: Pivots drawn by hash from the distinct vectors (a bounded, documented sample).
PIVOTS = 16
#: Homes (and copies) of a cell that one group compares at most.
TILE = 4096
#: Rows of a tile compared at once inside a group.
CHUNK = 512
_SLACK = 1e-9  # rounding room in the margin, so no pair is lost to the last bit
_SEED = 1_000_003

RESULTS = ("n_links", "component_id", "kept")

_ASSIGNED = "_len int, _cell long, _home boolean, _rep long, _m long, _e array<double>"
_FOUND = "_kind int, _a long, _b long"


def _valid(vector) -> F.Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    square = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x)
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & (square > 0), F.lit(False))


def _radius(threshold: float) -> float:
    return math.sqrt(max(0.0, 2.0 - 2.0 * threshold))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, length) if length else np.zeros((len(column), 0))


def _assign(pivots: dict[int, tuple[np.ndarray, np.ndarray]], radius: float):
    """Home cell and copies of every distinct vector, by its distances to the pivots of its length."""
    margin = 2 * radius + _SLACK

    def run(batches):
        for batch in batches:
            lengths = batch.column("_len").to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                reps = part.column("_rep").to_numpy(zero_copy_only=False)
                counts = part.column("_m").to_numpy(zero_copy_only=False)
                vectors = part.column("_e")
                if int(length) not in pivots:
                    cells = np.full(len(reps), -1, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(reps), length, np.int32)), pa.array(cells), pa.array(np.ones(len(reps), bool)),
                         pa.array(reps), pa.array(counts), vectors],
                        schema=_ARROW_ASSIGNED,
                    )
                    continue
                index, centres = pivots[int(length)]
                unit = _matrix(vectors, int(length))
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                near = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.clip(unit @ centres.T, -1.0, 1.0)))
                home = near.argmin(axis=1)
                closest = near[np.arange(len(home)), home]
                home_cell = index[home]
                within = (near <= closest[:, None] + margin) & (index[None, :] < home_cell[:, None])
                rows, cols = np.nonzero(within)
                take = np.concatenate([np.arange(len(reps)), rows])
                cells = np.concatenate([home_cell, index[cols]])
                is_home = np.concatenate([np.ones(len(reps), bool), np.zeros(len(rows), bool)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(take), length, np.int32)), pa.array(cells.astype(np.int64)), pa.array(is_home),
                     pa.array(reps[take]), pa.array(counts[take]), vectors.take(pa.array(take))],
                    schema=_ARROW_ASSIGNED,
                )

    return run


_ARROW_ASSIGNED = pa.schema(
    [("_len", pa.int32()), ("_cell", pa.int64()), ("_home", pa.bool_()), ("_rep", pa.int64()), ("_m", pa.int64()),
     ("_e", pa.list_(pa.float64()))]
)


def _forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its local component) that connect what the links ``a``-``b`` connect."""
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[moved], nodes[label[moved]]


def _compare(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        length = int(table.column("_len")[0].as_py())
        role = table.column("_role").to_numpy(zero_copy_only=False)
        reps = table.column("_rep").to_numpy(zero_copy_only=False)
        counts = table.column("_m").to_numpy(zero_copy_only=False)
        vectors = _matrix(table.column("_e").combine_chunks(), length)
        norms = np.linalg.norm(vectors, axis=1)
        same = bool(table.column("_same")[0].as_py())
        left = np.nonzero(role <= 1)[0]  # 0: left and right (same tile), 1: left
        right = np.nonzero(role != 1)[0]  # 0, 2: home of the right tile, 3: copy
        right_home = role[right] <= 2
        pa_, pb_ = [], []
        for start in range(0, len(left), CHUNK):
            rows = left[start : start + CHUNK]
            cos = (vectors[rows] @ vectors[right].T) / (norms[rows, None] * norms[None, right])
            hit = cos >= threshold
            if same:
                # Homes of one tile meet once: only pairs in ascending node order.
                hit &= ~right_home[None, :] | (reps[rows][:, None] < reps[right][None, :])
            i, j = np.nonzero(hit)
            pa_.append(rows[i])
            pb_.append(right[j])
        a = np.concatenate(pa_) if pa_ else np.zeros(0, np.int64)
        b = np.concatenate(pb_) if pb_ else np.zeros(0, np.int64)
        keys = np.unique(np.concatenate([a, b]))
        if not len(keys):
            return pa.table({"_kind": pa.array([], pa.int32()), "_a": pa.array([], pa.int64()), "_b": pa.array([], pa.int64())})
        sums = np.zeros(len(reps), np.int64)
        np.add.at(sums, a, counts[b])
        np.add.at(sums, b, counts[a])
        # Local indices may repeat a vector (home and copy are never in one group, so they do not).
        nodes, inverse = np.unique(reps, return_inverse=True)
        fa, fb = _forest(nodes, inverse[a], inverse[b])
        kinds = np.concatenate([np.zeros(len(keys), np.int32), np.ones(len(fa), np.int32)])
        return pa.table(
            {"_kind": kinds, "_a": np.concatenate([reps[keys], fa]), "_b": np.concatenate([sums[keys], fb])}
        )

    return run


def _tiles(assigned: DataFrame, tile: int) -> DataFrame:
    """Every row once for each tile pair it takes part in, with its role there."""
    sizes = assigned.groupBy("_len", "_cell").agg(
        F.sum(F.col("_home").cast("long")).alias("_homes"), F.sum((~F.col("_home")).cast("long")).alias("_copies")
    )
    sizes = sizes.select(
        "_len",
        "_cell",
        F.greatest(F.lit(1), F.ceil(F.col("_homes") / tile)).cast("long").alias("_th"),
        F.greatest(F.lit(1), F.ceil(F.col("_homes") / tile), F.ceil(F.col("_copies") / tile)).cast("long").alias("_tp"),
    )
    sizes = stored(sizes, "metric")
    if sizes.count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    placed = assigned.join(sizes, ["_len", "_cell"])
    spread = F.pmod(F.xxhash64("_rep", F.lit(_SEED)), F.col("_tp"))
    home_tile = F.pmod(F.xxhash64("_rep", F.lit(_SEED)), F.col("_th"))
    # Homes of tile t: left in (t, b) for every b, right in (a, t) for a < t, both in (t, t).
    as_left = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_tp") - 1),
        lambda b: F.struct(home_tile.alias("a"), b.alias("b"), F.when(b == home_tile, 0).otherwise(1).alias("role")),
    )
    as_right = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), home_tile), lambda a: a < home_tile),
        lambda a: F.struct(a.alias("a"), home_tile.alias("b"), F.lit(2).alias("role")),
    )
    copies = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_th") - 1),
        lambda a: F.struct(a.alias("a"), spread.alias("b"), F.lit(3).alias("role")),
    )
    roles = F.when(F.col("_home"), F.concat(as_left, as_right)).otherwise(copies)
    exploded = placed.select("_len", "_cell", "_rep", "_m", "_e", F.explode(roles).alias("_t"))
    return exploded.select(
        "_len", "_cell", F.col("_t.a").alias("_ta"), F.col("_t.b").alias("_tb"), F.col("_t.role").alias("_role"),
        (F.col("_t.a") == F.col("_t.b")).alias("_same"), "_rep", "_m", "_e",
    )


def links(
    vectors: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    threshold: float = THRESHOLD,
    pivots: int = PIVOTS,
    tile: int = TILE,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns of ``keep`` (all by default) with ``n_links``, ``component_id`` and ``kept``: rows of
    ``vector`` linked where their cosine is at least ``threshold``, ``pivots`` cells, ``tile`` homes a group."""
    names = [c for c in (vectors.columns if keep is None else keep) if c not in RESULTS]
    spark = vectors.sparkSession
    rows = stored(
        vectors.select(
            F.struct(*[vectors[c].alias(c) for c in names]).alias("_in"),
            vectors[key].cast("long").alias("_v"),
            vectors[vector].cast("array<double>").alias("_e"),
        )
        .withColumn("_ok", _valid(F.col("_e")))
        .withColumn("_node", F.monotonically_increasing_id()),
        "metric",
    )
    good = rows.filter("_ok")
    # Exact copies are one vector; pre-aggregated before the shuffle.
    reps = stored(
        good.groupBy("_e").agg(F.min("_node").alias("_rep"), F.count("*").alias("_m"), F.min("_v").alias("_vmin")),
        "metric",
    ).withColumn("_len", F.size("_e"))

    drawn = reps.orderBy(F.xxhash64("_rep", F.lit(_SEED)), "_rep").limit(pivots).select("_len", "_e").collect()
    by_length: dict[int, list[np.ndarray]] = {}
    for k, row in enumerate(drawn):
        by_length.setdefault(int(row["_len"]), []).append((k, np.asarray(row["_e"], np.float64)))
    centres = {
        n: (np.array([k for k, _ in ps], np.int64), np.stack([v / np.linalg.norm(v) for _, v in ps]))
        for n, ps in by_length.items()
    }
    radius = _radius(threshold)
    assigned = stored(reps.select("_len", "_rep", "_m", "_e").mapInArrow(_assign(centres, radius), _ASSIGNED), "metric")

    found = stored(
        _tiles(assigned, tile).groupBy("_len", "_cell", "_ta", "_tb").applyInArrow(_compare(threshold), _FOUND), "metric"
    )
    sums = found.filter("_kind = 0").groupBy(F.col("_a").alias("_rep")).agg(F.sum("_b").alias("_s"))
    tree = roots(found.filter("_kind = 1").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    rep_roots = reps.join(tree.withColumnRenamed("node", "_rep"), "_rep", "left").select(
        "_rep", "_e", "_m", "_vmin", F.coalesce("root", "_rep").alias("_root")
    )
    least = rep_roots.groupBy("_root").agg(F.min("_vmin").alias("_cid"))
    info = stored(
        rep_roots.join(least, "_root").join(sums, "_rep", "left").select(
            "_e", (F.col("_m") - 1 + F.coalesce("_s", F.lit(0))).alias("_links"), "_cid"
        ),
        "metric",
    )
    linked = good.join(info, "_e").select("_in", "_v", "_links", "_cid")
    alone = rows.filter("NOT _ok").select("_in", "_v", F.lit(0).cast("long").alias("_links"), F.col("_v").alias("_cid"))
    done = linked.unionByName(alone)
    return done.select(
        *[F.col("_in")[c].alias(c) for c in names],
        F.col("_links").cast("long").alias("n_links"),
        F.col("_cid").alias("component_id"),
        F.col("_v").eqNullSafe(F.col("_cid")).alias("kept"),
    )
