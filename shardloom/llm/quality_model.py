"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Tokens are runs of letters and digits, and runs of other characters, inside words. Every token has a
sparse random index vector (a few signs, drawn from its hash); a token's vector is the sum of the index
vectors of its neighbours over the whole corpus, kept in a table of ``BUCKETS`` rows by hash, whatever
the size of the vocabulary. A document is pooled as the mean of its tokens' vectors, once as they are
and once with frequent tokens weighed down. A two-layer network learns on labelled documents, and a
temperature fitted on labelled documents it has not learned from makes its output a probability.

All texts count towards the vectors. The network sees at most about ``FIT_ROWS`` labelled documents,
drawn by hash. Null and empty texts pool to zeros and are scored like any other; null labels teach
nothing; a document labelled twice counts twice. Without labels of both kinds every score is the share
of good labels (0.5 without any). Repeated rows get equal scores; an empty table gives an empty result.
Result columns replace input columns of their name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.frames import BLOCKS, TEXT, as_blocks, gathered, merged, stored, with_columns
from shardloom.llm.text import Words, mix, pieces, raw
from shardloom.session import measured

DIM = 64
SIGNS = 4  # entries of an index vector that are not zero
REACH = 2  # neighbours on either side
BUCKETS = 1 << 14
BLOCK_ROWS = 256
RARE = 1e-3  # tokens more frequent than this weigh less in the second mean
FIT_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40
SEED = 5

_KIND = np.full(256, 2, np.uint8)  # 0: between words, 1: letters and digits, 2: anything else
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = 1


def tokens(texts: pa.Array) -> Words:
    """Runs of characters of one kind."""
    data, at = raw(texts)
    if not len(data):
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64))
    kind = _KIND[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[at] = True
    edges = np.flatnonzero(cut)
    solid = kind[edges[:-1]] > 0
    start, end = edges[:-1][solid], edges[1:][solid]
    return Words(data, start, end, np.searchsorted(start, at))


def buckets(found: Words) -> np.ndarray:
    return (found.hashes() >> np.uint64(64 - 14)).astype(np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket: which entries are set, and their signs."""
    draws = mix(np.arange(BUCKETS * SIGNS, dtype=np.uint64).reshape(BUCKETS, SIGNS) + np.uint64(SEED << 32))
    return (draws % np.uint64(DIM)).astype(np.int64), np.where(draws >> np.uint64(63), 1.0, -1.0)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, sign = index_vectors()
    width = DIM + 1  # the last cell counts the token itself
    total = np.zeros(BUCKETS * width)
    for batch in batches:
        for piece in pieces(batch, TEXT):
            found = tokens(piece.column(TEXT))
            b, row = buckets(found), found.row
            total += np.bincount(b * width + DIM, minlength=len(total))
            for step in range(1, REACH + 1):
                near = row[step:] == row[:-step]
                left, right = b[:-step][near], b[step:][near]
                for own, other in ((left, right), (right, left)):
                    for k in range(SIGNS):
                        cells = own * width + place[other, k]
                        total += np.bincount(cells, sign[other, k], minlength=len(total))
    yield from as_blocks(total.round().astype(np.int64), BLOCK_ROWS * width)


def word_vectors(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(unit vector of each bucket, weight of each bucket): a table of fixed size."""
    width = DIM + 1
    parts = texts.select(TEXT).mapInArrow(_contexts, BLOCKS)
    whole = gathered(merged(parts, "int64", np.add), "int64", BLOCK_ROWS * width, BUCKETS // BLOCK_ROWS)
    whole = whole.reshape(BUCKETS, width).astype(np.float64)
    vectors, counts = whole[:, :DIM], whole[:, DIM]
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    share = counts / max(counts.sum(), 1)
    return vectors.astype(np.float32), (RARE / (RARE + share)).astype(np.float32)


def _pooler(shared):
    def make():
        vectors, weight = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            found = tokens(texts)
            b, n = buckets(found), found.counts
            out = np.zeros((len(n), 2 * DIM), np.float32)
            some = np.flatnonzero(n)
            step = 1 << 15  # rows of vectors looked up at a time
            first = found.first[some]
            for s in range(0, len(b), step):
                part = b[s : s + step]
                lo = int(np.searchsorted(first, s, "right")) - 1
                hi = int(np.searchsorted(first, s + len(part), "left"))
                starts = np.maximum(first[lo:hi] - s, 0)
                plain = vectors[part]
                out[some[lo:hi], :DIM] += np.add.reduceat(plain, starts, axis=0)
                out[some[lo:hi], DIM:] += np.add.reduceat(plain * weight[part][:, None], starts, axis=0)
            out /= np.maximum(n, 1)[:, None].astype(np.float32)
            return [pa.array([v.tobytes() for v in out], pa.binary())]

        return work

    return make


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, 2 * DIM)


# --- the network ------------------------------------------------------------------------------------------


class Network:
    """One hidden layer, one output; ``temperature`` divides the output before the logistic function."""

    def __init__(self, centre, scale, weights, temperature=1.0, constant=None):
        self.centre, self.scale, self.weights = centre, scale, weights
        self.temperature, self.constant = temperature, constant

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> Network:
    """Learn on the rows that are not ``apart``, and fit the temperature on those that are."""
    if not len(y) or y.min() == y.max():
        return Network(None, None, None, constant=float(y.mean()) if len(y) else 0.5)
    if len({*y[~apart]}) < 2 or not apart.any():
        apart = np.zeros(len(y), bool)
    learn, target = x[~apart].astype(np.float64), y[~apart].astype(np.float64)
    made = np.random.Generator(np.random.PCG64(SEED))
    centre, scale = learn.mean(axis=0), learn.std(axis=0) + 1e-6
    z = (learn - centre) / scale
    w = [made.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)]
    w[2] = made.normal(0, HIDDEN**-0.5, HIDDEN)
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(EPOCHS):
        order = made.permutation(len(z))
        for s in range(0, len(order), 128):
            rows = order[s : s + 128]
            hidden = np.tanh(z[rows] @ w[0] + w[1])
            error = 1 / (1 + np.exp(-np.clip(hidden @ w[2] + w[3], -30, 30))) - target[rows]
            back = error[:, None] * w[2] * (1 - hidden**2)
            grads = [z[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(keepdims=True)]
            t += 1
            for k, g in enumerate(grads):
                g = g / len(rows) + 1e-3 * w[k] * (k % 2 == 0)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] = w[k] - 3e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    net = Network(centre, scale, w)
    check, truth = (x[apart], y[apart]) if apart.any() else (x, y)
    logits = net.logits(check.astype(np.float64))

    def loss(log_t: float) -> float:
        z_ = logits / np.exp(log_t)
        return float(np.mean(np.logaddexp(0, z_) - truth * z_))

    grid = np.linspace(np.log(0.25), np.log(8.0), 141)
    net.temperature = float(np.exp(grid[int(np.argmin([loss(g) for g in grid]))]))
    return net


def _scorer(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            # Rounded: the last digits of a product of matrices depend on how many rows go in together.
            scores = np.round(net.scores(matrix(batch.column("_vector"))), 12) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(scores, pa.float64())], [*names, "score"]
            )

    return run


def score(
    docs: DataFrame,
    labels: DataFrame,
    teaches: Column,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``score`` to every row. ``teaches`` says, over the id column, whose labels may be used."""
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "_vector", "_id")]
    texts = docs.select(*names, F.col(doc_id).alias("_id"), F.col(text).cast("string").alias(TEXT))
    context = docs.sparkSession.sparkContext
    table = context.broadcast(word_vectors(texts))
    pooled = stored(with_columns(texts, TEXT, _pooler(table), "_vector binary", [*names, "_id"]), "pooled")
    known = labels.filter(teaches & F.col(label).isin(0, 1)).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_label")
    )
    n = known.count()
    draw = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    sample = measured(known.filter(draw < FIT_ROWS / max(n, 1)))
    rows = pooled.select("_id", "_vector").join(sample, "_id").toArrow()
    order = pc.sort_indices(rows, [("_id", "ascending"), ("_label", "ascending")])
    rows = rows.take(order)
    x, y = matrix(rows["_vector"]), rows["_label"].to_numpy()
    apart = np.array([hash_ % 5 == 0 for hash_ in mix(np.arange(len(y), dtype=np.uint64))], bool)
    net = context.broadcast(fit(x, y, apart))
    schema = pooled.select(*names).withColumn("score", F.lit(0.0)).schema
    return pooled.select(*names, "_vector").mapInArrow(_scorer(net, names), schema)
