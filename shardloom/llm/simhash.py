"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit set where over half of its shingles' 64-bit hashes have it set. Two
fingerprints link at ``distance`` (4) or fewer differing bits; documents reachable over links form a
component.

If two fingerprints differ in at most 4 bits, one of their two 32-bit segments differs in at most 2,
so some value lies within one bit of both segments: every distinct fingerprint is filed under the 33
values within one bit of either segment, equal values meet, and complete distances are verified. A
value under which more than ``CROWD`` fingerprints meet is not paired off. Its members are filed under
all 2,081 fingerprints within two bits of them: two fingerprints have such a centre in common exactly
if they differ in at most 4 bits, so a centre's members link to the smallest of them and no link is
lost. At most 2,081 can meet at a centre, however large a group is.

Null and empty texts have fingerprint zero and link like any other. Texts with fewer words than a
shingle has are one shingle. Equal texts share a fingerprint, and only distinct fingerprints are filed.
An empty table gives an empty result. Ties don't arise: a component is named by its smallest member.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.components import roots
from shardloom.llm.frames import stored, with_columns
from shardloom.llm.rows import repeat_rows, row_keys
from shardloom.llm.text import words
from shardloom.session import counted

SHINGLE = 4
SEED = 42
DISTANCE = 4
CROWD = 48


def _fingerprinter(width: int):
    digest = xxhash.xxh64_intdigest

    def work(texts: pa.Array) -> list[pa.Array]:
        found = words(texts, lower=True)
        n = found.counts
        result = np.zeros(len(n), np.uint64)
        if n.sum():
            # All words with one space behind each; a shingle is a slice of that.
            sizes = found.end - found.start
            at = np.concatenate([[0], np.cumsum(sizes + 1)])
            joined = np.full(at[-1], 0x20, np.uint8)
            source = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            joined[source + np.repeat(at[:-1], sizes)] = found.data[source + np.repeat(found.start, sizes)]
            per_row = np.where(n > 0, np.maximum(n - width + 1, 1), 0)
            first = np.concatenate([[0], np.cumsum(per_row)])
            row = np.repeat(np.arange(len(n)), per_row)
            word = np.arange(first[-1]) - first[row] + found.first[row]
            last = np.minimum(word + width, found.first[row + 1])
            data = joined.tobytes()
            hashes = np.fromiter(
                (digest(data[s:e], SEED) for s, e in zip(at[word].tolist(), (at[last] - 1).tolist())),
                np.uint64,
                first[-1],
            )
            some = np.flatnonzero(per_row)
            ones = np.zeros((len(some), 64), np.int64)
            step = 1 << 16  # shingles unpacked at a time
            for s in range(0, len(hashes), step):
                part = hashes[s : s + step]
                lo = int(np.searchsorted(first[some], s, "right")) - 1
                hi = int(np.searchsorted(first[some], s + len(part), "left"))
                starts = np.maximum(first[some[lo:hi]] - s, 0)
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones[lo:hi] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
            majority = 2 * ones > per_row[some][:, None]
            result[some] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64)[:, 0]
        return [pa.array(result.view(np.int64), pa.int64())]

    return work


def fingerprints(
    docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, shingle: int = SHINGLE
) -> DataFrame:
    """Add ``fp``, the fingerprint as a signed 64-bit number, to every row. One pass, no shuffle."""
    return with_columns(docs, text, partial(_fingerprinter, shingle), "fp long", keep)


def hex_of(fp: str = "fp"):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


# --- links ------------------------------------------------------------------------------------------


def _filed(fps: DataFrame) -> DataFrame:
    """(value, fp): every fingerprint under the values within one bit of either segment."""
    flips = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("_k"))
    high, low = F.expr("shiftrightunsigned(fp, 32)"), F.col("fp").bitwiseAND(0xFFFFFFFF)
    bit = F.expr("CASE WHEN _k % 33 = 32 THEN 0L ELSE shiftleft(1L, _k % 33) END")
    value = F.when(F.col("_k") < 33, high.bitwiseXOR(bit)).otherwise(
        low.bitwiseXOR(bit) + F.lit(1 << 32)
    )
    return flips.select(value.alias("value"), "fp")


def _groups(
    batches: Iterator[pa.RecordBatch], most: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cut sorted (value, fp) rows where a value ends. Of a value with more than ``most`` rows only
    what the next batch needs is carried on: a task's memory doesn't grow with it."""
    keys, fps, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for batch in batches:
        k = np.concatenate([keys, batch.column(0).to_numpy()])
        f = np.concatenate([fps, batch.column(1).to_numpy()])
        if not len(k):
            continue
        cut = int(np.searchsorted(k, k[-1]))
        if len(k) - cut > most + 1:
            # The value goes on and is crowded already: hand on what there is, keep enough to say so.
            yield k, f, np.ones(len(k), bool)
            keep = len(k) - most - 1
            keys, fps = k[keep:], f[keep:]
        else:
            yield k[:cut], f[:cut], np.ones(cut, bool)
            keys, fps = k[cut:], f[cut:]
    yield keys, fps, np.ones(len(keys), bool)


def _neighbours(distance: int, crowd: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps, _ in _groups(batches, crowd):
            if not len(keys):
                continue
            edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(edge, len(keys)))
            size = np.repeat(sizes, sizes)
            crowded = np.unique(fps[size > crowd])
            few = np.flatnonzero((size > 1) & (size <= crowd))
            k, f = keys[few], fps[few]
            a, b = [crowded], [crowded]
            for step in range(1, crowd):
                same = k[step:] == k[:-step]
                if not same.any():
                    break
                x, y = f[:-step][same], f[step:][same]
                near = np.bitwise_count((x ^ y).view(np.uint64)) <= distance
                a.append(x[near])
                b.append(y[near])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
            )

    return run


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, fp) for all values within two bits of a fingerprint."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    masks = np.concatenate([np.zeros(1, np.uint64), one, one[i] | one[j]])
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for s in range(0, len(fps), 64):
            part = fps[s : s + 64]
            values = (part[:, None] ^ masks).reshape(-1).view(np.int64)
            each = np.repeat(part, len(masks)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(each)], ["value", "fp"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a centre, linked to its smallest."""
    for keys, fps, _ in _groups(batches, 2_081):
        if len(keys):
            edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            smallest = np.repeat(fps[edge], np.diff(np.append(edge, len(keys))))
            other = smallest != fps
            pairs = np.unique(np.stack([smallest[other], fps[other]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _met(filed: DataFrame) -> DataFrame:
    return filed.repartition("value").sortWithinPartitions("value", "fp")


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b) over distinct fingerprints, enough of them to connect whatever links at 4 bits or fewer.

    Every link between fingerprints that don't crowd is there; crowded ones come as stars."""
    found = _met(_filed(fps)).mapInArrow(_neighbours(DISTANCE, crowd), "a long, b long")
    found = stored(found.distinct(), "simhash-links")
    crowded, n = counted(found.filter("a = b").select(F.col("a").alias("fp")))
    found = found.filter("a <> b")
    if n:
        filed = crowded.repartition("fp").mapInArrow(_centres, "value long, fp long")
        found = found.union(_met(filed).mapInArrow(_stars, "a long, b long")).distinct()
    return found


def classes(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(fp, root): the component of each distinct fingerprint that links to another."""
    return roots(links(fps, crowd)).withColumnsRenamed({"node": "fp"})


def components(marked: DataFrame, doc_id: str = "doc_id", crowd: int = CROWD) -> DataFrame:
    """Add ``component_id`` (smallest id reachable, null only where no member has an id) and ``root``
    (one fingerprint of the component) to rows with ``fp``."""
    marked = marked.drop("component_id", "root")
    low = stored(marked.groupBy("fp").agg(F.min(doc_id).alias("_low")), "simhash-distinct")
    linked = classes(low.select("fp"), crowd)
    by_root = low.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = by_root.groupBy("root").agg(F.min("_low").alias("component_id"))
    named = by_root.select("fp", "root").join(lowest, "root")
    return marked.join(named, "fp")


def one_of_each(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, crowd: int = CROWD
) -> DataFrame:
    """Whole rows, one for each component: the one with the smallest id (null last; rows that share
    it in the order of their digests; of equal rows any, they are equal)."""
    keyed = row_keys(docs)
    slim = fingerprints(
        keyed.withColumn("_id", F.col(doc_id)), text, ["_k1", "_k2", "_id"], shingle
    )
    slim = stored(slim.groupBy("_k1", "_k2", "_id", "fp").agg(F.count("*").alias("n")), "simhash-rows")
    named = components(slim, "_id", crowd)
    order = F.struct(F.col("_id").isNull().alias("last"), F.col("_id"), F.col("_k1"), F.col("_k2"), F.col("n"))
    best = named.groupBy("root").agg(F.min(order).alias("_best"))
    keys = best.select("_best._k1", "_best._k2", "_best.n", F.lit(1).cast("long").alias("copies"))
    return repeat_rows(keyed, keys).drop("_k1", "_k2")
