"""Removal of passages that repeat: every word covered by a window of 35 words that also starts elsewhere.

1. A window is counted under its anchor, the sub-window of 20 words with the lowest hash in it: equal
   windows have equal anchors. Every task counts the anchors of its texts in a count-min sketch, up to
   two; the sketches of all tasks are merged block by block. What a window's anchor counts is never
   less than what the window does, so a window estimated at one is alone.
2. Only windows estimated at two or more go on. Tasks first settle what repeats among their own, so a
   passage that fills a third of the table sends one row a task; the rest is grouped exactly, by 96-bit
   digests, in buckets whose number grows with the input. A window's bucket is that of its own digest:
   windows that only share an anchor, as all those over one frequent short passage do, spread evenly.
3. The places found come back as ranges of each text, neighbours are merged, and the words they cover
   are removed.

The sketch is as wide as the input asks for, up to ``MOST_CELLS``; beyond that more windows pass it, and
the result is the same. Null and empty texts have no words. Texts with fewer than 35 words are kept whole.
Repeated rows and equal texts are each other's repeats. An empty table gives an empty result. Result
columns replace input columns of their name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.frames import BLOCKS, TEXT, merged, squeeze, unsqueeze
from shardloom.llm.text import Words, mix, pieces, rolling, words
from shardloom.session import BROADCAST_BYTES, weighed

WINDOW = 35
ANCHOR = 20
ROWS = 2  # of the sketch
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 28  # of a row of the sketch; a cell takes two bits
BLOCK_CELLS = 1 << 16
BUCKET_BYTES = 16 << 20  # of text for each bucket of the exact pass
LEAST_BUCKETS = 64
CHUNK = 1_000_000  # windows a task holds before it hands them on
SETTLED = np.uint32(0xFFFFFFFF)


# --- anchors -------------------------------------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (minimum or maximum) of every run of ``width`` values; ``width`` a power of two."""
    step = 1
    while step < width:
        values = least(values[:-step], values[step:])
        step *= 2
    return values


def anchored(found: Words, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words of all windows, anchor of each, words where a distinct anchor stands)."""
    n = len(found.start)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    span = window - anchor + 1
    subs = rolling(found.hashes(), anchor)
    lowest = _sliding(subs, span, np.minimum)
    row = found.row
    inside = row[: len(lowest)] == row[window - 1 :]
    shown = np.where(inside, lowest, np.uint64(0))
    # A sub-window is an anchor if it is the lowest of some window around it.
    padded = np.concatenate([np.zeros(span - 1, np.uint64), shown, np.zeros(span - 1, np.uint64)])
    highest = _sliding(padded, span, np.maximum)
    first = np.flatnonzero(inside)
    return first, lowest[first], subs[highest[: len(subs)] == subs]


def _cells(anchors: np.ndarray, width: int) -> list[np.ndarray]:
    mask = np.uint64(width - 1)
    return [((anchors if k == 0 else mix(anchors + np.uint64(k))) & mask).astype(np.int64) for k in range(ROWS)]


class Sketch:
    """Counters up to two, as two bits a cell: seen, and seen again."""

    def __init__(self, width: int):
        self.width = width
        self.once = np.zeros((ROWS, width // 8), np.uint8)
        self.twice = np.zeros((ROWS, width // 8), np.uint8)

    def add(self, anchors: np.ndarray) -> None:
        for k, cells in enumerate(_cells(anchors, self.width)):
            cells, counts = np.unique(cells, return_counts=True)
            place, bit = cells >> 3, (1 << (cells & 7)).astype(np.uint8)
            again = (counts > 1) | (self.once[k][place] & bit > 0)
            np.bitwise_or.at(self.once[k], place, bit)
            np.bitwise_or.at(self.twice[k], place[again], bit[again])

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        each = BLOCK_CELLS // 8
        per_row = self.width // BLOCK_CELLS
        for k in range(ROWS):
            for b in range(per_row):
                once = self.once[k][b * each : (b + 1) * each]
                if once.any():
                    yield k * per_row + b, squeeze(np.stack([once, self.twice[k][b * each : (b + 1) * each]]))


def _either(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.reshape(2, -1), b.reshape(2, -1)
    return np.stack([a[0] | b[0], a[1] | b[1] | (a[0] & b[0])]).reshape(-1)


def _sketched(width: int, window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(width)
        for batch in batches:
            for piece in pieces(batch, TEXT):
                sketch.add(anchored(words(piece.column(TEXT)), window, anchor)[2])
        for block, payload in sketch.blocks():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([payload], pa.binary())], ["block", "payload"]
            )

    return run


def repeated_cells(texts: DataFrame, width: int, window: int = WINDOW, anchor: int = ANCHOR) -> np.ndarray:
    """Bits of the cells counted twice or more, over all texts: ``ROWS * width / 8`` bytes."""
    parts = texts.select(TEXT).mapInArrow(_sketched(width, window, anchor), BLOCKS)
    each = BLOCK_CELLS // 8
    bits = np.zeros((ROWS * width // BLOCK_CELLS, each), np.uint8)
    for row in merged(parts, "uint8", _either).toLocalIterator():
        bits[row["block"]] = unsqueeze(bytes(row["payload"]), "uint8")[each:]
    return bits.reshape(ROWS, width // 8)


# --- exact groups ----------------------------------------------------------------------------------------

_WINDOWS = np.dtype([("a", "<u8"), ("b", "<u4"), ("text", "<u4"), ("at", "<u4")])


def _ranges(at: np.ndarray) -> np.ndarray:
    """Sorted distinct places as rows (first, number of consecutive ones)."""
    edge = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
    return np.stack([at[edge], np.diff(np.append(edge, len(at)))], axis=1).astype("<u4")


def _runs(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows sorted by digest, and for each the size of its group."""
    found = found[np.lexsort((found["b"], found["a"]))]
    same = (found["a"][1:] == found["a"][:-1]) & (found["b"][1:] == found["b"][:-1])
    edge = np.flatnonzero(np.concatenate([[True], ~same]))
    sizes = np.diff(np.append(edge, len(found)))
    return found, np.repeat(sizes, sizes)


def _by_text(found: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(first and second digest of a text, its ranges) from windows that repeat."""
    if not len(found):
        return
    found = found[np.lexsort((found["at"], found["text"]))]
    edge = np.flatnonzero(np.concatenate([[True], found["text"][1:] != found["text"][:-1]]))
    for s, e in zip(edge, np.append(edge[1:], len(found))):
        k1, k2 = keys[found["text"][s]]
        yield int(k1), int(k2), _ranges(np.unique(found["at"][s:e]).astype(np.int64)).tobytes()


PARTS = "bucket long, k1 long, k2 long, payload binary"
RANGES = "k1 long, k2 long, payload binary"


def _row(*columns) -> pa.RecordBatch:
    kinds = [pa.int64()] * (len(columns) - 1) + [pa.binary()]
    names = ["bucket", "k1", "k2", "payload"][-len(columns) :]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _candidates(bits, width: int, buckets: int, window: int, anchor: int):
    """Rows of two kinds: windows yet to be compared with other tasks' (a bucket, no text), and ranges
    already settled (bucket by text)."""

    def hand_on(held: list, keys: list) -> Iterator[pa.RecordBatch]:
        found, sizes = _runs(np.concatenate(held))
        texts = np.concatenate(keys)
        settled = list(_by_text(found[sizes > 1], texts))
        if settled:
            k1, k2, payloads = zip(*settled)
            yield _row([k % buckets for k in k1], k1, k2, payloads)
        # One row for each digest goes on; a settled one has no place of its own left to find.
        found["text"][sizes > 1] = SETTLED
        lead = np.concatenate([[True], (found["a"][1:] != found["a"][:-1]) | (found["b"][1:] != found["b"][:-1])])
        found = found[lead]
        bucket = (found["a"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, found = bucket[order], found[order]
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        payloads = []
        for s, e in zip(edge, np.append(edge[1:], len(found))):
            part = found[s:e].copy()
            named = part["text"] != SETTLED
            used, part["text"][named] = np.unique(part["text"][named], return_inverse=True)
            head = np.array([len(used)], "<i8").tobytes()
            payloads.append(squeeze(np.frombuffer(head + texts[used].tobytes() + part.tobytes(), np.uint8)))
        nothing = [None] * len(edge)
        for s in range(0, len(edge), 256):
            yield _row(bucket[edge[s : s + 256]], nothing[s : s + 256], nothing[s : s + 256], payloads[s : s + 256])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = bits.value
        held, keys, n, seen = [], [], 0, 0
        for batch in batches:
            for piece in pieces(batch, TEXT):
                found = words(piece.column(TEXT))
                first, anchors, _ = anchored(found, window, anchor)
                hit = np.ones(len(first), bool)
                for k, cells in enumerate(_cells(anchors, width)):
                    hit &= repeated[k][cells >> 3] >> (cells & 7).astype(np.uint8) & 1 > 0
                first = first[hit]
                if len(first):
                    part = np.empty(len(first), _WINDOWS)
                    part["a"] = rolling(found.hashes(0), window, 0)[first]
                    part["b"] = rolling(found.hashes(1), window, 1)[first] >> np.uint64(32)
                    row = found.row[first]
                    part["text"] = row + seen
                    part["at"] = first - found.first[row]
                    held.append(part)
                    keys.append(np.stack([piece.column(k).to_numpy() for k in ("k1", "k2")], axis=1))
                    n, seen = n + len(part), seen + piece.num_rows
                if n >= CHUNK:
                    yield from hand_on(held, keys)
                    held, keys, n, seen = [], [], 0, 0
        if n:
            yield from hand_on(held, keys)

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket to (k1, k2, ranges): windows whose digest is there twice, or settled."""
    at, parts = None, []

    def done() -> Iterator[pa.RecordBatch]:
        held, keys, seen = [], [], 0
        for payload in parts:
            data = unsqueeze(payload, np.uint8)
            n = int(data[:8].view("<i8")[0])
            keys.append(data[8 : 8 + 16 * n].view("<i8").reshape(-1, 2))
            found = data[8 + 16 * n :].view(_WINDOWS).copy()
            found["text"][found["text"] != SETTLED] += np.uint32(seen)
            held.append(found)
            seen += n
        found, sizes = _runs(np.concatenate(held))
        settled = found["text"] == SETTLED
        group = np.cumsum(np.concatenate([[True], (found["a"][1:] != found["a"][:-1]) | (found["b"][1:] != found["b"][:-1])])) - 1
        known = np.zeros(group[-1] + 1, bool)
        known[group[settled]] = True
        rows = list(_by_text(found[((sizes > 1) | known[group]) & ~settled], np.concatenate(keys)))
        for s in range(0, len(rows), 4096):
            yield _row(*zip(*rows[s : s + 4096]))

    for batch in batches:
        ready = batch.filter(pc.is_valid(batch.column(1)))
        if ready.num_rows:
            yield ready.select(["k1", "k2", "payload"])
        open_ = batch.filter(pc.is_null(batch.column(1)))
        for bucket, payload in zip(open_.column(0).to_pylist(), open_.column(3).to_pylist()):
            if bucket != at and parts:
                yield from done()
                parts = []
            at = bucket
            parts.append(payload)
    if parts:
        yield from done()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by text to one row a text, its ranges sorted and merged."""
    at, parts = None, []

    def done() -> pa.RecordBatch:
        each = np.concatenate([np.frombuffer(p, "<u4").reshape(-1, 2) for p in parts]).astype(np.int64)
        each = each[np.argsort(each[:, 0], kind="stable")]
        reach = np.maximum.accumulate(each.sum(axis=1))
        edge = np.flatnonzero(np.concatenate([[True], each[1:, 0] > reach[:-1]]))
        ends = reach[np.append(edge[1:], len(each)) - 1]
        whole = np.stack([each[edge, 0], ends - each[edge, 0]], axis=1).astype("<u4")
        return _row([at[0]], [at[1]], [whole.tobytes()])

    for batch in batches:
        for k1, k2, payload in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2) != at and parts:
                yield done()
                parts = []
            at = (k1, k2)
            parts.append(payload)
    if parts:
        yield done()


def repeated_ranges(texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, width: int | None = None) -> DataFrame:
    """(k1, k2, payload): for each text with windows that repeat, where these start, as pairs of
    32-bit numbers (first window, how many follow each other). ``texts`` has ``k1``, ``k2``, ``_text``."""
    if window - anchor + 1 & window - anchor:
        raise ValueError("a window must have a power of two of anchors to choose from")
    size = texts.agg(F.coalesce(F.sum(F.octet_length(TEXT)), F.lit(0))).first()[0]
    if width is None:
        # About one word in 51 bytes of text carries an anchor; four cells for each keep most others out.
        width = min(max(1 << (int(size * 4 / 51)).bit_length(), LEAST_CELLS), MOST_CELLS)
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    bits = texts.sparkSession.sparkContext.broadcast(repeated_cells(texts, width, window, anchor))
    parts = texts.mapInArrow(_candidates(bits, width, buckets, window, anchor), PARTS)
    found = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_compare, RANGES)
    return found.distinct().repartition("k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(_joined, RANGES)


# --- removal -----------------------------------------------------------------------------------------------


def covered(found: Words, payloads: Sequence[bytes | None], window: int) -> np.ndarray:
    """Which words lie under a window that repeats."""
    change = np.zeros(len(found.start) + 1, np.int64)
    for first, payload in zip(found.first.tolist(), payloads):
        if payload is not None:
            each = np.frombuffer(payload, "<u4").reshape(-1, 2).astype(np.int64)
            np.add.at(change, first + each[:, 0], 1)
            np.add.at(change, first + each.sum(axis=1) + window - 1, -1)
    return np.cumsum(change[:-1]) > 0


def _remove(names: list[str], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, TEXT):
                found = words(piece.column(TEXT))
                gone = covered(found, piece.column("payload").to_pylist(), window)
                left = np.flatnonzero(~gone)
                kept = Words(found.data, found.start[left], found.end[left], np.searchsorted(left, found.first))
                data, at = kept.packed()
                ends = at + np.arange(len(at))
                joined = np.full(ends[-1], 0x20, np.uint8)
                joined[np.arange(len(data)) + np.repeat(np.arange(len(at) - 1), np.diff(at))] = data
                # A row's words with one space between them: all but the last space.
                bounds = [(ends[a], max(ends[b] - 1, ends[a])) for a, b in zip(kept.first[:-1], kept.first[1:])]
                whole = joined.tobytes()
                texts = [whole[a:b] for a, b in bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[piece.column(c) for c in names],
                        pa.array(found.counts, pa.int64()),
                        pa.array(found.counts - kept.counts, pa.int64()),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    [*names, "n_words", "n_removed", "kept_text"],
                )

    return run


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    width: int | None = None,
) -> DataFrame:
    """Add ``n_words``, ``n_removed`` and ``kept_text`` (words left, joined by one space) to every row."""
    added = ("n_words", "n_removed", "kept_text")
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(
        *[F.col(c).alias(f"_{k}") for k, c in enumerate(names)],
        F.xxhash64(whole).alias("k1"),
        F.xxhash64(F.lit(7), whole).alias("k2"),
        whole.alias(TEXT),
    )
    ranges, _, size = weighed(repeated_ranges(texts.select("k1", "k2", TEXT), window, anchor, width), "payload")
    joined = texts.join(F.broadcast(ranges) if size <= BROADCAST_BYTES // 4 else ranges, ["k1", "k2"], "left")
    inside = [f"_{k}" for k in range(len(names))]
    schema = ", ".join([f"_{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(names)])
    schema = f"{schema}, " * bool(schema) + "n_words long, n_removed long, kept_text string"
    done = joined.select(*inside, TEXT, "payload").mapInArrow(_remove(inside, window), schema)
    return done.withColumnsRenamed(dict(zip(inside, names)))
