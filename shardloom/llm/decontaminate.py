"""Benchmark items inside documents, exact or edited, found by a random-walk embedding.

Lower-cased words are the symbols. From every word of a text a random walk reads a window: each
step puts out the word it stands on and moves on to the next word or stays, as a bit of the word's hash
for that step says. Equal symbols walk alike and fall back into step after an edit, so few edits leave
most of the output alike: edit distance becomes Hamming distance. The first coordinates of a walk do
not depend on how long the window is, so one walk a word serves the windows of all item sizes.

A signature is a sample of a walk's coordinates. Items are filed under the signatures of all their
words, texts are looked up word by word, and as many samples are drawn as the target recall needs for
items edited up to the limit (``repetitions``). Every hit is verified: the edit distance in words
between the whole item and the best place in the text around the hit counts, and nothing else.

Items go out to the tasks in blocks of bounded size; every block is compared with all texts. Null and
empty texts have no matches. Items of fewer than ``MIN_WORDS`` words, null ones included, name no
passage and match nothing. Repeated rows and repeated items each give their own matches. Empty tables
give empty results (no items: all documents are clean). Of several places of one item in a text that
overlap, the closest is reported, the first of equals.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.frames import TEXT, stored
from shardloom.llm.text import mix, pieces, words

RATE = 0.2  # edits a word of the item
RECALL = 0.99
MIN_WORDS = 8
STEPS = 12  # coordinates of a walk
SAMPLED = 5  # of them in a signature
PER_WALK = 3  # signatures drawn from one walk
LEAST_WALKS = 2
MOST_WALKS = 5  # five walks of twelve steps use sixty bits of a word's hash
BLOCK_WORDS = 200_000
SEED = 99
MASK_BITS = 22
_STOP = np.uint64(0)  # stands behind the last word of each text


def samples(walks: int) -> list[list[list[int]]]:
    """For each walk, the coordinates of its signatures; the first coordinate is in all of them."""
    made = np.random.Generator(np.random.PCG64(SEED))
    return [
        [[0, *sorted(1 + made.choice(STEPS - 1, SAMPLED - 1, replace=False))] for _ in range(PER_WALK)]
        for _ in range(walks)
    ]


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows with a stop behind each row, and each row's first (one more at the end)."""
    found = words(pc.utf8_lower(pc.cast(texts, pa.large_string())))
    n = found.counts
    first = np.concatenate([[0], np.cumsum(n + 1)])
    out = np.full(first[-1], _STOP, np.uint64)
    row = np.repeat(np.arange(len(n)), n)
    out[np.arange(len(row)) + row] = found.hashes() | np.uint64(1)
    return out, first


def _extend(signature: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return (signature ^ symbol) * np.uint64(0x9DDFEA08EB382D69) + np.uint64(0x632BE59BD9B4E019)


def signatures(
    stream: np.ndarray, starts: np.ndarray, walks: int, early: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, signatures, last word read) of every sample. ``early`` is a bit table of signatures cut
    after their second coordinate: starts that are not in it are given up there."""
    moves = mix(stream)
    for w, drawn in enumerate(samples(walks)):
        for number, chosen in enumerate(drawn):
            at, place = starts, starts
            signature = np.full(len(at), np.uint64(w * PER_WALK + number + 1))
            read = 0
            for step in range(chosen[-1] + 1):
                symbol = stream[place]
                if step in chosen:
                    signature = _extend(signature, symbol)
                    read += 1
                    if read == 2 and early is not None:
                        on = in_table(early, signature)
                        at, place, signature, symbol = at[on], place[on], signature[on], symbol[on]
                if step < chosen[-1]:
                    bit = moves[place] >> np.uint64(w * STEPS + step) & np.uint64(1)
                    place = place + (bit.astype(np.int64) & (symbol != _STOP))
            yield at, signature, place


def table_of(values: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << MASK_BITS, bool)
    bits[(values >> np.uint64(64 - MASK_BITS)).astype(np.int64)] = True
    return bits


def in_table(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    return bits[(values >> np.uint64(64 - MASK_BITS)).astype(np.int64)]


@dataclass
class Index:
    """Items of one block and their signatures, sorted. ``first`` has where each item starts."""

    ids: list
    stream: np.ndarray
    first: np.ndarray
    walks: int
    rate: float
    signature: np.ndarray = field(default=None)
    word: np.ndarray = field(default=None)  # place in ``stream``
    vocabulary: np.ndarray = field(default=None)
    early: np.ndarray = field(default=None)

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first) - 1

    def item_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, word, "right") - 1


def _early_of(stream: np.ndarray, starts: np.ndarray, walks: int) -> np.ndarray:
    """Signatures cut after their second coordinate."""
    moves, out = mix(stream), []
    for w, drawn in enumerate(samples(walks)):
        for number, chosen in enumerate(drawn):
            place = starts
            signature = _extend(np.full(len(starts), np.uint64(w * PER_WALK + number + 1)), stream[place])
            for step in range(chosen[1]):
                bit = moves[place] >> np.uint64(w * STEPS + step) & np.uint64(1)
                place = place + (bit.astype(np.int64) & (stream[place] != _STOP))
            out.append(_extend(signature, stream[place]))
    return np.concatenate(out)


def build(ids: Sequence, texts: Sequence[str | None], walks: int, rate: float = RATE) -> Index:
    """Index the items that have words enough. Only walks that stay inside the item are filed."""
    stream, first = symbols(pa.array(texts, pa.large_string()))
    long_ = np.flatnonzero(np.diff(first) - 1 >= MIN_WORDS)
    texts = [texts[k] for k in long_]
    stream, first = symbols(pa.array(texts, pa.large_string()))
    index = Index([ids[k] for k in long_], stream, first, walks, rate)
    starts = np.flatnonzero(stream != _STOP)
    found, places = [], []
    for at, signature, last in signatures(stream, starts, walks):
        inside = stream[last] != _STOP
        found.append(signature[inside])
        places.append(at[inside])
    signature, word = np.concatenate(found), np.concatenate(places)
    order = np.argsort(signature, kind="stable")
    index.signature, index.word = signature[order], word[order]
    index.vocabulary = table_of(mix(stream[starts]))
    index.early = table_of(_early_of(stream, starts, walks))
    return index


def hits(index: Index, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word of a text, word of an item) that share a signature, each pair once."""
    starts = np.flatnonzero((stream != _STOP) & in_table(index.vocabulary, mix(stream)))
    here, there = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, signature, _ in signatures(stream, starts, index.walks, index.early):
        low = np.searchsorted(index.signature, signature, "left")
        n = np.searchsorted(index.signature, signature, "right") - low
        some = np.flatnonzero(n)
        n, low = n[some], low[some]
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        here.append(np.repeat(at[some], n))
        there.append(index.word[np.repeat(low, n) + offset])
    pairs = np.unique(np.stack([np.concatenate(here), np.concatenate(there)]), axis=1)
    return pairs[0], pairs[1]


def best_place(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, first, end): the place in ``text`` with the fewest edits to the whole ``item``."""
    n = len(text)
    steps = np.arange(n + 1)
    cost, begin = np.zeros(n + 1, np.int64), steps.copy()
    for k, symbol in enumerate(item):
        # Diagonal or down first; then runs of extra words of the text, from the left.
        diagonal = np.concatenate([[k + 1], cost[:-1] + (text != symbol)])
        take = np.concatenate([[False], diagonal[1:] <= cost[1:] + 1])
        new = np.where(take, diagonal, cost + 1)
        start = np.where(take, np.concatenate([[0], begin[:-1]]), begin)
        level = new - steps
        lowest = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == lowest, steps, 0))
        cost, begin = lowest + steps, start[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def matches(index: Index, stream: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, first word, end word, edits) of every verified place."""
    here, there = hits(index, stream)
    if not len(here):
        return []
    row = np.searchsorted(first, here, "right") - 1
    item = index.item_of(there)
    start = here - (there - index.first[item])  # of the item's first word; may lie before the text
    slack = (index.sizes * index.rate).astype(np.int64)
    order = np.lexsort((start, item, row))
    row, item, start = row[order], item[order], start[order]
    apart = np.concatenate(
        [[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > slack[item[1:]])]
    )
    edge = np.flatnonzero(apart)
    found = []
    for s, e in zip(edge.tolist(), np.append(edge[1:], len(row)).tolist()):
        i, r = item[s], row[s]
        size, most = int(index.sizes[i]), int(slack[i])
        low = max(int(start[s]) - most, int(first[r]))
        high = min(int(start[e - 1]) + size + most, int(first[r + 1]) - 1)
        wanted, text = index.stream[index.first[i] : index.first[i] + size], stream[low:high]
        # Every word of the item that is nowhere around costs an edit.
        if np.isin(wanted, text).sum() < size - most:
            continue
        edits, begin, end = best_place(wanted, text)
        if edits <= most:
            found.append((int(r), int(i), low + begin - int(first[r]), low + end - int(first[r]), edits))
    return _closest(found)


def _closest(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of overlapping places of one item in one row the one with the fewest edits, the first of equals."""
    out: list[tuple[int, int, int, int, int]] = []
    for m in sorted(set(found), key=lambda m: (m[0], m[1], m[4], m[2])):
        if not any(o[:2] == m[:2] and o[2] < m[3] and m[2] < o[3] for o in reversed(out[-64:])):
            out.append(m)
    return out


# --- as many samples as the recall needs ---------------------------------------------------------------


def _edited(item: np.ndarray, edits: int, made: np.random.Generator) -> np.ndarray:
    words_ = item.tolist()
    for kind in made.integers(0, 3, edits):
        k = int(made.integers(0, len(words_)))
        if kind == 0:
            words_[k] = int(made.integers(1 << 62)) | 1
        elif kind == 1 and len(words_) > 1:
            del words_[k]
        else:
            words_.insert(k, int(made.integers(1 << 62)) | 1)
    return np.array(words_, np.uint64)


def repetitions(ids: Sequence, texts: Sequence, rate: float = RATE, target: float = RECALL) -> tuple[int, float]:
    """(walks, recall): the fewest walks with which items edited up to the limit are found, as measured
    on edited copies of up to 300 items; ``MOST_WALKS`` at most."""
    made = np.random.Generator(np.random.PCG64(SEED))
    if len(ids) > 300:
        drawn = made.choice(len(ids), 300, replace=False)
        ids, texts = [ids[k] for k in drawn], [texts[k] for k in drawn]
    recall = 1.0
    for walks in range(LEAST_WALKS, MOST_WALKS + 1):
        index = build(ids, texts, walks, rate)
        trials = found = 0
        made = np.random.Generator(np.random.PCG64(SEED))
        for i, size in enumerate(index.sizes.tolist()):
            item = index.stream[index.first[i] : index.first[i] + size]
            copy = _edited(item, int(size * rate), made)
            _, there = hits(index, np.append(copy, _STOP))
            trials += 1
            found += bool((index.item_of(there) == i).any())
        recall = found / trials if trials else 1.0
        if recall >= target:
            break
    return walks, recall


# --- documents -------------------------------------------------------------------------------------------


def blocks(items: DataFrame, item_id: str, item_text: str) -> Iterator[tuple[list, list]]:
    """Items in blocks of about ``BLOCK_WORDS`` words, one block at a time on the driver."""
    slim = items.select(F.col(item_id).alias("_id"), F.col(item_text).cast("string").alias("_item"))
    slim = slim.filter(F.col("_item").isNotNull())
    total = slim.agg(F.coalesce(F.sum(F.octet_length("_item")), F.lit(0))).first()[0]
    n = -(-total // (6 * BLOCK_WORDS))
    for k in range(n):
        rows = slim.filter(F.pmod(F.xxhash64("_id", "_item"), F.lit(n)) == k).collect()
        rows.sort(key=lambda r: (r["_item"], str(r["_id"])))
        yield [r["_id"] for r in rows], [r["_item"] for r in rows]


def _indexes(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, rate: float, target: float):
    for ids, texts in blocks(items, item_id, item_text):
        walks, _ = repetitions(ids, texts, rate, target)
        index = build(ids, texts, walks, rate)
        if index.ids:
            yield docs.sparkSession.sparkContext.broadcast(index)


def _batches(batches: Iterator[pa.RecordBatch], shared):
    index = shared.value
    for batch in batches:
        for piece in pieces(batch, TEXT):
            stream, first = symbols(piece.column(TEXT))
            yield piece, index, matches(index, stream, first)


def find(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: Sequence[str] | None = None,
    rate: float = RATE,
    target: float = RECALL,
) -> DataFrame:
    """One row for every place of an item in a document: the ``keep`` columns of the document, the
    item's id, ``first_word``, ``end_word`` (of the text, the second not included) and ``edits``."""
    added = (item_id, "first_word", "end_word", "edits")
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    source = docs.select(*[F.col(c) for c in names], F.col(text).cast("string").alias(TEXT))
    marks = docs.sparkSession.createDataFrame([], "first_word int, end_word int, edits int").schema
    schema = source.drop(TEXT).schema
    schema = type(schema)([*schema, items.select(item_id).schema[0], *marks])
    arrow_id = items.select(item_id).limit(0).toArrow().schema.field(0).type

    def over(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece, index, found in _batches(batches, shared):
                if found:
                    row, item, first, end, edits = zip(*found)
                    kept = piece.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[kept.column(c) for c in names],
                            pa.array([index.ids[i] for i in item], arrow_id),
                            *[pa.array(x, pa.int32()) for x in (first, end, edits)],
                        ],
                        [*names, *added],
                    )

        return run

    done = None
    for shared in _indexes(docs, items, item_id, item_text, rate, target):
        part = stored(source.mapInArrow(over(shared), schema), "leaks")
        shared.unpersist()
        done = part if done is None else done.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if done is None else done


def clean(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = RATE,
    target: float = RECALL,
) -> DataFrame:
    """The documents that hold no item, as they are. Each block of items is one more pass over them."""

    def over(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece, _, found in _batches(batches, shared):
                good = np.ones(piece.num_rows, bool)
                good[[m[0] for m in found]] = False
                left = piece.filter(pa.array(good))
                yield left.select([c for c in left.schema.names if c != TEXT])

        return run

    for shared in _indexes(docs, items, item_id, item_text, rate, target):
        source = docs.withColumn(TEXT, F.col(text).cast("string"))
        docs = source.mapInArrow(over(shared), docs.schema)
    return docs
