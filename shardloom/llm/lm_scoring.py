"""Language-model scores of whole texts: context mixing over words and, for rare ones, over their bytes.

Tokens are lower-cased words (A-Z only) and one end a text. Every token is coded by bits, and every bit is
predicted by mixed predictors (``word_mixing``): the exact counts, the text's topic, the word before and the
two words before. Frequent tokens are coded whole; the others are an escape. What stands behind an escape
is known by its counts in all texts learned from, first in all of them, then in those of the same topic,
each level falling back on the one below with the mass that new tokens take there; the lowest is the bit
model of bytes (``context_mixing``), learned from all words that are not frequent. A text's topic is the
one of ``TOPICS`` most frequent words it has most often (none if it has none); it is told first, at the price
of its share. All of it together is the log10 probability of the text.

Counts are exact and of any number: distinct tokens are dealt out in buckets by hash, as many as the
input asks for, and every text asks the buckets for its own. A bucket learns and prices the spelling of each
of its words once, wherever the word occurs. Tokens that make up more than 1 in ``FREQUENT`` of all are at
most that many; every task has their codes.

Null and empty texts are an end alone. Equal texts get equal scores. Texts of any length are scored
whole. An empty table gives an empty result; with nothing to learn from all tokens are new.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm import context_mixing as cm
from shardloom.llm import word_mixing as wm
from shardloom.llm.frames import BLOCKS, TEXT, as_blocks, by_bucket, merged, pack, stored, unpack, unsqueeze
from shardloom.llm.text import Words, kinds, mix, pieces, sorting, words

FREQUENT = 1 << 16
TOPICS = 24
BUCKET_BYTES = 16 << 20  # of text for each bucket
LEAST_BUCKETS = 48
PIECE = 4 << 20
_HEAD, _HEADS = np.uint64(46), 1 << 18
_END = 1  # both digests of the end; the first ones of words are even

COUNTS = np.dtype([("a", "<u8"), ("b", "<u4"), ("n", "<u4")])  # of one piece
TOTALS = np.dtype([("a", "<u8"), ("b", "<u4"), ("n", "<i8")])
_SIZES, _BYTES = np.dtype("<u4"), np.dtype("u1")  # of words, in the order of their rows


def digests(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit and a 32-bit digest of every token: the words of each row and its end."""
    n = found.counts
    place = np.arange(len(found.start)) + np.repeat(np.arange(len(n)), n)
    size = len(found.start) + len(n)
    a, b = np.full(size, _END, np.uint64), np.full(size, _END, np.uint32)
    a[place] = found.hashes(0) & ~np.uint64(1)
    b[place] = found.hashes(1) >> np.uint64(32)
    return a, b


def spans(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Where each token's bytes begin, and how many they are (an end has none)."""
    n = found.counts
    place = np.arange(len(found.start)) + np.repeat(np.arange(len(n)), n)
    start, size = np.zeros(len(found.start) + len(n), np.int64), np.zeros(len(found.start) + len(n), np.int64)
    start[place], size[place] = found.start, found.end - found.start
    return start, size


def cut_out(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of some words, one behind the other."""
    size = size.astype(np.int64)
    return data[np.repeat(start, size) + _counting(size)]


def grouped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order that sorts the pairs, the number of each sorted pair's group)."""
    order = sorting(a)
    one, two = a.take(order), b.take(order)
    same = one[1:] == one[:-1]
    if (same & (two[1:] < two[:-1])).any():  # where the first of a pair doesn't decide
        order = np.lexsort((b, a))
        one, two = a.take(order), b.take(order)
        same = one[1:] == one[:-1]
    new = np.ones(len(a), bool)
    new[1:] = ~same | (two[1:] != two[:-1])
    return order, np.cumsum(new) - 1


# --- counts of all tokens ------------------------------------------------------------------------------


def _dealt(buckets: int, a: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in it)."""
    bucket = ((a >> np.uint64(20)) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
    order = np.argsort(bucket, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
    for s, e in zip(edge, np.append(edge[1:], len(order))):
        yield int(bucket[order[s]]), order[s:e]


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, TEXT, PIECE):
                found = words(piece.column(TEXT), lower=True)
                a, b = digests(found)
                start, size = spans(found)
                first, _, n = kinds(a)
                rows = np.empty(len(first), COUNTS)
                rows["a"], rows["b"], rows["n"] = a[first], b[first], n
                start, size = start[first], size[first].astype(_SIZES)
                dealt = [
                    (k, pack(rows[at], size[at], cut_out(found.data, start[at], size[at])))
                    for k, at in _dealt(buckets, rows["a"])
                ]
                if dealt:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, _ in dealt], pa.int64()), pa.array([p for _, p in dealt], pa.binary())],
                        ["bucket", "payload"],
                    )

    return run


def _starts(size: np.ndarray) -> np.ndarray:
    size = size.astype(np.int64)
    return np.cumsum(size) - size


def _add_up(bucket: int, payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
    rows, size, data = (np.concatenate(x) for x in zip(*(unpack(p, COUNTS, _SIZES, _BYTES) for p in payloads)))
    order, group = grouped(rows["a"], rows["b"])
    first = order[np.flatnonzero(np.diff(group, prepend=-1))]
    total = rows[first].astype(TOTALS)
    total["n"] = np.bincount(group, rows["n"][order]).astype(np.int64)
    spelled = cut_out(data, _starts(size)[first], size[first])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([int(total["n"].sum())], pa.int64()),
            pa.array([len(total)], pa.int64()),
            pa.array([int((total["n"] == 1).sum())], pa.int64()),
            pa.array([pack(total)], pa.binary()),
            pa.array([pack(size[first], spelled)], pa.binary()),
        ],
        ["tokens", "distinct", "single", "payload", "spelled"],
    )


def _above(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                rows = unpack(payload, TOTALS)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pack(rows[(rows["n"] > least) | (rows["a"] == _END)])], pa.binary())], ["payload"]
                )

    return run


def _spell(least: int):
    """Learns how the words that are not frequent are spelled, each distinct one once, by its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = cm.Learner()
        for batch in batches:
            for counts, spelled in zip(*(c.to_pylist() for c in batch.columns)):
                (rows,), (size, data) = unpack(counts, TOTALS), unpack(spelled, _SIZES, _BYTES)
                rare = np.flatnonzero((rows["n"] <= least) & (rows["a"] != _END))
                for some in _parts(rare, size, cm.FIRST_PIECE if not learner.words else cm.MOST_PIECE):
                    part = cut_out(data, _starts(size)[some], size[some])
                    learner.add(cm.Units.of_words(part, size[some], rows["n"][some]))
        yield from learner.blocks()

    return run


def _parts(which: np.ndarray, size: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Runs of words with about ``limit`` bytes, one word at least."""
    total = np.cumsum(size[which].astype(np.int64) + 2)
    return (x for x in np.split(which, np.flatnonzero(np.diff(total // limit)) + 1) if len(x))


@dataclass
class Known:
    """Sizes of what was learned from, and the frequent tokens, sorted by digest (the end is one)."""

    tokens: int
    distinct: int
    single: int
    frequent: np.ndarray
    topics: np.ndarray  # places of the topics' words in ``frequent``
    least: int  # counts above are frequent
    first: np.ndarray | None = None  # of the frequent tokens with the same first bits; made when first asked for
    by_topic: np.ndarray | None = None  # tokens that are not frequent, and texts, by topic

    @property
    def new(self) -> float:
        """How many tokens' mass new ones take."""
        return max(self.single, 1)

    @property
    def seldom(self) -> int:
        """Tokens that are not frequent."""
        return self.tokens - int(self.frequent["n"].sum())

    def code(self) -> wm.Code:
        """Of the frequent tokens, and the escape behind them."""
        return wm.Code(np.append(self.frequent["n"], self.seldom).astype(np.float64))

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Each token's place among the frequent ones, or -1."""
        if self.first is None:
            heads = (self.frequent["a"] >> _HEAD).astype(np.int64)
            self.first = np.searchsorted(heads, np.arange(_HEADS + 1)).astype(np.int32)
            self.longest = int(np.diff(self.first).max())
            self.keys = tuple(np.append(self.frequent[c], 0) for c in "ab")  # 0 is no token's digest
        out = np.full(len(a), -1)
        at = self.first.take((a >> _HEAD).view(np.int64))
        for _ in range(self.longest):  # those that begin with the same bits
            same = np.flatnonzero(self.keys[0].take(at) == a)
            out[same] = np.where(self.keys[1][at[same]] == b[same], at[same], out[same])
            at = np.minimum(at + 1, len(self.frequent))
        return out

    def topic_of(self, place: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        which = np.full(len(self.frequent) + 1, -1)
        which[self.topics] = np.arange(len(self.topics))
        of = which[place]
        some = of >= 0
        n = np.bincount(row[some] * TOPICS + of[some], minlength=rows * TOPICS).reshape(rows, TOPICS)
        return np.where(n.max(axis=1, initial=0) > 0, n.argmax(axis=1), TOPICS)


def count(texts: DataFrame, buckets: int) -> tuple[Known, DataFrame]:
    """What is known by counts, and the buckets of all tokens with their spelling."""
    found = stored(
        by_bucket(
            texts.select(TEXT).mapInArrow(_counted(buckets), "bucket long, payload binary"),
            _add_up,
            "tokens long, distinct long, single long, payload binary, spelled binary",
        ),
        "token-counts",
    )
    row = found.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "distinct", "single")]).first()
    least = max(row[0] // FREQUENT, 1)  # what occurs once is never frequent, so there are always escapes to learn from
    rows = [np.array([(_END, _END, 0)], TOTALS)]
    for part in found.select("payload").mapInArrow(_above(least), "payload binary").toLocalIterator():
        rows.append(unpack(bytes(part["payload"]), TOTALS)[0])
    frequent = np.concatenate(rows)
    frequent = np.sort(frequent, order=["a", "b", "n"])
    last = np.append((frequent["a"][1:] != frequent["a"][:-1]) | (frequent["b"][1:] != frequent["b"][:-1]), True)
    frequent = frequent[last]
    words_ = np.flatnonzero((frequent["a"] != _END) & (frequent["n"] > 0))
    best = words_[np.lexsort((frequent["a"][words_], -frequent["n"][words_]))][:TOPICS]
    return Known(int(row[0]), int(row[1]), int(row[2]), frequent, np.sort(best), least), found


# --- learning --------------------------------------------------------------------------------------------


def _learn(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = shared.value
        learner = wm.Learner(model)
        width = TOPICS + 1
        table = np.zeros(2 * width)
        for batch in batches:
            for piece in _growing(batch):
                place, row, topic, (a, _) = _placed(known, words(piece.column(TEXT), lower=True))
                learner.add(_coded(known, place, row, topic, a))
                table[:width] += np.bincount(topic[row[place < 0]], minlength=width)
                table[width:] += np.bincount(topic, minlength=width)
        yield from learner.blocks()
        padded = np.zeros(cm.BLOCK)
        padded[: len(table)] = table
        yield from as_blocks(padded, cm.BLOCK, model.blocks + wm.EXTRA_BLOCKS)

    return run


def _coded(known: Known, place: np.ndarray, row: np.ndarray, topic: np.ndarray, a: np.ndarray) -> wm.Tokens:
    return wm.Tokens(np.where(place >= 0, place, len(known.frequent)), topic[row], a, row)


def _growing(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Small pieces first, so that weights are learned from little text too."""
    first = True
    for part in pieces(batch, TEXT, cm.MOST_PIECE):
        yield from pieces(part, TEXT, cm.FIRST_PIECE * 4) if first else [part]
        first = False


def _placed(known: Known, found: Words):
    """(place among frequent tokens, row) of every token, the topic of every row, and the digests."""
    a, b = digests(found)
    rows = len(found.first) - 1
    row = np.repeat(np.arange(rows), found.counts + 1)
    place = known.places(a, b)
    return place, row, known.topic_of(place, row, rows), (a, b)


def learn(texts: DataFrame, known: Known, found: DataFrame) -> tuple[wm.Model, cm.Model, Known]:
    """The model of words, the model of their spelling, and what is known by counts."""
    spelling = cm.Assembly()
    parts = found.select("payload", "spelled").mapInArrow(_spell(known.least), BLOCKS)
    for row in merged(parts, "float64", np.add).toLocalIterator():
        spelling.add(row["block"], unsqueeze(bytes(row["payload"]), "float64"))
    width = TOPICS + 1
    model = wm.Model(known.code(), width, wm.table_bits(known.tokens))
    shared = texts.sparkSession.sparkContext.broadcast((known, model))
    parts = texts.select(TEXT).mapInArrow(_learn(shared), BLOCKS)
    built, table = wm.Assembly(model), np.zeros(2 * width)
    for row in merged(parts, "float64", np.add).toLocalIterator():
        block, cells = row["block"], unsqueeze(bytes(row["payload"]), "float64")
        if block < model.blocks + wm.EXTRA_BLOCKS:
            built.add(block, cells)
        else:
            table = cells[: 2 * width]
    known.by_topic = table.reshape(2, width)
    return built.done(), spelling.done(), known


# --- scoring ---------------------------------------------------------------------------------------------

SUMS = "k1 long, k2 long, n_tokens long, n_bytes long, n_known long, base double, score double, copies long"
_NAMES = [c.split()[0] for c in SUMS.split(", ")]
_TEXTS = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("topic", "<i4"), ("learned", "<i4")])
_UNITS = np.dtype([("a", "<u8"), ("b", "<u4"), ("size", "<u4"), ("uses", "<u4")])
_USES = np.dtype([("text", "<u4"), ("n", "<u4")])


def _chance(known: Known, counted: np.ndarray, in_topic: np.ndarray, topic: np.ndarray, spelled: np.ndarray):
    """The natural logarithm of the probability of tokens behind an escape from their counts, and from
    their spelling (a logarithm, too) where these say little. No word is so long that its probability vanishes."""
    with np.errstate(divide="ignore"):
        counted, in_topic = np.log(counted), np.log(in_topic)
    anywhere = np.logaddexp(counted, np.log(known.new) + spelled) - np.log(known.seldom + known.new)
    size = known.by_topic[0]
    back = size * min(2 * known.new / max(known.seldom, 1), 0.5) + 1
    return np.logaddexp(in_topic, np.log(back)[topic] + anywhere) - np.log(size + back)[topic]


def _ask(shared, buckets: int):
    """What a text's tokens cost as the mixed predictors code them, and questions about what stands behind
    its escapes to the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model, _ = shared.value
        seen, logs = known.frequent["n"] > 0, np.log10(known.frequent["n"] + 0.5)
        texts_of = known.by_topic[1]
        told = np.log((texts_of + 1) / (texts_of.sum() + TOPICS + 1))
        for batch in batches:
            for piece in pieces(batch, TEXT, PIECE):
                found = words(piece.column(TEXT), lower=True)
                place, row, topic, (a, b) = _placed(known, found)
                n = len(topic)
                often = place >= 0
                at, own = place[often], row[often]
                sums = [
                    np.bincount(own, seen[at], n).astype(np.int64),
                    np.bincount(own, logs[at], n),
                    np.bincount(row, model.costs(_coded(known, place, row, topic, a)), n) + told[topic],
                ]
                k1, k2 = piece.column("k1").to_numpy(), piece.column("k2").to_numpy()
                plain = [k1, k2, found.counts + 1, cm.spelled(found), *sums, np.ones(n, np.int64)]
                kinds = [pa.float64() if x.dtype.kind == "f" else pa.int64() for x in plain]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1 % buckets), pa.nulls(n, pa.binary()), *[pa.array(x, t) for x, t in zip(plain, kinds)]],
                    ["bucket", "payload", *_NAMES],
                )
                yield from _questions(found, a, b, np.flatnonzero(~often), row, topic, piece, buckets)

    def _questions(found, a, b, seldom, row, topic, piece, buckets):
        if not len(seldom):
            return
        one, of, _ = kinds(a[seldom])
        key, n = np.unique(of * np.int64(len(topic)) + row[seldom], return_counts=True)
        unit, text = key // len(topic), key % len(topic)
        lead = np.flatnonzero(np.diff(unit, prepend=-1))
        token = seldom[one]
        start, size = (x[token] for x in spans(found))
        some = np.empty(len(lead), _UNITS)
        some["a"], some["b"], some["size"] = a[token], b[token], size
        some["uses"] = np.diff(np.append(lead, len(unit)))
        rows = np.empty(len(topic), _TEXTS)
        rows["k1"], rows["k2"] = piece.column("k1").to_numpy(), piece.column("k2").to_numpy()
        rows["topic"], rows["learned"] = topic, piece.column("learned").to_numpy(zero_copy_only=False)
        out = []
        for bucket, places in _dealt(buckets, some["a"]):
            part = some[places]
            uses = np.repeat(lead[places], part["uses"]) + _counting(part["uses"])
            use = np.empty(len(uses), _USES)
            asked, use["text"] = np.unique(text[uses], return_inverse=True)
            use["n"] = n[uses]
            out.append((bucket, pack(part, use, rows[asked], cut_out(found.data, start[places], size[places]))))
        empty = [pa.nulls(len(out), pa.float64() if c in ("base", "score") else pa.int64()) for c in _NAMES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in out], pa.int64()), pa.array([p for _, p in out], pa.binary()), *empty],
            ["bucket", "payload", *_NAMES],
        )

    return run


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size."""
    sizes = sizes.astype(np.int64)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _answer(shared):
    def work(bucket: int, payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        known, _, spelling = shared.value
        units, uses, texts, bytes_, seen = [], [], [], [], 0
        for payload in payloads:
            unit, use, text, data = unpack(payload, _UNITS, _USES, _TEXTS, _BYTES)
            use = use.copy()
            use["text"] += np.uint32(seen)
            seen += len(text)
            units.append(unit), uses.append(use), texts.append(text), bytes_.append(data)
        unit, use, text, data = (np.concatenate(x) for x in (units, uses, texts, bytes_))
        order, group = grouped(unit["a"], unit["b"])
        word_of = np.empty(len(unit), np.int64)
        word_of[order] = group
        word = np.repeat(word_of, unit["uses"])
        one = order[np.flatnonzero(np.diff(group, prepend=-1))]
        start, size = _starts(unit["size"])[one], unit["size"][one]
        costs = [
            spelling.costs(cm.Units.of_words(cut_out(data, start[x], size[x]), size[x], np.ones(len(x))))
            for x in _parts(np.arange(len(one)), size, cm.MOST_PIECE)
        ]
        spelled = np.concatenate(costs)[word]
        of = use["text"].astype(np.int64)
        n, topic = use["n"].astype(np.float64), text["topic"][of].astype(np.int64)
        learned = n * text["learned"][of]
        counted = np.bincount(word, learned)[word]
        _, pair, _ = kinds(mix((word * (TOPICS + 1) + topic).astype(np.uint64)))
        in_topic = np.bincount(pair, learned)[pair]
        p = _chance(known, counted, in_topic, topic, spelled)
        sums = [
            np.bincount(of, n * (counted > 0), seen).astype(np.int64),
            np.bincount(of, n * np.log10(counted + 0.5), seen),
            np.bincount(of, n * p, seen),
        ]
        # Copies of a text each bring their own sums, so one row for each digest goes on.
        order, group = grouped(text["k1"].view("<u8"), text["k2"].view("<u8"))
        first = order[np.flatnonzero(np.diff(group, prepend=-1))]
        known_, base, score = (np.bincount(group, x[order]) for x in sums)
        nothing = np.zeros(len(first), np.int64)
        columns = [text["k1"][first], text["k2"][first], nothing, nothing, known_.astype(np.int64), base, score, nothing]
        for s in range(0, len(first), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[s : s + 10_000]) for c in columns], _NAMES)

    return work


def score(
    docs: DataFrame,
    learns: Column,
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte`` to
    every row. ``learns`` says which rows are learned from (null: not)."""
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    inside = {c: f"_{k}" for k, c in enumerate(names)}
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(
        *[F.col(c).alias(i) for c, i in inside.items()],
        F.xxhash64(whole).alias("k1"),
        F.xxhash64(F.lit(7), whole).alias("k2"),
        F.coalesce(learns, F.lit(False)).alias("learned"),
        whole.alias(TEXT),
    )
    size = texts.agg(F.coalesce(F.sum(F.octet_length(TEXT)), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    taught = texts.filter("learned")
    model, spelling, known = learn(taught, *count(taught, buckets))
    shared = docs.sparkSession.sparkContext.broadcast((known, model, spelling))
    asked = texts.select("k1", "k2", "learned", TEXT).mapInArrow(
        _ask(shared, buckets), "bucket long, payload binary, " + SUMS
    )
    sums = by_bucket(asked, _answer(shared), SUMS, _NAMES)
    total = sums.groupBy("k1", "k2").agg(*[F.sum(c).alias(c) for c in _NAMES[2:]])
    copies = F.col("copies")
    base = F.log10(F.lit(known.tokens + 0.5 * (known.distinct + 1)))
    scored = total.select(
        "k1",
        "k2",
        (F.col("n_tokens") / copies).cast("long").alias("n_tokens"),
        F.round(F.col("n_known") / copies).cast("long").alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") / copies - F.col("n_tokens") / copies * base).alias("base_score"),
        (F.col("score") / copies / np.log(10)).alias("score"),
        (-F.col("score") / np.log(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )
    rows = texts.drop(TEXT, "learned").join(scored, ["k1", "k2"]).drop("k1", "k2")
    return rows.withColumnsRenamed({i: c for c, i in inside.items()})
