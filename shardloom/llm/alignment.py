"""Alignment of two tokenizers over the same texts, scored by how many documents hold each link.

Each text is encoded twice: with tokenizer A (a byte-level BPE, given ``" " + text``) and with
tokenizer B (a sentencepiece model, which adds the space itself). Both token sequences spell the
same bytes, so their end offsets can be compared: offsets where an A token and a B token both end
cut the text into groups, and every A token and B token whose byte ranges overlap form a link.

Counting documents per linked id pair uses inverted pair bitmaps. A task numbers its documents in
chunks of 65,536; for every id pair it keeps, per chunk, the set of documents that hold the pair
(a sorted list of 16-bit positions, or a 65,536-bit map where that is smaller), and one such set per
bit of the pair's multiplicity in a document (multiplicity planes). The presence set of a chunk is
the OR of its planes; its popcount summed over chunks is the pair's document count, one aggregation
over compact containers instead of one row per document and pair. Postings then return scores: each
plane container, joined with its pair's count, adds ``2^plane x count`` to the documents it holds,
summed inside the task before one more aggregation by document.

Defined results, per row: null and empty texts, and texts whose A or B bytes joined differ from
``" " + text`` (where a tokenizer normalises), have no tokens: all counts 0 and ``groups`` ''. Tokens
of no bytes link with nothing. Special-token strings inside texts are plain text. Repeated rows are
documents of their own and count twice. ``n_best`` counts links whose pair count is the highest of
any pair with the same A id, ties included. An empty table gives no rows. Texts of any length are
encoded whole. Input columns keep their names and values; one named like a result column gives way
to it, and internal names cannot clash because the input travels as one nested column.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from shardloom.llm.frames import stored
from shardloom.session import BROADCAST_ROWS

A_FILE = "byte_bpe_50k.json"
#: The same vocabulary as merge ranks, for a faster encoder that gives the same ids (tested).
A_RANKS = "byte_bpe_50k.tiktoken"
B_FILE = "piece_bpe_32k.model"
MARK = "▁"  # sentencepiece's sign for a space
CHUNK_BITS = 16  # documents of a chunk: 2^16
_B_BITS = 15  # B ids below 2^15 in a pair key
BATCH_TEXT = 1 << 20  # characters encoded at once; the libraries hold several bytes of state per character
FLUSH = 1 << 21  # (document, pair) entries a task holds before it writes their containers

RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")


def _byte_values() -> dict[str, int]:
    """Byte-level BPE spells each byte as one character: printable Latin-1 bytes as themselves, the
    others as the characters from U+0100 on, in byte order (the usual rule of such vocabularies)."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars, shifted = {}, 0
    for byte in range(256):
        if byte in own:
            chars[chr(byte)] = byte
        else:
            chars[chr(256 + shifted)] = byte
            shifted += 1
    return chars


class _Ranked:
    """Encoder A by its merge ranks: the byte-level BPE of ``A_FILE`` with its split pattern, special
    strings as plain text, about a quarter of the other library's CPU time."""

    def __init__(self, ranks_path: str) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as handle:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, handle)}
        self.encoding = tiktoken.Encoding(
            "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(t) for t in texts]


class _Library:
    def __init__(self, a: Tokenizer) -> None:
        self.a = a

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str, a_ranks: str | None = None):
    """Encoder A (by its ranks where given), B, and each id's bytes (lengths and contents)."""
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    values = _byte_values()
    a_bytes = [b""] * a.get_vocab_size(with_added_tokens=True)
    for token, i in a.get_vocab(with_added_tokens=True).items():
        a_bytes[i] = bytes(values[c] for c in token) if all(c in values for c in token) else token.encode()
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        else:
            b_bytes.append(piece.replace(MARK, " ").encode())
    encoder = _Ranked(a_ranks) if a_ranks else _Library(a)
    return encoder, b, _Spelling(a_bytes), _Spelling(b_bytes), _Digits(max(len(a_bytes), len(b_bytes)))


class _Spelling:
    """Every id's bytes in one array, so a sequence of ids is spelled by one gather."""

    def __init__(self, table: list[bytes]) -> None:
        self.lengths = np.array([len(x) for x in table], np.int64)
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]]
        self.blob = np.frombuffer(b"".join(table), np.uint8)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.lengths[ids])

    def spells(self, ids: np.ndarray, ends: np.ndarray, full: np.ndarray) -> bool:
        if not len(ids):
            return len(full) == 0
        if ends[-1] != len(full):
            return False
        lengths = self.lengths[ids]
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return bool(np.array_equal(self.blob[shift + np.arange(len(full))], full))


def _distinct(ascending: np.ndarray) -> np.ndarray:
    return ascending[np.r_[True, ascending[1:] != ascending[:-1]]] if len(ascending) else ascending


def align_one(text: str | None, a_ids: np.ndarray, b_ids: np.ndarray, tables) -> tuple:
    """(n_a, n_b, n_groups, n_links, groups spelled in UTF-8, pair keys, multiplicities) of one text."""
    _, _, a_spelling, b_spelling, digits = tables
    none = (0, 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not text:
        return none
    full = np.frombuffer((" " + text).encode(), np.uint8)
    a_end, b_end = a_spelling.ends(a_ids), b_spelling.ends(b_ids)
    if not (a_spelling.spells(a_ids, a_end, full) and b_spelling.spells(b_ids, b_end, full)):
        return none
    # Every stretch between consecutive ends lies in one A token and one B token: one link each.
    # Ends ascend in each sequence; equal neighbours are tokens of no bytes.
    merged = np.sort(np.concatenate([_distinct(a_end), _distinct(b_end)]), kind="stable")
    twice = merged[1:] == merged[:-1]
    cuts = merged[1:][twice]
    ends = merged[np.r_[True, ~twice]]
    in_a, in_b = np.searchsorted(a_end, ends, "left"), np.searchsorted(b_end, ends, "left")
    keys = np.sort((a_ids[in_a].astype(np.int64) << _B_BITS) | b_ids[in_b].astype(np.int64))
    first = np.r_[True, keys[1:] != keys[:-1]]
    pairs = keys[first]
    times = np.diff(np.r_[np.nonzero(first)[0], len(keys)])
    # Groups spelled in order: A ids, '|', B ids, ';' between groups. Both sides ascend by group, so
    # a token's place is its own index plus the other side's tokens of earlier groups.
    a_group, b_group = np.searchsorted(cuts, a_end, "left"), np.searchsorted(cuts, b_end, "left")
    at_a = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group, "left")
    at_b = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    ids[at_a], ids[at_b] = a_ids, b_ids
    marks = np.empty(len(ids), np.uint8)
    marks[at_a] = np.where(np.r_[a_group[1:] != a_group[:-1], True], ord("|"), ord(","))
    marks[at_b] = np.where(np.r_[b_group[1:] != b_group[:-1], True], ord(";"), ord(","))
    return len(a_ids), len(b_ids), len(cuts), len(ends), digits.spell(ids, marks), pairs, times


def _flat(lists: list[list[int]]) -> list[np.ndarray]:
    """Lists of ids as arrays, converted in one pass."""
    sizes = np.fromiter((len(x) for x in lists), np.int64, count=len(lists))
    flat = np.fromiter(itertools.chain.from_iterable(lists), np.int64, count=int(sizes.sum()))
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(lists) else []


class _Digits:
    """Decimal spellings of all ids in one array, so a sequence of ids with a mark after each is
    written by one gather."""

    def __init__(self, count: int) -> None:
        words = [str(i).encode() for i in range(count)]
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.r_[0, np.cumsum(self.lengths)[:-1]]
        self.blob = np.frombuffer(b"".join(words) + b"\0", np.uint8)

    def spell(self, ids: np.ndarray, marks: np.ndarray) -> bytes:
        """``ids`` in decimal, each followed by its mark, the last mark left out."""
        if not len(ids):
            return b""
        widths = self.lengths[ids] + 1
        places = np.r_[0, np.cumsum(widths)[:-1]]
        source = np.repeat(self.starts[ids] - places, widths) + np.arange(int(widths.sum()))
        out = self.blob[source]
        out[places + widths - 1] = marks
        return out[:-1].tobytes()


def _containers(pairs: np.ndarray, places: np.ndarray, times: np.ndarray, bits: int):
    """Presence (plane -1) and multiplicity planes of every pair of one chunk."""
    order = np.lexsort((places, pairs))
    pairs, places, times = pairs[order], places[order], times[order]
    starts = np.r_[0, np.nonzero(pairs[1:] != pairs[:-1])[0] + 1]
    stops = np.r_[starts[1:], len(pairs)]
    out_pair, out_plane, out_payload, out_bits = [], [], [], []
    for start, stop in zip(starts.tolist(), stops.tolist()):
        where, many = places[start:stop], times[start:stop]
        planes = [(-1, where)]
        top = int(many.max()).bit_length()
        planes += [(k, where[(many >> k) & 1 == 1]) for k in range(top)]
        for plane, held in planes:
            if not len(held):
                continue
            out_pair.append(int(pairs[start]))
            out_plane.append(plane)
            out_payload.append(encode_set(held, bits))
            out_bits.append(len(held))
    n = len(out_pair)
    return n, out_pair, out_plane, out_payload, out_bits


def encode_set(places: np.ndarray, bits: int = CHUNK_BITS) -> bytes:
    """Sorted positions below 2^bits as a list of 16-bit numbers, or as a map of 2^bits bits where
    that is smaller (above 1/16 of the positions)."""
    if len(places) <= (1 << bits) // 16:
        return b"L" + places.astype("<u2").tobytes()
    held = np.zeros(1 << bits, np.uint8)
    held[places] = 1
    return b"M" + np.packbits(held, bitorder="little").tobytes()


def decode_set(payload: bytes) -> np.ndarray:
    if payload[:1] == b"L":
        return np.frombuffer(payload[1:], "<u2").astype(np.int64)
    held = np.unpackbits(np.frombuffer(payload[1:], np.uint8), bitorder="little")
    return np.nonzero(held)[0].astype(np.int64)


def _encode(a_path: str, b_path: str, a_ranks: str | None, row_type: pa.DataType, spelled: bool, bits: int):
    fields = [
        ("_kind", pa.int8()), ("_doc", pa.int64()), ("_in", row_type), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ]
    fields += [("groups", pa.string())] if spelled else []
    fields += [("_pair", pa.int64()), ("_chunk", pa.int64()), ("_plane", pa.int32()), ("_payload", pa.binary()), ("_bits", pa.int64())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tokenizers(a_path, b_path, a_ranks)
        a, b = tables[0], tables[1]
        part = TaskContext.get().partitionId()
        seen = 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at_chunk, entries = None, 0

        def flush():
            if not held:
                return None
            pairs = np.concatenate([h[0] for h in held])
            places = np.concatenate([h[1] for h in held])
            times = np.concatenate([h[2] for h in held])
            held.clear()
            n, pair, plane, payload, popcounts = _containers(pairs, places, times, bits)
            if not n:
                return None
            columns = {
                "_kind": pa.array(np.ones(n, np.int8)), "_doc": pa.nulls(n, pa.int64()), "_in": pa.nulls(n, row_type),
                "_pair": pa.array(pair, pa.int64()), "_chunk": pa.array(np.full(n, at_chunk, np.int64)),
                "_plane": pa.array(plane, pa.int32()), "_payload": pa.array(payload, pa.binary()), "_bits": pa.array(popcounts, pa.int64()),
            }
            return pa.RecordBatch.from_arrays(
                [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
            )

        for batch in batches:
            texts = batch.column("_text").to_pylist()
            rows = batch.column("_in")
            start = 0
            while start < len(texts):
                # Pieces of bounded text, so very long texts do not gather in memory.
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size < BATCH_TEXT):
                    size += len(texts[stop] or "")
                    stop += 1
                # Equal texts of a piece are encoded and aligned once.
                piece = texts[start:stop]
                first: dict[str, int] = {}
                for t in piece:
                    first.setdefault(t or "", len(first))
                distinct = list(first)
                a_ids_all = _flat(a.ids([" " + t for t in distinct]))
                b_ids_all = _flat(b.encode(distinct, num_threads=1))
                aligned = [
                    align_one(t, a_ids_all[i], b_ids_all[i], tables) for i, t in enumerate(distinct)
                ]
                out = {k: [] for k in ("_doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")}
                for k, text in enumerate(piece):
                    number = seen + k
                    chunk = (part << 20) | (number >> bits)
                    if chunk != at_chunk:
                        entries = 0
                        done = flush()
                        if done is not None:
                            yield done
                        at_chunk = chunk
                    n_a, n_b, n_groups, n_links, groups, pairs, times = aligned[first[text or ""]]
                    place = number & ((1 << bits) - 1)
                    if len(pairs):
                        held.append((pairs.astype(np.int32), np.full(len(pairs), place, np.uint16), times.astype(np.int32)))
                        entries += len(pairs)
                        if entries > FLUSH:
                            # A chunk's containers may come in parts; their sets never share a document.
                            done = flush()
                            entries = 0
                            if done is not None:
                                yield done
                    out["_doc"].append((chunk << bits) | place)
                    out["n_a"].append(n_a)
                    out["n_b"].append(n_b)
                    out["n_groups"].append(n_groups)
                    out["n_links"].append(n_links)
                    out["groups_sha256"].append(hashlib.sha256(groups).hexdigest() if groups else "")
                    out["groups"].append(groups.decode() if spelled else None)
                seen += stop - start
                n = stop - start
                columns = {
                    "_kind": pa.array(np.zeros(n, np.int8)), "_in": rows.slice(start, n),
                    **{k: pa.array(v, pa.string() if k.startswith("groups") else pa.int64()) for k, v in out.items()},
                }
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
                )
                start = stop
        done = flush()
        if done is not None:
            yield done

    return run


_SCORES = "_doc long, _sum long, _best long"


def _returning(bits: int):
    """Scores the plane containers of a task return to their documents, summed per document."""
    return lambda batches: _returned(batches, bits)


def _returned(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    docs, sums, bests = [], [], []
    for batch in batches:
        chunks = batch.column("_chunk").to_numpy(zero_copy_only=False)
        planes = batch.column("_plane").to_numpy(zero_copy_only=False)
        counts = batch.column("_count").to_numpy(zero_copy_only=False)
        best = batch.column("_top").to_numpy(zero_copy_only=False).astype(np.int64)
        for k, payload in enumerate(batch.column("_payload").to_pylist()):
            held = decode_set(payload)
            weight = 1 << int(planes[k])
            docs.append((int(chunks[k]) << bits) | held)
            sums.append(np.full(len(held), weight * int(counts[k]), np.int64))
            bests.append(np.full(len(held), weight * int(best[k]), np.int64))
    if docs:
        every = np.concatenate(docs)
        keys, inverse = np.unique(every, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys),
                pa.array(np.bincount(inverse, np.concatenate(sums), len(keys)).astype(np.int64)),
                pa.array(np.bincount(inverse, np.concatenate(bests), len(keys)).astype(np.int64)),
            ],
            ["_doc", "_sum", "_best"],
        )


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    text: str = "text",
    keep: Sequence[str] | None = None,
    spelled: bool = False,
    chunk_bits: int = CHUNK_BITS,
    a_ranks: str | None = None,
) -> DataFrame:
    """The columns of ``keep`` (all by default) with ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum``, ``groups_sha256`` (hex SHA-256 of the groups spelled
    ``a1,a2|b1;a3|b2,b3``; '' without tokens) and, where ``spelled``, ``groups`` itself. A chunk holds
    ``2^chunk_bits`` documents (at most 16). ``a_ranks``, the merge ranks of A's vocabulary, lets a
    faster encoder give A's ids."""
    names = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    source = docs.select(
        F.struct(*[docs[c].alias(c) for c in names]).alias("_in"), docs[text].cast("string").alias("_text")
    )
    row_type = pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in source.schema["_in"].dataType.fields])
    out_type = T.StructType(
        [
            T.StructField("_kind", T.ByteType()), T.StructField("_doc", T.LongType()),
            T.StructField("_in", source.schema["_in"].dataType, True),
            *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
            T.StructField("groups_sha256", T.StringType()),
            *([T.StructField("groups", T.StringType())] if spelled else []),
            T.StructField("_pair", T.LongType()), T.StructField("_chunk", T.LongType()), T.StructField("_plane", T.IntegerType()),
            T.StructField("_payload", T.BinaryType()), T.StructField("_bits", T.LongType()),
        ]
    )
    encoded = stored(source.mapInArrow(_encode(a_path, b_path, a_ranks, row_type, spelled, chunk_bits), out_type), "align")
    documents = encoded.filter("_kind = 0")
    containers = encoded.filter("_kind = 1").select("_pair", "_chunk", "_plane", "_payload", "_bits")

    # Document counts: popcounts of the presence containers (OR of the planes), summed over chunks.
    counts = containers.filter("_plane = -1").groupBy("_pair").agg(F.sum("_bits").alias("_count"))
    counts = counts.withColumn("_a", F.shiftright("_pair", _B_BITS))
    highest = counts.groupBy("_a").agg(F.max("_count").alias("_most"))
    stats = stored(
        counts.join(highest, "_a").select("_pair", "_count", (F.col("_count") == F.col("_most")).alias("_top")), "align"
    )
    if stats.count() <= BROADCAST_ROWS:
        stats = F.broadcast(stats)
    planes = containers.filter("_plane >= 0").join(stats, "_pair")
    scores = planes.select("_chunk", "_plane", "_payload", "_count", "_top").mapInArrow(_returning(chunk_bits), _SCORES)
    scores = scores.groupBy("_doc").agg(F.sum("_sum").alias("_sum"), F.sum("_best").alias("_best"))
    joined = documents.join(scores, "_doc", "left")
    extra = ["groups"] if spelled else []
    return joined.select(
        *[F.col("_in")[c].alias(c) for c in names],
        "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
        *extra,
    )


def _arrow(spark_type: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(spark_type)
