"""Token counts of whole texts, as a sentencepiece model gives them.

No piece of such a model crosses from another character to the space mark, and none holds a line
feed; :func:`facts` proves both for the model at hand. So a text falls into pre-tokens (spaces with
what follows them up to the next space, and single line feeds) whose counts add up. The same
function proves which strings of the vocabulary come out as one token when they stand alone. Counting
looks those up; only other pre-tokens are merged by the library, and each distinct one once.

Rows are judged one by one: null and empty texts have no tokens, repeated rows get equal counts, an
empty table gives an empty result, texts may be of any length. Result columns replace input columns
of their name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.frames import with_columns
from shardloom.llm.text import raw

MARK = "▁"  # stands for a space inside the model
REMEMBERED = 400_000  # merged pre-tokens a task keeps before it starts anew
BATCH_TEXT = 16 << 20
FIELDS = "n_bytes long, n_tokens long"


@dataclass(frozen=True)
class Facts:
    """``alone``: pre-tokens proven to be one token. ``splits``: texts may be cut into pre-tokens."""

    alone: frozenset
    splits: bool


@lru_cache(maxsize=4)
def model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _after_line_feed(library, strings: list[str]) -> list[int]:
    """Tokens of strings that follow a line feed, which keeps the library from adding a space."""
    return [len(ids) - 2 for ids in library.encode(["\n" + s for s in strings], num_threads=1)]


def _after_space(library, strings: list[str]) -> list[int]:
    """Tokens of strings that begin with a space; the library adds that space itself."""
    cut = [s[1:] for s in strings]
    return [len(ids) or 1 for ids in library.encode(cut, num_threads=1)]


@lru_cache(maxsize=4)
def facts(path: str) -> Facts:
    """What can be proven from the vocabulary, once a process and without any text."""
    library = model(path)
    pieces = [
        library.id_to_piece(i)
        for i in range(library.get_piece_size())
        if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))
    ]
    crossing = any(MARK in p.lstrip(MARK) for p in pieces) or any("\n" in p for p in pieces)
    # Spaces must reach the pieces unchanged, one more in front, and a line feed must be one token.
    plain = [library.encode(s, out_type=str) for s in (" a", "a", "\na", "  ", "a \n")]
    wanted = [library.encode(MARK + "a", out_type=str), [MARK + "a"], [MARK, "<0x0A>", "a"]]
    steady = plain[:3] == wanted and plain[3] == [MARK * 3] and plain[4] == [MARK + "a", MARK, "<0x0A>"]
    spaced = [p.replace(MARK, " ") for p in pieces if p.startswith(MARK)]
    bare = [p for p in pieces if not p.startswith(MARK)]
    alone = {s for s, n in zip(spaced, _after_space(library, spaced)) if n == 1}
    alone |= {s for s, n in zip(bare, _after_line_feed(library, bare)) if n == 1}
    return Facts(frozenset(alone | {"\n"}), steady and not crossing)


def pre_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pre-tokens of all rows, and the place of each row's first (one more at the end).

    ``texts`` carry the space that the library puts in front of a text."""
    data, at = raw(texts)
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(at), np.int64)
    space, feed = data == 0x20, data == 0x0A
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
    cut[at] = True
    edges = np.flatnonzero(cut)
    cells = pa.LargeStringArray.from_buffers(
        len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )
    return cells, np.searchsorted(edges, at)


def _counter(path: str):
    library, known = model(path), facts(path)
    alone = pa.array(sorted(known.alone), pa.large_string())
    memory: dict[str, int] = {}

    def merged(strings: list[str]) -> list[int]:
        if len(memory) > REMEMBERED:
            memory.clear()
        new = [s for s in strings if s not in memory]
        spaced = [s for s in new if s.startswith(" ")]
        bare = [s for s in new if not s.startswith(" ")]
        found = dict(zip(spaced, _after_space(library, spaced)))
        found.update(zip(bare, _after_line_feed(library, bare)))
        counts = [found[s] if s in found else memory[s] for s in strings]
        memory.update(found)
        return counts

    def work(texts: pa.Array) -> list[pa.Array]:
        texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        if not known.splits:
            totals = np.array([len(x) for x in library.encode(texts.to_pylist(), num_threads=1)], np.int64)
        else:
            # The library puts a space in front of every text that isn't empty.
            led = pc.binary_join_element_wise(
                pa.array(np.where(sizes > 0, " ", ""), pa.large_string()), texts, pa.scalar("", pa.large_string())
            )
            cells, first = pre_tokens(led)
            distinct = cells.dictionary_encode()
            strings = distinct.dictionary
            counts = np.ones(len(strings), np.int64)
            rest = np.flatnonzero(~pc.is_in(strings, value_set=alone).to_numpy(zero_copy_only=False))
            counts[rest] = merged(strings.take(pa.array(rest)).to_pylist())
            each = counts[distinct.indices.to_numpy()] if len(cells) else np.zeros(0, np.int64)
            totals = np.diff(np.concatenate([[0], np.cumsum(each)])[first])
            # A space mark in the text itself acts as a space; such texts go to the library whole.
            marked = np.flatnonzero(pc.match_substring(texts, MARK).to_numpy(zero_copy_only=False))
            if len(marked):
                whole = library.encode(texts.take(pa.array(marked)).to_pylist(), num_threads=1)
                totals[marked] = [len(x) for x in whole]
        return [pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())]

    return work


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, limit: int = 4096
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` to every row. ``path`` is where each
    executor finds the model. One pass, no shuffle."""
    counted = with_columns(docs, text, partial(_counter, path), FIELDS, keep, BATCH_TEXT)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
