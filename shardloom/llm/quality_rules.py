"""Quality by weak supervision: rules vote good or bad or abstain, expectation-maximisation estimates
how accurate each rule is, and documents stay whose posterior probability of being good is high.

Rows are whole documents; ``null`` texts have no words. A text fails outright (``base_failed``) with
fewer than 50 words, or if more than half of its words stand in repeated three-word windows; it is
never kept, whatever the votes. Rows are judged one by one: repeated rows get equal results, ties
don't arise, an empty table gives an empty result. Result columns replace input columns of their name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.frames import stored, with_columns
from shardloom.llm.text import Words, mix, raw, rolling, words

WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words

# The symbols counted as such, and each rule with the value up to which it votes good and
# the value from which it votes bad.
SYMBOLS = "#*$%&|<>"
RULES = {
    "symbols_per_word": (0.02, 0.15),
    "share_of_capitals": (0.20, 0.50),
    "share_of_marked_words": (0.03, 0.25),
    "share_of_repeated_words": (0.10, 0.40),
    "share_of_repeated_lines": (0.10, 0.40),
    "characters_a_word": (10.0, 16.0),
    "share_of_words_without_letter": (0.05, 0.25),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FIELDS = ", ".join(f"{c} long" for c in COUNTS) + ", votes int"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_IS_CAPITAL = np.zeros(256, bool)
_IS_CAPITAL[ord("A") : ord("Z") + 1] = True
_IS_LETTER = _IS_CAPITAL.copy()
_IS_LETTER[ord("a") : ord("z") + 1] = True
_IS_LETTER[128:] = True  # bytes of characters outside ASCII
_IS_MARK = np.zeros(256, bool)
_IS_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def _per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at])


def repeated_words(found: Words, width: int = WINDOW) -> np.ndarray:
    """Words of each row that stand in a ``width``-word window found twice or more in that row."""
    rows = len(found.first) - 1
    if len(found.start) < width:
        return np.zeros(rows, np.int64)
    row = found.row
    keys = rolling(found.hashes(), width)
    whole = row[: len(keys)] == row[width - 1 :]
    places = np.flatnonzero(whole)
    keys = mix(keys[places] ^ (row[places].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    # Keys alone in a small table are alone; the few others are sorted.
    cells = (keys >> np.uint64(43)).astype(np.int64)
    shared = np.flatnonzero(np.bincount(cells, minlength=1 << 21)[cells] > 1)
    order = shared[np.argsort(keys[shared])]
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    first = places[order[twice]]
    covered = np.zeros(len(found.start), bool)
    for k in range(width):
        covered[first + k] = True
    return _per_row(covered, found.first)


def repeated_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each row: lines with a word that equal an earlier line, and lines with a word."""
    again, lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts.to_pylist()):
        seen = set()
        for line in (text or "").split("\n"):
            if line.strip("\t\n\v\f\r "):
                lines[k] += 1
                again[k] += line in seen
                seen.add(line)
    return again, lines


def _measure():
    good = np.array([r[0] for r in RULES.values()])
    bad = np.array([r[1] for r in RULES.values()])

    def work(texts: pa.Array) -> list[pa.Array]:
        found = words(texts)
        data, at = raw(texts)
        n = found.counts
        bytes_, places = found.packed()
        by_row = places[found.first]
        chars = _per_row((bytes_ & 0xC0) != 0x80, by_row)
        letters = _IS_LETTER[bytes_]
        capitals = _per_row(_IS_CAPITAL[bytes_], by_row)
        has_letter = np.diff(np.concatenate([[0], np.cumsum(letters, dtype=np.int64)])[places]) > 0
        # A marked word is of marks only or ends in two marks or more.
        last, before = bytes_[places[1:] - 1], bytes_[np.maximum(places[1:] - 2, places[:-1])]
        marked = _IS_MARK[last] & (_IS_MARK[before] | ~has_letter)
        marked |= (np.diff(places) > 1) & np.isin(last, list(SYMBOLS.encode()))
        symbols = _per_row(_IS_SYMBOL[data], at)
        again, lines = repeated_lines(texts)
        twice = repeated_words(found)
        some = np.maximum(n, 1)
        values = np.stack(
            [
                symbols / some,
                capitals / np.maximum(_per_row(letters, by_row), 1),
                _per_row(marked, found.first) / some,
                twice / some,
                again / np.maximum(lines, 1),
                chars / some,
                _per_row(~has_letter, found.first) / some,
            ]
        ).T
        # A vote is 0 for bad, 1 for abstained, 2 for good; all of them make one number.
        votes = np.where(values <= good, 2, np.where(values >= bad, 0, 1))
        votes[n == 0] = 1
        pattern = votes @ (3 ** np.arange(len(RULES)))
        columns = [n, chars, symbols, again, twice]
        return [pa.array(c, pa.int64()) for c in columns] + [pa.array(pattern, pa.int32())]

    return work


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> dict:
    """Expectation-maximisation over vote patterns: for either truth, how often each rule votes bad,
    abstains and votes good, and how many documents are good.

    It starts from "bad where any rule says so". A rule is never taken to vote good more often on bad
    documents than on good ones, nor bad more often on good ones, so the two can't change places."""
    votes = patterns[:, None] // 3 ** np.arange(len(RULES)) % 3
    cast = np.stack([votes == v for v in range(3)], axis=2).astype(float)  # pattern, rule, vote
    posterior = np.where((votes == 0).any(axis=1), 0.05, 0.95)
    start = np.array([[5.0, 3.0, 2.0], [0.2, 0.8, 9.0]])  # what is supposed before any vote is seen
    shares, prior, before = None, 0.9, None
    for _ in range(rounds):
        weights = np.stack([counts * (1 - posterior), counts * posterior])
        seen = np.einsum("tp,prv->trv", weights, cast) + start[:, None, :]
        shares = seen / seen.sum(axis=2, keepdims=True)
        for v, sign in ((0, 1), (2, -1)):
            wrong = sign * (shares[0, :, v] - shares[1, :, v]) < 0
            shares[:, wrong, v] = shares[:, wrong, v].mean(axis=0)
        shares /= shares.sum(axis=2, keepdims=True)
        prior = float(np.clip((weights[1].sum() + 9) / (counts.sum() + 10), 0.02, 0.98))
        evidence = np.einsum("prv,rv->p", cast, np.log(shares[1]) - np.log(shares[0]))
        posterior = 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + evidence)))
        if before is not None and np.abs(posterior - before).max(initial=0) < 1e-10:
            break
        before = posterior
    says = shares / np.maximum(1 - shares[:, :, 1:2], 1e-12)  # among those that don't abstain
    return {
        "accuracy_on_bad": dict(zip(RULES, says[0, :, 0].tolist())),
        "accuracy_on_good": dict(zip(RULES, says[1, :, 2].tolist())),
        "prior": prior,
        "posterior": posterior,
    }


def judge(
    docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, threshold: float = 0.5
) -> DataFrame:
    """Add the counts, ``posterior`` (of being good), ``base_failed`` and ``kept`` to every row.

    Texts are read once. The votes of all rows count towards the estimate, by pattern: there are at
    most 3 to the number of rules of them, which is what reaches the driver."""
    scored = stored(with_columns(docs, text, _measure, FIELDS, keep), "quality-rules")
    seen = scored.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").toPandas()
    patterns = seen["votes"].to_numpy(np.int64)
    fitted = estimate(patterns, seen["n"].to_numpy(np.float64))
    rows = [(int(p), float(q)) for p, q in zip(patterns, fitted["posterior"])]
    table = docs.sparkSession.createDataFrame(rows, "votes int, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    return (
        scored.drop("posterior", "base_failed", "kept")
        .join(F.broadcast(table), "votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
        .drop("votes")
    )
