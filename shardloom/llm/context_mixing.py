"""Online logistic mixing of hashed-context bit predictors: what words cost when they are spelled.

A word is spelled as its UTF-8 bytes and closed by a space; a text's end is one byte. Bytes are predicted
bit by bit. Each predictor looks at one context (the last 1, 2, 4 or 6 bytes) and finds in a hashed
table how often 0 and 1 followed. The predictors' log odds are mixed with weights chosen by a gate (how
sure the last predictor is), and the mix is refined by a table of what came true at that estimate.
Contexts reach back to the mark the word before ends in, if any, so a word behind a mark always costs
the same, and each distinct one is computed once. Words without their text (``Units.of_words``) cost what
they do behind a letter or digit.

Learning is one pass over texts, or over distinct words with their counts. Every task goes piece by piece:
it predicts a piece, corrects weights and refinement by what came true at every bit, then counts the
piece. Bytes that are equal in equal contexts cost the same; each kind is computed once, with its count.
Its first stretches are short and counted at once, so that little text teaches weights, too. Counts
and refinement of all tasks are added up; weights are averaged by the bytes they were corrected on, and
those of a task that corrected nothing are left out. Scoring uses the result as it is, so a text's score
does not depend on its neighbours.

The tables' size is fixed, whatever the corpus. Without anything to learn from every bit is even.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from shardloom.llm.frames import as_blocks
from shardloom.llm.text import Words, kinds, mix, power_table

ORDERS = (1, 2, 4, 6)  # bytes of context
K = len(ORDERS)
SLOT_BITS = (18, 20, 22, 22)
AT = tuple(sum(1 << b for b in SLOT_BITS[:k]) for k in range(K + 1))  # where each table begins
SLOTS = AT[-1]
LEVELS = (8, 24, 48, 72, 96)  # gates: how sure the last predictor is, in sixteenths
GATES = len(LEVELS) + 1
BLOCK = 1 << 14
STEP = 1 << 14  # bytes predicted at a time by a learner
COST_STEP = 1 << 13  # different ones where nothing is learned, which makes no difference to the result
ALIKE = 1 << 19  # bytes among which equal ones are sought then
FIRST_STEP = 1 << 3  # of a task; each stretch of its first piece is twice as long as the one before
FIRST_PIECE, MOST_PIECE = 1 << 18, 4 << 20  # bytes a task learns from at first, and in the end
SPACE, END = 0x20, 0x0A
FINE, RANGE = 2, 16  # refinement cells: per unit of log odds, and units on either side
CELLS = 256 * (2 * RANGE * FINE + 1)
PRIOR = 0.4
STEADY = 30.0  # how many cases a refinement cell must have seen to weigh as much as the mix
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STRIDE = np.uint64(int(power_table(2)[1]))  # of a context's hash, a polynomial of its bytes
_OWN = np.array([(1 << 8 * (n + 1)) - 1 for n in range(ORDERS[-1] + 1)], np.uint64)  # n bytes before a byte, and it
_SHIFT = np.array([[64 + 4 - b] for b in SLOT_BITS], np.uint64)
_AT = np.array([[a] for a in AT[:-1]], np.int64)


def logistic(x: np.ndarray) -> np.ndarray:
    out = np.negative(x)
    np.exp(out, out=out)
    out += 1
    return np.divide(1, out, out=out)


# What a word ends in, if it is not a letter or digit: that counts for the word behind it.
_LEAD = np.arange(256, dtype=np.uint8)
_LEAD[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = SPACE


class Units:
    """Distinct (mark before, word) pairs of some texts. ``of`` has the unit of every token of the texts in
    order, ``first`` each text's first token; the last token of each is its end."""

    def __init__(self, found: Words):
        n = found.counts
        self.first = np.concatenate([[0], np.cumsum(n + 1)])
        row = np.repeat(np.arange(len(n)), n)
        token = np.arange(len(row)) + row  # places of words among tokens
        lead = np.full(self.first[-1] + 1, SPACE, np.uint8)
        if len(row):
            lead[token + 1] = _LEAD[found.data[found.end - 1]]
        lead[self.first[:-1]] = END
        key = np.zeros(self.first[-1], np.uint64)  # an end has hash 0
        key[token] = found.hashes() | np.uint64(1)
        key = mix(key + lead[:-1].astype(np.uint64) * _ODD)
        word = np.full(self.first[-1], -1)
        word[token] = np.arange(len(row))
        _, one, self.of, self.counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        # The bytes of each unit: what the word before ends in, the word, and what closes it.
        word, lead = word[one], lead[one]
        real = word >= 0
        size = np.where(real, found.end[word] - found.start[word], 0) if len(row) else np.zeros(len(one), np.int64)
        at = np.concatenate([[0], np.cumsum(size + 2)])
        data = np.full(at[-1], SPACE, np.uint8)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        if len(inside):
            data[np.repeat(at[:-1] + 1, size) + inside] = found.data[np.repeat(found.start[word], size) + inside]
        data[at[:-1]] = lead
        data[at[1:] - 1] = np.where(real, SPACE, END)
        unit = np.repeat(np.arange(len(one)), size + 2)
        coded = np.ones(at[-1], bool)
        coded[at[:-1]] = False
        self.place = np.flatnonzero(coded)
        self.unit, self.begin, self.data = unit[self.place], at[:-1][unit[self.place]], data
        self.word = word  # an occurrence of each unit's word, or -1 for an end

    @classmethod
    def of_words(cls, data: np.ndarray, size: np.ndarray, counts: np.ndarray) -> Units:
        """Each word of ``data`` a unit of its own, as behind a word without a mark."""
        new, size = cls.__new__(cls), size.astype(np.int64) + 2
        end = np.cumsum(size)
        new.data = np.full(size.sum(), SPACE, np.uint8)
        inside = np.ones(len(new.data), bool)
        inside[end - size], inside[end - 1] = False, False
        new.data[inside] = data
        coded = np.ones(len(new.data), bool)
        coded[end - size] = False
        new.place = np.flatnonzero(coded)
        new.unit = np.repeat(np.arange(len(size)), size - 1)
        new.begin, new.counts = (end - size)[new.unit], counts
        return new

    def only(self, asked: np.ndarray) -> Units:
        """The same with the bytes of some units only."""
        new, keep = copy.copy(self), asked[self.unit]
        new.place, new.unit, new.begin = self.place[keep], self.unit[keep], self.begin[keep]
        return new

    def alike(self, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        """Coded bytes ``s:e`` that are equal and have equal contexts cost the same. (One place of each kind
        among the coded bytes, the kind of every byte.)"""
        low = self.begin[s]
        data = self.data[low : self.place[e - 1] + 1].astype(np.uint64)
        key = data.copy()  # a byte and, above it, those before it: as many as the longest context has
        for back in range(1, ORDERS[-1] + 1):
            key[back:] |= data[:-back] << np.uint64(8 * back)
        reach = np.minimum(self.place[s:e] - self.begin[s:e], ORDERS[-1])
        key = key.take(self.place[s:e] - low)
        key &= _OWN.take(reach)
        key |= reach.astype(np.uint64) << np.uint64(56)
        one, of, _ = kinds(mix(key))  # which is another key for another one
        return s + one, of

    def contexts(self, which: np.ndarray | slice) -> np.ndarray:
        """A hash of each context of some coded bytes."""
        place = self.place[which]
        reach = place - self.begin[which]
        out = np.empty((K, len(place)), np.uint64)
        held, k = np.zeros(len(place), np.uint64), 0
        for back in range(1, ORDERS[-1] + 1):
            inside = reach >= back
            further = held * _STRIDE
            further += self.data.take(place - back, mode="clip")
            further += np.uint64(1)
            np.copyto(held, further, where=inside)
            if back == ORDERS[k]:
                np.add(held, np.minimum(reach, back).astype(np.uint64) * _ODD + np.uint64(k), out=out[k])
                k += 1
        return out


def _bits(units: Units, s: int, e: int):
    return _bits_of(units, slice(s, e))


def _bits_of(units: Units, which: np.ndarray | slice) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(slots of all predictors, bits so far with a leading 1, the bit) of each bit of some coded bytes.

    The slots of a context's first four bits lie side by side, and those of its last four."""
    contexts = units.contexts(which)
    byte = units.data[units.place[which]].astype(np.int64)
    base = None
    for j in range(8):
        node = (1 << j) | (byte >> (8 - j))
        if j % 4 == 0:
            half = mix(contexts + (node * 2 + 1).astype(np.uint64) * _ODD) >> _SHIFT
            base = (half.astype(np.int64) << 4) + _AT
        yield base + ((1 << j % 4) | (byte >> (8 - j) & ((1 << j % 4) - 1))), node, (byte >> (7 - j)) & 1


def _odds(counts: np.ndarray) -> np.ndarray:
    """Log odds in sixteenths from rows of (zeros, ones)."""
    n = counts.astype(np.float32) + np.float32(PRIOR)
    odds = np.log(n[:, 1] / n[:, 0])
    return np.clip(np.rint(np.float32(16) * odds), np.float32(-127), np.float32(127)).astype(np.int8)


def set_odds(odds: np.ndarray, counts: np.ndarray) -> None:
    """Writes the odds of all slots, a block at a time."""
    for at in range(0, len(counts), BLOCK):
        odds[at // 2 : (at + BLOCK) // 2] = _odds(counts[at : at + BLOCK].reshape(-1, 2))


def sure(odds: np.ndarray, levels: tuple[int, ...]) -> np.ndarray:
    """How many of the levels odds in sixteenths reach on either side."""
    far = np.abs(odds)
    out = (far >= levels[0]).view(np.uint8)
    for least in levels[1:]:
        out += (far >= least).view(np.uint8)
    return out


def blend(weights: np.ndarray, *odds: np.ndarray) -> np.ndarray:
    """The sum of log odds, each by its column of weights; whole numbers are sixteenths."""
    out = None
    for k, some in enumerate(odds):
        part = some * np.float32(1 / 16) if some.dtype == np.int8 else some.copy()
        part *= weights[:, k]
        out = part if out is None else np.add(out, part, out=out)
    return out


def refine(table: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Probabilities from the mix and the rows of the refinement's table (what came true, weight of the mix)."""
    p = logistic(odds)
    np.clip(p, np.float32(1e-5), np.float32(1 - 1e-5), out=p)
    p *= table[:, 1]
    p += table[:, 0]
    return np.clip(p, np.float32(1e-6), np.float32(1 - 1e-6), out=p)


class Model:
    """Log odds and evidence of every slot, weights by gate, and the refinement's counts."""

    def __init__(self):
        self.odds = np.zeros(SLOTS, np.int8)  # sixteenths
        self.weights = np.full((GATES, K), 0.3, np.float32)
        self.came = np.zeros(CELLS)
        self.cases = np.zeros(CELLS)
        self.table = None  # of the refinement, made from both when it is first asked for

    def set_block(self, block: int, counts: np.ndarray) -> None:
        """``counts`` has zeros and ones of the block's slots, side by side."""
        n = counts.reshape(-1, 2)
        at = block * (BLOCK // 2)
        self.odds[at : at + len(n)] = _odds(n)

    def mixed(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log odds of the predictors in sixteenths, gate, log odds of the mix)."""
        found = self.odds.take(slots)
        gate = sure(found[-1], LEVELS).astype(np.intp)
        return found, gate, blend(self.weights.take(gate, axis=0), *found)

    @staticmethod
    def cells(node: np.ndarray, odds: np.ndarray) -> np.ndarray:
        level = np.clip(odds, np.float32(-RANGE), np.float32(RANGE))
        level *= np.float32(FINE)
        cell = np.rint(level, out=level).astype(np.int64)
        cell += node * (2 * RANGE * FINE + 1) + RANGE * FINE
        return cell

    def refined(self, node: np.ndarray, odds: np.ndarray) -> np.ndarray:
        """The probability of a one: the mean of the mix and of what came true at that estimate, which
        counts as ``STEADY`` cases of the mix where little has been seen."""
        if self.table is None:
            weight = 1 / (self.cases + STEADY)
            self.table = np.stack([self.came * weight, 1 + STEADY * weight], 1).astype(np.float32) / 2
        return refine(self.table.take(self.cells(node, odds), axis=0), odds)

    def costs(self, units: Units, wanted: np.ndarray | None = None) -> np.ndarray:
        """The natural logarithm of each unit's probability (of the ``wanted`` ones; 0 for others)."""
        out = np.zeros(len(units.counts))
        if wanted is not None:
            asked = np.zeros(len(out), bool)
            asked[wanted] = True
            units = units.only(asked)
        for s in range(0, len(units.place), ALIKE):
            e = min(s + ALIKE, len(units.place))
            one, of = units.alike(s, e)
            cost = np.empty(len(one))
            for at in range(0, len(one), COST_STEP):
                some = one[at : at + COST_STEP]
                chance = np.ones(len(some))  # eight factors of a millionth at least don't underflow
                for slots, node, bit in _bits_of(units, some):
                    p = self.refined(node, self.mixed(slots)[2])
                    chance *= np.abs(p - (1 - bit))
                cost[at : at + len(some)] = np.log(chance)
            unit = units.unit[s:e]  # in ascending order
            out[unit[0] : unit[-1] + 1] += np.bincount(unit - unit[0], cost.take(of))
        return out


class Learner:
    """A task's model of the pieces it has seen: predicts each piece before it counts it."""

    def __init__(self):
        self.counts = np.zeros(2 * SLOTS, np.float32)
        self._model, self.stale = Model(), False
        self.rounds, self.words = 0, 0
        self.taught = 0.0  # bytes that weights and refinement were corrected on

    @property
    def model(self) -> Model:
        """With the odds of all that has been counted."""
        if self.stale:
            set_odds(self._model.odds, self.counts)
            self.stale = False
        return self._model

    def add(self, units: Units) -> None:
        model, times = self.model, units.counts
        early, s = not self.words, 0
        while s < len(units.place):
            e = min(s + (min(max(s, FIRST_STEP), STEP) if early else STEP), len(units.place))
            one, of = units.alike(s, e)
            m = np.bincount(of, times[units.unit[s:e]])
            added = np.tile(m.astype(np.float32), K)
            known = s > 0 or not early
            for slots, node, bit in _bits_of(units, one):
                if known:
                    self._correct(model, slots, node, bit, m)
                cells = slots * 2
                cells += bit
                np.add.at(self.counts, cells.reshape(-1), added)
                if early and e <= 2 * STEP:
                    used = slots.reshape(-1)
                    model.odds[used] = _odds(self.counts.reshape(-1, 2)[used])
            self.taught += m.sum() if known else 0
            s = e
        self.words += int(times.sum())
        self.stale = True

    def _correct(self, model, slots, node, bit, m) -> None:
        found, gate, odds = model.mixed(slots)
        cell = model.cells(node, odds)
        error = (bit - logistic(np.clip(odds, np.float32(-12), np.float32(12), out=odds))) * m
        self.rounds += 1
        rate = 0.5 / np.sqrt(1 + self.rounds / 40)
        total = np.maximum(np.bincount(gate, m, GATES), 64) * 16
        for k in range(K):
            slope = np.bincount(gate, error * found[k], GATES) / total
            model.weights[:, k] += (rate * np.clip(slope, -0.2, 0.2)).astype(np.float32)
        cell *= 2
        cell += bit
        seen = np.bincount(cell, m, 2 * CELLS)
        model.cases += seen[::2]
        model.cases += seen[1::2]
        model.came += seen[1::2]

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """What the task has learned, as blocks that are added up over all tasks."""
        if not self.words:
            return
        for at in range(0, 2 * SLOTS, 64 * BLOCK):
            yield from as_blocks(self.counts[at : at + 64 * BLOCK].astype(np.float64), BLOCK, at // BLOCK)
        extra = np.zeros(_EXTRA)
        extra[:CELLS], extra[CELLS : 2 * CELLS] = self._model.came, self._model.cases
        extra[2 * CELLS : _WEIGHT] = self._model.weights.reshape(-1) * self.taught
        extra[_WEIGHT] = self.taught
        yield from as_blocks(extra, BLOCK, TABLE_BLOCKS)


TABLE_BLOCKS = SLOTS * 2 // BLOCK  # the blocks behind these have the refinement and the weights
_WEIGHT = 2 * CELLS + GATES * K
_EXTRA = BLOCK * -(-(_WEIGHT + 1) // BLOCK)
BLOCKS_IN_ALL = TABLE_BLOCKS + _EXTRA // BLOCK


class Assembly:
    """Puts the added-up blocks together."""

    def __init__(self):
        self.model, self.extra = Model(), np.zeros(_EXTRA)

    def add(self, block: int, cells: np.ndarray) -> None:
        if block < TABLE_BLOCKS:
            self.model.set_block(block, cells)
        else:
            at = (block - TABLE_BLOCKS) * BLOCK
            self.extra[at : at + BLOCK] = cells

    def done(self) -> Model:
        model, extra = self.model, self.extra
        if extra[_WEIGHT]:
            model.came, model.cases = extra[:CELLS].copy(), extra[CELLS : 2 * CELLS].copy()
            mean = extra[2 * CELLS : _WEIGHT] / extra[_WEIGHT]
            model.weights = mean.reshape(GATES, K).astype(np.float32)
        return model


def spelled(found: Words) -> np.ndarray:
    """Bytes of each row as the model spells it: words, a space behind each, and the end."""
    sums = np.concatenate([[0], np.cumsum(found.end - found.start + 1)])
    return sums[found.first[1:]] - sums[found.first[:-1]] + 1
