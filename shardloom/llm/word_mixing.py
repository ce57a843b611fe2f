"""Online logistic mixing of hashed-context bit predictors: which word comes next.

Words that are frequent have a binary code of their own (Huffman's, by their exact counts); all others
share the code of one more symbol, the escape, and are spelled behind it (``context_mixing``). A word is
coded bit by bit. Each bit is one node of the code's tree, and four predictors say how likely a one is
there: the exact counts of the words on either side of the node, what followed in texts of the same
topic, after the same word before, and after the same two words before. The first two have a cell for
every node, the others hashed tables that grow with the tokens learned from, up to ``MOST_BITS``. The predictors'
log odds are mixed with weights chosen by a gate (how sure the two word contexts are), and the mix is
refined by a table of what came true at that estimate and depth.

Learning is one pass, as in ``context_mixing``: every task predicts a piece, corrects weights and
refinement by what came true at every bit, then counts the piece. Counts and refinement of all tasks are added
up, weights are averaged by the bits they were corrected on. Scoring uses the result as it is.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shardloom.llm.context_mixing import BLOCK, FINE, RANGE, STEADY, _odds, blend, logistic, refine, set_odds, sure
from shardloom.llm.frames import as_blocks
from shardloom.llm.text import mix

K = 4  # exact counts, topic, one word before, two words before
LEAST_BITS, MOST_BITS = 16, 22  # of the slots of each hashed table
SURE = (1, 16, 40)  # of a word context, by its odds in sixteenths
GATES = 16
DEPTHS = 16  # refinement and its cells tell depths apart up to here
CELLS = DEPTHS * (2 * RANGE * FINE + 1)
STEP = 1 << 12  # tokens predicted at a time by a learner
COST_STEP = 1 << 13  # and where nothing is learned, which makes no difference to the result
FIRST_STEP = 1 << 3  # of a task; each stretch of its first piece is twice as long as the one before
_EXTRA_CELLS = 2 * CELLS + GATES * K + 1
STEPS = np.dtype([("at", "<i8"), ("odds", "<f4"), ("zero", "<f4")])
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Code:
    """Huffman's code of symbols by their counts. ``node[start[s]:start[s] + size[s]]`` and ``bit`` at the
    same places are the path of symbol ``s``; ``odds`` has the counts' log odds of a one at each node."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        weight = np.concatenate([counts + 0.5, np.zeros(n - 1)])
        parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.uint8)
        self.odds = np.zeros(n - 1, np.float32)
        heap = [(w, k) for k, w in enumerate(weight[:n].tolist())]
        heapq.heapify(heap)
        for k in range(n, 2 * n - 1):
            (one, i), (zero, j) = heapq.heappop(heap), heapq.heappop(heap)
            parent[[i, j]], side[i] = k, 1
            self.odds[k - n] = np.log(one) - np.log(zero)
            heapq.heappush(heap, (one + zero, k))
        up, symbols, levels = np.arange(n), np.arange(n), []
        while len(symbols):
            levels.append((symbols, parent[up] - n, side[up]))
            up = parent[up]
            on = up != 2 * n - 2
            up, symbols = up[on], symbols[on]
        self.size = np.zeros(n, np.int64)
        for symbols, _, _ in levels:
            self.size[symbols] += 1
        self.start = np.cumsum(self.size) - self.size
        self.node, self.bit = np.zeros(self.size.sum(), np.int32), np.zeros(self.size.sum(), np.uint8)
        for k, (symbols, nodes, bits) in enumerate(levels):
            at = self.start[symbols] + self.size[symbols] - 1 - k
            self.node[at], self.bit[at] = nodes, bits
        # Of each bit: its node with the bits since the last multiple of four (and a leading 1) behind it, the
        # node's odds, and 1 for a zero.
        path = np.arange(len(self.node))
        since = (path - np.repeat(self.start, self.size)) % 4
        local = np.ones(len(path), np.int64)
        for k in range(3):
            on = since > k
            local[on] = local[on] * 2 + self.bit[(path - since)[on] + k]
        self.step = np.empty(len(path), STEPS)
        self.step["at"] = self.node.astype(np.int64) * 16 + local
        self.step["odds"], self.step["zero"] = self.odds[self.node], 1 - self.bit
        self.group = mix((self.node + 1).astype(np.uint64) * _ODD)  # a hash of the node, where it opens four bits
        self.length = self.size.astype(np.uint8)
        self.longest = int(self.size.max())


def table_bits(tokens: int) -> int:
    return min(max((4 * tokens).bit_length(), LEAST_BITS), MOST_BITS)


class Tokens:
    """Tokens of whole texts in order: symbols, each text's topic, and hashes of the words before."""

    def __init__(self, symbols: np.ndarray, topic: np.ndarray, a: np.ndarray, row: np.ndarray):
        self.symbols, self.topic = symbols, topic
        before = np.zeros((2, len(a)), np.uint64)  # nothing before a text's first word
        for k in (1, 2):
            if len(a) > k:
                before[k - 1, k:] = np.where(row[k:] == row[:-k], a[:-k], np.uint64(0))
        one = mix(before[0] + _ODD)
        self.contexts = np.stack([one, mix(one + before[1] * _ODD)])


class Model:
    def __init__(self, code: Code, topics: int, bits: int):
        nodes = len(code.odds)
        self.code, self.nodes, self.shift = code, nodes, np.uint64(64 + 4 - bits)
        self.at = (topics * nodes, topics * nodes + (1 << bits))
        self.tables = np.array([[a] for a in self.at], np.uint64)
        slots = topics * nodes + (2 << bits)
        self.slots = -(-slots // (BLOCK // 2)) * (BLOCK // 2)
        self.odds = np.zeros(self.slots, np.int8)  # sixteenths
        self.weights = np.tile(np.array([0.4, 0.4, 0.2, 0.2], np.float32), (GATES, 1))
        self.came, self.cases = np.zeros(CELLS), np.zeros(CELLS)
        self.table = None  # of the refinement, made from both when it is first asked for

    @property
    def blocks(self) -> int:
        return self.slots * 2 // BLOCK

    def mixed(self, bits: Bits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log odds of the learned predictors in sixteenths, gate, log odds of the mix)."""
        found = self.odds.take(bits.slots)
        far = sure(found[1:], SURE)
        gate = (far[0] * np.uint8(4) + far[1]).astype(np.intp)
        return found, gate, blend(self.weights.take(gate, axis=0), bits.odds, *found)

    @staticmethod
    def cells(bits: Bits, odds: np.ndarray) -> np.ndarray:
        level = np.clip(odds, np.float32(-RANGE), np.float32(RANGE))
        level *= np.float32(FINE)
        np.rint(level, out=level)
        level += bits.cell  # whole numbers far below 2^24
        return level.astype(np.intp)

    def refined(self, bits: Bits, odds: np.ndarray) -> np.ndarray:
        """The probability of a one: the mean of the mix and of what came true at that estimate."""
        if self.table is None:
            weight = 1 / (self.cases + STEADY)
            self.table = np.stack([self.came * weight, 1 + STEADY * weight], 1).astype(np.float32) / 2
        return refine(self.table.take(self.cells(bits, odds), axis=0), odds)

    def costs(self, tokens: Tokens) -> np.ndarray:
        """The natural logarithm of each token's probability (of the escape's, if it has no code)."""
        out = np.zeros(len(tokens.symbols))
        for s in range(0, len(out), COST_STEP):
            e = min(s + COST_STEP, len(out))
            bits = Bits(self, tokens, s, e)
            p = self.refined(bits, self.mixed(bits)[2])
            p -= bits.zero
            out[s:e] = bits.sums(np.log(np.abs(p, out=p), out=p))
        return out


class Bits:
    """All bits of tokens ``s:e``: the first bits of all of them, then the second ones of those that have
    two, and so on. The tokens with the longest codes come first, so that those with a bit are always the first
    ``more`` ones. ``slots`` are those of the three learned predictors, ``odds`` those of the exact counts,
    ``cell`` is where the refinement of a depth is, and ``zero`` is 1 for a zero."""

    def __init__(self, model: Model, tokens: Tokens, s: int, e: int):
        code, symbols = model.code, tokens.symbols[s:e]
        length = code.length.take(symbols)
        self.order = np.argsort(np.uint8(255) - length, kind="stable")
        path = code.start.take(symbols.take(self.order))
        topic = tokens.topic[s:e].take(self.order) * model.nodes
        contexts = tokens.contexts[:, s:e].take(self.order, axis=1)
        more = len(symbols) - np.cumsum(np.bincount(length, minlength=code.longest + 1))
        self.more = more[more > 0].tolist()
        n = sum(self.more)
        self.slots = np.empty((K - 1, n), np.int64)
        self.odds, self.zero, self.cell = np.empty((3, n), np.float32)
        at = 0
        for depth, some in enumerate(self.more):
            to = slice(at, at + some)
            where = path[:some]
            if depth % 4 == 0:  # what a context has in its next four bits lies side by side
                hashed = code.group.take(where)
                base = contexts[:, :some] ^ hashed
                base *= _ODD
                base >>= model.shift
                base <<= np.uint64(4)
                base += model.tables
                base = base.view(np.int64)
            step = code.step.take(where)
            node = step["at"] & 15
            np.add(base[:, :some], node, out=self.slots[1:, to])
            np.right_shift(step["at"], 4, out=node)
            np.add(node, topic[:some], out=self.slots[0, to])
            self.odds[to], self.zero[to] = step["odds"], step["zero"]
            self.cell[to] = min(depth, DEPTHS - 1) * (2 * RANGE * FINE + 1) + RANGE * FINE
            where += 1
            at += some

    @property
    def one(self) -> np.ndarray:
        return 1 - self.zero.astype(np.int64)

    def sums(self, of_bits: np.ndarray) -> np.ndarray:
        """Added up for each token, in the tokens' own order."""
        total, at = np.zeros(len(self.order)), 0
        for some in self.more:
            total[:some] += of_bits[at : at + some]
            at += some
        out = np.empty(len(total))
        out[self.order] = total
        return out


class Learner:
    """A task's model of the pieces it has seen: predicts each piece before it counts it."""

    def __init__(self, model: Model):
        self._model, self.stale = model, False
        self.counts = np.zeros(2 * model.slots, np.float32)
        self.rounds, self.tokens, self.taught = 0, 0, 0.0

    @property
    def model(self) -> Model:
        """With the odds of all that has been counted."""
        if self.stale:
            set_odds(self._model.odds, self.counts)
            self.stale = False
        return self._model

    def add(self, tokens: Tokens) -> None:
        model, s, size = self.model, 0, len(tokens.symbols)
        early = not self.tokens
        while s < size:
            e = min(s + (min(max(s, FIRST_STEP), STEP) if early else STEP), size)
            bits = Bits(model, tokens, s, e)
            if s > 0 or not early:
                self._correct(model, bits)
            slots = bits.slots if early else bits.slots[1:]
            cells = slots * 2
            cells += bits.one
            cells = cells.reshape(-1)
            np.add.at(self.counts, cells, np.ones(len(cells), np.float32))
            if early and e <= 2 * STEP:
                used = slots.reshape(-1)
                model.odds[used] = _odds(self.counts.reshape(-1, 2)[used])
            s = e
        if not early:
            self._count_topics(model, tokens)
        self.tokens += size
        self.stale = True

    def _count_topics(self, model: Model, tokens: Tokens) -> None:
        """Counts the bits of all tokens by topic, those of equal tokens of a topic at once."""
        code, symbols = model.code, len(model.code.size)
        times = np.bincount(tokens.topic * symbols + tokens.symbols)
        some = np.flatnonzero(times)
        topic, symbol = some // symbols, some % symbols
        size = code.size[symbol]
        first = np.cumsum(size) - size
        path = np.arange(size.sum()) + np.repeat(code.start[symbol] - first, size)
        cells = (np.repeat(topic * model.nodes, size) + code.node[path]) * 2 + code.bit[path]
        self.counts[: 2 * model.at[0]] += np.bincount(cells, np.repeat(times[some], size), 2 * model.at[0])

    def _correct(self, model: Model, bits: Bits) -> None:
        found, gate, odds = model.mixed(bits)
        cell = model.cells(bits, odds)
        error = logistic(np.clip(odds, np.float32(-12), np.float32(12), out=odds))
        np.subtract(1 - bits.zero, error, out=error)
        self.rounds += 1
        rate = 0.5 / np.sqrt(1 + self.rounds / 40)
        total = np.maximum(np.bincount(gate, minlength=GATES), 64)
        for k in range(K):
            slope = np.bincount(gate, error * (found[k - 1] if k else bits.odds), GATES) / (total * (16 if k else 1))
            model.weights[:, k] += (rate * np.clip(slope, -0.2, 0.2)).astype(np.float32)
        cell *= 2
        cell += bits.one
        seen = np.bincount(cell, minlength=2 * CELLS)
        model.cases += seen[::2]
        model.cases += seen[1::2]
        model.came += seen[1::2]
        self.taught += len(cell)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """What the task has learned, as blocks that are added up over all tasks."""
        if not self.tokens:
            return
        model = self._model
        for at in range(0, len(self.counts), 64 * BLOCK):
            yield from as_blocks(self.counts[at : at + 64 * BLOCK].astype(np.float64), BLOCK, at // BLOCK)
        extra = np.zeros(-(-_EXTRA_CELLS // BLOCK) * BLOCK)
        extra[:CELLS], extra[CELLS : 2 * CELLS] = model.came, model.cases
        extra[2 * CELLS : _EXTRA_CELLS - 1] = model.weights.reshape(-1) * self.taught
        extra[_EXTRA_CELLS - 1] = self.taught
        yield from as_blocks(extra, BLOCK, model.blocks)


EXTRA_BLOCKS = -(-_EXTRA_CELLS // BLOCK)


class Assembly:
    """Puts the added-up blocks together."""

    def __init__(self, model: Model):
        self.model, self.extra = model, np.zeros(EXTRA_BLOCKS * BLOCK)

    def add(self, block: int, cells: np.ndarray) -> None:
        if block < self.model.blocks:
            at = block * (BLOCK // 2)
            self.model.odds[at : at + BLOCK // 2] = _odds(cells.reshape(-1, 2))
        else:
            at = (block - self.model.blocks) * BLOCK
            self.extra[at : at + BLOCK] = cells

    def done(self) -> Model:
        model, extra = self.model, self.extra
        taught = extra[_EXTRA_CELLS - 1]
        if taught:
            model.came, model.cases = extra[:CELLS].copy(), extra[CELLS : 2 * CELLS].copy()
            model.weights = (extra[2 * CELLS : _EXTRA_CELLS - 1] / taught).reshape(GATES, K).astype(np.float32)
        return model
