"""Mixing sources to target weights by the cube method.

Sources in code point order (null last) weigh 1, 2, 3, 1, ... and share all words by weight; a target
stops at three times its source's size and what is over is shared among the others. A document of a
source with ratio ``target / size = whole + part`` is taken ``whole`` times for sure and once more
with probability ``part``. Which documents get that extra copy is balanced sampling: inclusion
probabilities move through the null space of the constraints "number of documents" and "number of
words" until they are 0 or 1 (the flight); every group of documents leaves at most two undecided,
these fly together again, and at most ten documents a source are left to the landing.

Equal rows count as one unit with a multiplicity: all but one of their extra copies are then certain.
Null texts and empty texts have size 0 and follow the same draw. Draws come from hashes, so reruns
agree, however the rows are partitioned. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.frames import stored
from shardloom.operators.ordering import join_null_safe, positions
from shardloom.session import measured

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
GROUP_ROWS = 10_000
LARGE = 4  # times the median size
LANDING = 10  # documents a source leaves to the landing
RESERVE = 200
WORD = r"[^\x20\x09-\x0D]+"
SEED = 20_240_301


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, rows, source_size, target): one row a source; only sums reach the driver."""
    totals = sized.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum("size").alias("source_size")
    )
    ranked = positions(
        totals.withColumn("_last", F.col("source").isNull()), ["_last", "source"]
    )
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("pos") % len(WEIGHTS) + 1).cast("int"))
    ranked = stored(
        ranked.select("source", "rows", "source_size", weight.cast("double").alias("weight")), "sources"
    )
    # The share of one unit of weight grows as sources reach their limit; each round fixes more of them.
    top = F.col("source_size") * float(MOST_COPIES)
    share = 0.0
    while True:
        full = top <= F.col("weight") * share
        row = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).cast("double").alias("all"),
            F.coalesce(F.sum(F.when(full, top)), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        new = (row["all"] - row["full"]) / row["weight"] if row["weight"] else share
        if new <= share * (1 + 1e-12):
            break
        share = new
    return ranked.withColumn("target", F.least(top, F.col("weight") * share)).drop("weight")


# --- the flight -------------------------------------------------------------------------------------


def _draws(salt: str) -> Iterator[float]:
    made = np.random.Generator(np.random.PCG64([SEED, *salt.encode()]))
    while True:
        yield from made.random(1024).tolist()


def _step(p: np.ndarray, u: np.ndarray, places: np.ndarray, draw: float) -> None:
    """Move ``p[places]`` along ``u`` to a bound, forth or back, so that its expectation stays."""
    q = p[places]
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
        down = np.where(u > 0, q / u, np.where(u < 0, -(1 - q) / u, np.inf)).min()
    q = q + (up if draw * (up + down) < down else -down) * u
    q[q < 1e-9] = 0.0
    q[q > 1 - 1e-9] = 1.0
    p[places] = q


def settle(p: np.ndarray, s: np.ndarray, unit: int, draws: Iterator[float]) -> None:
    """Decide one unit; all other open ones make up for it with small moves."""
    while 0.0 < p[unit] < 1.0:
        others = np.flatnonzero((p > 0) & (p < 1))
        others = others[others != unit]
        if len(others) < 2:
            return
        t = s[others]
        middle = t.mean()
        spread = ((t - middle) ** 2).sum()
        slope = 0.0 if spread <= 0 else (s[unit] - middle) / spread
        if spread <= 0 and s[unit] != middle and middle > 0:
            u = np.full(len(t), -s[unit] / (middle * len(t)))  # equal sizes: words come before documents
        else:
            u = -1 / len(t) - slope * (t - middle)
        _step(p, np.append(u, 1.0), np.append(others, unit), next(draws))


def fly(chance: np.ndarray, size: np.ndarray, draws: Iterator[float], leave: int = 2) -> np.ndarray:
    """Move probabilities until at most ``leave`` lie strictly between 0 and 1, keeping their sum and
    their sum weighted by size, and every expectation. ``size`` falls. Where only documents of one size
    are left to make up for another, the words are kept and the number of documents gives way.

    Large documents are decided first, while many others can make up for them; then three documents
    at a time move along the one direction that keeps both sums; the smallest are kept for the end,
    where they make up for what the middle has left."""
    p, s = chance.copy(), size
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if len(open_) > leave:
        usual = np.median(s[open_])
        for k in open_[s[open_] > LARGE * usual]:
            settle(p, s, k, draws)
        open_ = np.flatnonzero((p > 0) & (p < 1))
        _by_threes(p, s, open_[:-RESERVE], draws)
        for k in np.flatnonzero((p > 0) & (p < 1)):
            if ((p > 0) & (p < 1)).sum() <= leave:
                break
            settle(p, s, k, draws)
    return p


def _by_threes(p: np.ndarray, s: np.ndarray, units: np.ndarray, draws: Iterator[float]) -> None:
    q, t = p[units].tolist(), s[units].tolist()
    waiting = list(range(len(q)))[::-1]
    active: list[int] = []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3:
            break
        a, b, c = active
        u = (t[c] - t[b], t[a] - t[c], t[b] - t[a])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        forth = back = float("inf")
        for k, x in zip(active, u):
            if x > 0:
                forth, back = min(forth, (1 - q[k]) / x), min(back, q[k] / x)
            elif x < 0:
                forth, back = min(forth, -q[k] / x), min(back, -(1 - q[k]) / x)
        move = forth if next(draws) * (forth + back) < back else -back
        for k, x in zip(active, u):
            q[k] += move * x
            if q[k] < 1e-9:
                q[k] = 0.0
            elif q[k] > 1 - 1e-9:
                q[k] = 1.0
        active = [k for k in active if 0.0 < q[k] < 1.0]
    p[units] = q


def land(chance: np.ndarray, size: np.ndarray, draws: Iterator[float]) -> np.ndarray:
    """Decide a source's last documents, at most ``LANDING`` of them: of all ways to round them, the
    few whose words come closest are kept, and one is drawn by how likely it was."""
    p = chance.copy()
    rest = np.flatnonzero((p > 0) & (p < 1))
    if len(rest):
        ways = np.arange(1 << len(rest))[:, None] >> np.arange(len(rest)) & 1
        off = np.abs(ways @ size[rest] - p[rest] @ size[rest])
        count = np.abs(ways.sum(axis=1) - p[rest].sum())
        best = np.lexsort((count, off))[: 1 << max(len(rest) - 6, 0)]
        odds = np.where(ways[best] == 1, p[rest], 1 - p[rest]).prod(axis=1)
        pick = np.searchsorted(np.cumsum(odds) / odds.sum(), next(draws), "right")
        p[rest] = ways[best[min(pick, len(best) - 1)]]
    return p


def _decider(last: bool):
    def decide(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "_a", "_b"], ascending=[False, True, True], kind="stable")
        group = group.reset_index(drop=True)
        salt = f"{group['source'].iat[0]}/{group['_group'].iat[0]}/{len(group)}/{group['size'].sum()}"
        draws = _draws(salt)
        size = group["size"].to_numpy(float)
        chance = fly(group["chance"].to_numpy(float), size, draws, LANDING if last else 2)
        group["chance"] = land(chance, size, draws) if last else chance
        return group

    return decide


def _split(units: DataFrame) -> DataFrame:
    """Decide every unit's chance, in groups of bounded size, round by round."""
    done = []
    widest = units.agg(F.max("_groups")).first()[0] or 1
    while True:
        last = widest <= 1
        flown = units.groupBy("source", "_group").applyInPandas(_decider(last), units.schema)
        flown = stored(flown, "cube")
        if last:
            done.append(flown)
            return reduce(DataFrame.unionByName, done)
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(flown.filter(~open_))
        # Two units a group at most are left: the next round has far fewer groups.
        groups = F.ceil(F.col("_groups") * 2 / GROUP_ROWS)
        units = flown.filter(open_).withColumn("_groups", groups.cast("long"))
        units = units.withColumn("_group", F.pmod("_b", F.col("_groups")))
        widest = -(-widest * 2 // GROUP_ROWS)


def units_of(sized: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every distinct ``key`` with its source's size and target and the copies it gets in all.

    ``sized`` has ``source``, ``size`` and the key. The result has the key, ``source``, ``size``,
    ``source_size``, ``target``, ``n`` (rows with that key) and ``copies`` (of these rows together)."""
    names = list(dict.fromkeys([*key, "source", "size"]))
    targets = measured(source_targets(sized))
    units = sized.groupBy(*names).agg(F.count("*").alias("n"))
    units = join_null_safe(units, targets, ["source"])
    ratio = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST_COPIES)))
    ).otherwise(1.0)
    mean = ratio * F.col("n")
    whole = F.floor(mean + 1e-9)
    groups = F.ceil(F.col("rows") / GROUP_ROWS).cast("long")
    units = units.select(
        *names,
        "source_size",
        "target",
        "n",
        whole.cast("long").alias("_whole"),
        F.greatest(mean - whole, F.lit(0.0)).alias("chance"),
        groups.alias("_groups"),
        F.xxhash64(*names).alias("_a"),
        F.xxhash64(F.lit(SEED), *names).alias("_b"),
    ).withColumn("_group", F.pmod("_a", F.col("_groups")))
    decided = _split(units)
    copies = F.col("_whole") + F.round("chance").cast("long")
    return decided.select(*names, "source_size", "target", "n", copies.alias("copies"))


def taken_by_row(units: DataFrame) -> DataFrame:
    """One row for each row of a unit, with ``taken`` = words the mix takes of it."""
    each = F.floor(F.col("copies") / F.col("n"))
    more = F.col("copies") - each * F.col("n")
    rows = units.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    copies = each + F.when(F.col("_k") <= more, 1).otherwise(0)
    return rows.withColumn("taken", (copies * F.col("size")).cast("long")).drop("_k", "copies", "n")


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size``: words of the text, 0 for null."""
    return docs.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))


def mix(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: whole rows of ``docs``, each as often as it is taken, in its own columns."""
    from shardloom.llm.rows import repeat_rows, row_keys

    keyed = row_keys(docs)
    sized = sizes(keyed, text).select("_k1", "_k2", F.col(source).alias("source"), "size")
    copies = units_of(sized, ["_k1", "_k2"]).select("_k1", "_k2", "n", "copies")
    return repeat_rows(keyed, copies).drop("_k1", "_k2")
