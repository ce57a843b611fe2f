"""Merkle manifest of a table: a leaf digest per row, a subtree per group, one root over all groups,
and for every row the sibling digests that prove it belongs to the root.

The method keeps each level of an aligned block of nodes as one string of concatenated hex digests.
A block holds 8^3 = 512 consecutive nodes of a group; one round settles three levels in it: the digest
of every eight neighbours is the SQL digest of a fixed-width substring (8 x 64 characters), and a
node's siblings at a level are the two substrings that flank it inside its run of eight. Each round's
block roots are the next round's nodes, so the rounds recurse until every group has one node left,
its subroot. Subroots, ordered by group, form one more tree whose last node is the root. Sibling
segments are then handed down: every block meets the segments of its own root once, by a 1:1 join, and
unfolds them to its nodes, where each node's own segments are cut out. Until then a block is stored and
dealt out with every digest once. All work is in SQL expressions; nothing is collected.

Rules (``H``: lowercase hex SHA-256 of the UTF-8 of its inputs concatenated, digests as hex text):

* leaf: ``H`` of the fields, each ``-`` if null, else its UTF-8 byte count, ``:``, its text (integers
  in decimal).
* Within a group (null is a group of its own) leaves ascend by the order column, nulls first; ties
  are broken by leaf digest, so equal rows are interchangeable and give equal results. While more than
  one node remains, every 8 consecutive nodes (the last run fewer, even one) become ``H`` of their
  digests. A group of one leaf has that leaf as its subroot.
* Subroots ascend by group, null first, then bytewise by UTF-8; they give the root likewise.
* proof: the siblings (the other members of the node's run, if any) level by level from the leaf up
  through the subroot to the root, each level left to right, concatenated. A table of one row has an
  empty proof.
* folded root: the fold of a replacement leaf (``altered`` fields) with the original siblings; it equals
  the root exactly when the replacement leaves the leaf as it was.

Empty tables give no rows. Nulls in any column are fields like any other. Very long texts are one
digest each. Input columns keep their values and names; one named like a result column gives way to
it, and internal names cannot clash because the input travels as one nested column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.frames import stored
from shardloom.session import BROADCAST_ROWS

FAN = 8
LEVELS = 3  # levels one round settles inside a block
BLOCK = FAN**LEVELS
HEX = 64

RESULTS = ("leaf", "subroot", "root", "proof", "folded_root", "verified")

_ID_BITS = 33  # monotonically_increasing_id: partition above, row below


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _group_key(group: Column) -> Column:
    """Never null, and ordered as the group: null first, then bytewise."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), group.cast("string")))


def _height(n: Column) -> Column:
    """Levels until one node remains: the least k with 8^k >= n."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(20)),
        F.lit(0),
        lambda acc, k: acc + F.when(F.pow(F.lit(float(FAN)), k) < n, 1).otherwise(0),
    )


def _up(level: Column) -> Column:
    """The next level of a block: every eight digests of ``level`` become the digest of their text."""
    runs = F.floor((F.length(level) / HEX + FAN - 1) / FAN).cast("int")
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0), runs - 1),
            lambda j: F.sha2(level.substr(j * (FAN * HEX) + 1, F.lit(FAN * HEX)), 256),
        ),
        "",
    )


def _numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``_pos`` (0-based within ``_g`` by ``order``) and ``_n`` (rows of ``_g``) without a window over a
    whole group: rows are range-partitioned, numbered inside their partition, and shifted by what
    earlier partitions of the group hold. Stored once, because range bounds are drawn from a sample."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        df.repartitionByRange(parts, F.col("_g"), *order)
        .sortWithinPartitions(F.col("_g"), *order)
        .withColumn("_id", F.monotonically_increasing_id()),
        "merkle",
    )
    ranged = ranged.withColumn("_part", F.shiftright("_id", _ID_BITS)).withColumn(
        "_rank", F.col("_id").bitwiseAND((1 << _ID_BITS) - 1)
    )
    pieces = ranged.groupBy("_part", "_g").agg(F.min("_rank").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("_g")
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = stored(
        pieces.select(
            "_part",
            "_g",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(group).alias("_n"),
        ),
        "merkle",
    )
    # At most (partitions + groups) rows; broadcast only below the row limit.
    if pieces.count() <= BROADCAST_ROWS:
        pieces = F.broadcast(pieces)
    numbered = ranged.join(pieces, ["_part", "_g"])
    return numbered.withColumn("_pos", F.col("_rank") + F.col("_shift")).drop("_part", "_rank", "_shift", "_id")


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Blocks of 8^levels nodes (``_g``, ``_pos``, ``_n``, ``_h``, optional ``_p``): the nodes in order,
    the levels settled here (``_d``), the block's root, and the strings of the levels between
    (``_lines``, level 1 first). A digest is held once; what a node's siblings are is cut out of the
    nodes and the lines by :func:`_unfolded`, because written out it is about 1.3 KB a node."""
    member = ["_pos", "_h"] + (["_p"] if "_p" in nodes.columns else [])
    grouped = nodes.groupBy("_g", F.shiftright("_pos", levels * 3).alias("_b")).agg(
        F.max("_n").alias("_n"),
        F.array_sort(
            F.collect_list(F.struct(*member)),
            lambda a, b: F.when(a["_pos"] < b["_pos"], -1).when(a["_pos"] > b["_pos"], 1).otherwise(0),
        ).alias("_nodes"),
    )
    height = _height(F.col("_n"))
    depth = F.least(F.lit(levels), height)
    level0 = F.array_join(F.transform("_nodes", lambda x: x["_h"]), "")
    grouped = grouped.select("_g", "_b", "_n", "_nodes", height.alias("_height"), depth.alias("_d"), level0.alias("_l0"))
    for k in range(1, levels + 1):
        grouped = grouped.withColumn(f"_l{k}", F.when(F.col("_d") >= k, _up(F.col(f"_l{k - 1}"))))
    every = F.array(*[F.col(f"_l{k}") for k in range(levels + 1)])
    between = F.array(*[F.col(f"_l{k}") for k in range(1, levels)]).cast("array<string>")
    grouped = grouped.withColumn("_root", F.element_at(every, F.col("_d") + 1))
    more = F.col("_height") > F.col("_d")
    return grouped.select("_g", "_b", "_n", "_d", more.alias("_more"), "_root", between.alias("_lines"), "_nodes")


def _segment(line: Column, start: Column, i: Column, end: Column) -> Column:
    """The digests of ``line`` from ``start`` up to ``i``, and those behind ``i`` up to ``end``."""
    return F.struct(
        line.substr(start * HEX + 1, (i - start) * HEX).alias("l"),
        line.substr((i + 1) * HEX + 1, (end - i - 1) * HEX).alias("r"),
    )


def _unfolded(blocks: DataFrame, levels: int) -> DataFrame:
    """Every node of ``blocks`` with its sibling segments (``_s``): those in its block and those of the
    block's root (``_up``). A block goes to its runs of eight first: a run's nodes share all segments
    but the lowest, which is cut out of the run's own 512 characters."""
    runs = F.floor((F.size("_nodes") + FAN - 1) / FAN).cast("int")

    def run(j: Column) -> Column:
        def at(k: Column) -> Column:
            line = F.element_at(F.col("_lines"), k)
            i = F.floor(j / F.pow(F.lit(float(FAN)), k - 1)).cast("int")
            start = F.shiftleft(F.shiftright(i, 3), 3)
            return _segment(line, start, i, F.least(start + FAN, F.floor(F.length(line) / HEX).cast("int")))

        between = F.filter(F.array(*[F.lit(k) for k in range(1, levels)]).cast("array<int>"), lambda k: k < F.col("_d"))
        return F.struct(
            F.slice("_nodes", j * FAN + 1, F.lit(FAN)).alias("_run"),
            F.concat(F.transform(between, at), F.col("_up")).alias("_above"),
        )

    by_run = blocks.select("_g", "_sub", "_top", "_d", F.inline(F.transform(F.sequence(F.lit(0), runs - 1), run)))
    by_run = by_run.withColumn("_line", F.array_join(F.transform("_run", lambda x: x["_h"]), ""))

    def node(x: Column, i: Column) -> Column:
        own = F.array(_segment(F.col("_line"), F.lit(0), i, F.size("_run")))
        # A group of one node has no level of its own.
        segments = F.when(F.col("_d") > 0, F.concat(own, F.col("_above"))).otherwise(F.col("_above"))
        return x.withField("_s", segments)

    return by_run.select("_g", "_sub", "_top", F.inline(F.transform("_run", node)))


def _tree(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of the trees of every ``_g``: the stored blocks of each round, and per group its last
    node (``_g``, ``_h``) with the round it was settled in (``_round``)."""
    rounds, finished = [], []
    r = 0
    while True:
        blocks = stored(_blocks(nodes, levels), "merkle")
        rounds.append(blocks)
        finished.append(blocks.filter(~F.col("_more")).select("_g", F.col("_root").alias("_h"), F.lit(r).alias("_round")))
        nodes = stored(
            blocks.filter("_more").select(
                "_g",
                F.col("_b").alias("_pos"),
                F.shiftright(F.col("_n") + (FAN**levels - 1), levels * 3).alias("_n"),
                F.col("_root").alias("_h"),
            ),
            "merkle",
        )
        if nodes.isEmpty():
            break
        r += 1
    last = finished[0]
    for more in finished[1:]:
        last = last.unionByName(more)
    return rounds, last


def _down(rounds: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Every node of round 0 with all its sibling segments up to the root (``_s``), and the carried
    ``_sub`` and ``_top`` of ``tops`` (``_g``, ``_round``, ``_s``, ``_sub``, ``_top``: segments above
    each group's last node)."""
    above = None
    for r in range(len(rounds) - 1, -1, -1):
        ends = tops.filter(F.col("_round") == r).select("_g", F.lit(0).cast("long").alias("_b"), "_s", "_sub", "_top")
        joined_to = ends if above is None else above.unionByName(ends)
        met = rounds[r].join(joined_to.withColumnRenamed("_s", "_up"), ["_g", "_b"])
        unfolded = _unfolded(met, levels)
        if r == 0:
            return unfolded
        above = stored(unfolded.select("_g", F.col("_pos").alias("_b"), "_s", "_sub", "_top"), "merkle")
    raise ValueError("no rounds")


def build(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    altered: Mapping[str, Column] | None = None,
    keep: Sequence[str] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """The columns of ``keep`` (all by default) with ``leaf``, ``subroot``, ``root``, ``proof`` (the
    sibling digests, concatenated), ``folded_root`` (the root folded from the leaf of ``fields`` where
    ``altered`` replaces some, with the original siblings) and ``verified`` (folded root = root).
    ``levels`` is how many levels a round settles: blocks of 8^levels nodes."""
    names = list(docs.columns if keep is None else keep)
    altered = dict(altered or {})
    values = [docs[f] for f in fields]
    changed = [altered.get(f, docs[f]) for f in fields]
    leaves = docs.select(
        F.struct(*[docs[c].alias(c) for c in names]).alias("_in"),
        _group_key(docs[group]).alias("_g"),
        docs[order].alias("_o"),
        digest(values).alias("_h"),
        digest(changed).alias("_alt"),
    )
    placed = _numbered(leaves, [F.col("_o").asc_nulls_first(), F.col("_h"), F.col("_alt")])
    nodes = placed.select("_g", "_pos", "_n", "_h", F.struct("_in", "_alt").alias("_p"))
    rounds, subroots = _tree(nodes, levels)

    top_nodes = _numbered(subroots.select(F.lit("").alias("_g"), F.col("_g").alias("_o"), "_h", F.col("_round").alias("_alt")), [F.col("_o")])
    top_nodes = top_nodes.select("_g", "_pos", "_n", "_h", F.struct(F.col("_o").alias("_group"), F.col("_alt").alias("_round")).alias("_p"))
    top_rounds, root = _tree(top_nodes, levels)
    empty = F.array().cast("array<struct<l:string,r:string>>")
    top_tops = root.select("_g", "_round", empty.alias("_s"), F.col("_h").alias("_sub"), F.col("_h").alias("_top"))
    groups = _down(top_rounds, top_tops, levels).select(
        F.col("_p._group").alias("_g"), F.col("_p._round").alias("_round"), "_s", F.col("_h").alias("_sub"), F.col("_sub").alias("_top")
    )
    unfolded = _down(rounds, groups, levels)

    fold = F.aggregate("_s", F.col("_p._alt"), lambda cur, s: F.sha2(F.concat(s["l"], cur, s["r"]), 256))
    proof = F.array_join(F.transform("_s", lambda s: F.concat(s["l"], s["r"])), "")
    outputs = [
        F.col("_h").alias("leaf"),
        F.col("_sub").alias("subroot"),
        F.col("_top").alias("root"),
        proof.alias("proof"),
        fold.alias("folded_root"),
        (fold == F.col("_top")).alias("verified"),
    ]
    kept = [F.col("_p._in")[c].alias(c) for c in names if c not in RESULTS]
    return unfolded.select(*kept, *outputs)
