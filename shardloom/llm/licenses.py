"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from ancestor directories.

Every line of a text is a possible header; a licence file (by its name) is compared as a whole, too. A
header or licence file has the licence of the template it is closest to, if the cosine reaches the
threshold. A file without a header of its own takes the licence of the nearest directory above it that
holds a licence file. DataFrame functions only.

Weights are term counts times inverse template frequency; a term of no template has the highest weight
and lowers the cosine. A line can only reach the threshold if the terms it shares with a template weigh
enough there; other lines are left out before anything is exploded, and nothing that could match is lost.

Null texts and empty texts have no header; a null path has no directory and inherits nothing. Equal
scores go to the licence first by name, then to the first line. Of several licence files in a directory
the closest counts, ties by name. Repeated rows get equal results; empty tables give empty results.
Result columns replace input columns of their name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.frames import stored

THRESHOLD = 0.6
TERM = "[a-z0-9]+"

# Short licence notices as they stand in file headers.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style 3-clause license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
LICENCE_FILE = r"(?i)^(license|licence|copying|unlicense)([._-].*)?$"


class Space:
    """The templates as unit vectors over their terms."""

    def __init__(self, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD):
        counts = {name: Counter(re.findall(TERM, text.lower())) for name, text in sorted(templates.items())}
        seen = Counter(term for c in counts.values() for term in c)
        self.idf = {term: math.log((1 + len(counts)) / (1 + n)) + 1 for term, n in seen.items()}
        self.unseen = math.log(1 + len(counts)) + 1
        self.threshold = threshold
        self.vectors = {}
        for name, c in counts.items():
            weights = {term: n * self.idf[term] for term, n in c.items()}
            size = math.sqrt(sum(w * w for w in weights.values()))
            self.vectors[name] = {term: w / size for term, w in weights.items()}

    def reachable(self, lower: Column) -> Column:
        """Whether a lower-cased text or one of its lines could reach the threshold: a template's terms
        that occur in it (inside longer words, too) must weigh enough together."""
        terms = F.array(*[F.lit(t) for t in self.idf])
        squares = F.array(
            *[F.map_from_arrays(F.array(*map(F.lit, v)), F.array(*[F.lit(w * w) for w in v.values()])) for v in self.vectors.values()]
        )

        def enough(found: Column) -> Column:
            def weight(of: Column) -> Column:
                return F.aggregate(found, F.lit(0.0), lambda s, t: s + F.coalesce(F.try_element_at(of, t), F.lit(0.0)))

            return F.exists(squares, lambda of: weight(of) >= 0.999 * self.threshold**2)

        # Arrays of one element bind the text and the terms found, so that both are worked out once.
        def found(text: Column) -> Column:
            return F.exists(F.array(F.filter(terms, lambda t: text.contains(t))), enough)

        return F.exists(F.array(lower), found)


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"))


def _closest(units: DataFrame, space: Space, keys: Sequence[str]) -> DataFrame:
    """(keys, licence, cosine) of units (keys, ``_unit``) that reach the threshold with some template."""
    spark = units.sparkSession
    weights = spark.createDataFrame(
        [(t, w, {n: v[t] for n, v in space.vectors.items() if t in v}) for t, w in space.idf.items()],
        "term string, idf double, of map<string, double>",
    )
    terms = (
        units.select(*keys, F.explode(_terms(F.col("_unit"))).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("n"))
        .join(F.broadcast(weights), "term", "left")
        .withColumn("w", F.col("n") * F.coalesce("idf", F.lit(space.unseen)))
    )
    # One pass over a unit's terms: its length, and its product with every template.
    names = list(space.vectors)
    dots = [F.sum(F.col("w") * F.coalesce(F.element_at("of", n), F.lit(0.0))) for n in names]
    summed = terms.groupBy(*keys).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"), *[d.alias(f"d{k}") for k, d in enumerate(dots)]
    )
    scores = F.array(
        *[
            F.struct(F.round(F.col(f"d{k}") / F.col("size"), 6).alias("cosine"), F.lit(n).alias("licence"))
            for k, n in enumerate(names)
        ]
    )
    best = F.reduce(scores, scores[0], lambda a, b: F.when(b["cosine"] > a["cosine"], b).otherwise(a))
    return (
        summed.select(*keys, best.alias("best"))
        .filter(F.col("best.cosine") >= space.threshold)
        .select(*keys, F.col("best.licence").alias("licence"), F.col("best.cosine").alias("cosine"))
    )


def directories(path: Column) -> Column:
    """All directories above a path, the root (an empty string) first, each with its depth."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda n: F.struct(F.concat_ws("/", F.slice(parts, 1, n)).alias("directory"), n.alias("depth")),
    )


def scan(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    keep: Sequence[str] | None = None,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    licence_file: str = LICENCE_FILE,
) -> DataFrame:
    """Add ``licence``, ``cosine``, ``via`` ("header", "directory" or null) and ``licence_directory``."""
    space = Space(templates, threshold)
    added = ("licence", "cosine", "via", "licence_directory")
    names = [c for c in (files.columns if keep is None else keep) if c not in added]
    inside = {c: f"_{k}" for k, c in enumerate(names)}
    whole = F.col(text).cast("string")
    rows = files.select(
        *[F.col(c).alias(i) for c, i in inside.items()],
        F.col(path).cast("string").alias("p"),
        F.xxhash64(F.col(path).cast("string"), whole).alias("h1"),
        F.xxhash64(whole, F.lit(7), F.col(path).cast("string")).alias("h2"),
        whole.alias("t"),
    )
    named = F.coalesce(F.element_at(F.split("p", "/"), -1).rlike(licence_file), F.lit(False))
    could = rows.filter(space.reachable(F.lower("t"))).select("p", "h1", "h2", "t", named.alias("named"))
    lines = could.select("p", "h1", "h2", "named", F.posexplode(F.split("t", "\n")).alias("line", "_unit"))
    units = lines.filter(space.reachable(F.lower("_unit")))
    units = units.select("p", "h1", "h2", "named", F.col("line").cast("long"), "_unit")
    wholes = could.filter("named").select("p", "h1", "h2", "named", F.lit(-1).cast("long").alias("line"), F.col("t").alias("_unit"))
    # Equal files have equal lines, and a line counts once a file. All that follows for a line groups by
    # these keys and more, so this is the only time that lines are shuffled, and their terms never are.
    units = units.union(wholes).groupBy("h1", "h2", "p", "named", "line").agg(F.min("_unit").alias("_unit"))
    found = _closest(units, space, ["h1", "h2", "p", "named", "line"])
    order = F.struct(-F.col("cosine"), F.col("licence"), F.col("line"))
    own = stored(
        found.groupBy("h1", "h2", "p", "named").agg(F.min_by(F.struct("licence", "cosine"), order).alias("own")),
        "licences",
    )
    holder = F.regexp_replace(F.col("p"), "(^|/)[^/]*$", "")
    held = own.filter(F.col("named") & F.col("p").isNotNull()).groupBy(holder.alias("directory")).agg(
        F.min_by(F.col("own"), F.struct(-F.col("own.cosine"), F.col("own.licence"))).alias("above")
    )
    # Every directory meets its ancestors once, whatever the number of its files.
    folders = rows.filter(F.col("p").isNotNull()).select(holder.alias("folder")).distinct()
    climbed = folders.select(
        "folder", F.inline(directories(F.concat(F.col("folder"), F.lit("/"))))
    ).filter((F.col("depth") > 0) | (F.col("directory") == ""))
    nearest = climbed.join(held, "directory").groupBy("folder").agg(
        F.max_by(F.struct("directory", "above"), "depth").alias("near")
    )
    joined = (
        rows.drop("t")
        .withColumn("folder", holder)
        .join(own.drop("p", "named"), ["h1", "h2"], "left")
        .join(nearest, "folder", "left")
    )
    header, near = F.col("own").isNotNull(), F.col("near").isNotNull()
    return joined.select(
        *[F.col(i).alias(c) for c, i in inside.items()],
        F.coalesce("own.licence", "near.above.licence").alias("licence"),
        F.coalesce("own.cosine", "near.above.cosine").alias("cosine"),
        F.when(header, "header").when(near, "directory").alias("via"),
        F.when(~header & near, F.col("near.directory")).alias("licence_directory"),
    )
