"""Encoded tiles derived from the vectors: decoding, quarantine, augmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions import arrays as a
from shardloom.operators import media
from shardloom.session import new_folder
from shardloom.sources.media import read_images, scan_media, write_media
from shardloom.workloads import tables as t

SIDE = 8  # a vector of 64 numbers is an 8 x 8 tile
SEED = 42
SHEET_TILES = 64  # 64 tiles of 64 pixels fill a 64 x 64 picture
SHEET_SIDE = 64
SIZES = {"iris": (SIDE, SIDE), "fingerprint": (SIDE, SIDE)}


def _grey(vector):
    """Numbers in [-1, 1] to 0-255."""
    return F.transform(vector, lambda x: F.floor((x.cast("double") + 1.0) * 127.5).cast("int"))


def _weighted(tile, digits: int = 6):
    """One number that every element and its place takes part in."""
    return F.round(a.total(F.transform(tile, lambda x, i: x.cast("double") * (i + 1))), digits)


def _encoded(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as PNG pairs; the fingerprint is the tile backwards."""
    vectors = t.table(spark, folder, "embeddings").withColumn("_grey", _grey(F.col("embedding")))
    both = media.encode_png(vectors, "_grey", SIDE, "iris_bytes")
    both = media.encode_png(both.withColumn("_back", F.reverse("_grey")), "_back", SIDE, "fingerprint_bytes")
    return both.select(
        F.concat(F.lit("src"), F.col("label").cast("string")).alias("subject_id"),
        F.col("vec_id").cast("string").alias("sample_id"),
        F.col("label").cast("bigint").alias("label"),
        "iris_bytes",
        "fingerprint_bytes",
    )


def decode_align(spark: SparkSession, folder: str) -> DataFrame:
    """Decode both modalities at their native size."""
    tiles = media.decoded(
        media.decode_frames(_encoded(spark, folder), (SIDE, SIDE), (SIDE, SIDE))
    )
    return tiles.select(
        "subject_id", "sample_id", "label",
        _weighted(F.col("iris")).alias("iris_sum"), _weighted(F.col("fingerprint")).alias("fingerprint_sum"),
    )


def decode_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Samples that cannot be decoded. English documents take the picture of their vector, other
    documents bring text where a picture belongs; vectors of class 0 lack a fingerprint."""
    pictures = _encoded(spark, folder).select(
        F.col("sample_id").cast("bigint").alias("doc_id"),
        F.col("iris_bytes").alias("_iris"),
        F.when(F.col("label") > 0, F.col("fingerprint_bytes")).alias("fingerprint_bytes"),
    )
    docs = t.samples(spark, folder, text=True).join(pictures, "doc_id", "left")
    iris = F.when(F.col("lang") == "en", F.col("_iris")).otherwise(F.col("text").cast("binary"))
    frames = docs.select(
        "subject_id", "sample_id", F.lit(0).cast("bigint").alias("label"),
        iris.alias("iris_bytes"), "fingerprint_bytes",
    )
    bad = media.quarantine(media.decode_frames(frames, (SIDE, SIDE), (SIDE, SIDE)))
    return bad.select("subject_id", "sample_id", F.regexp_extract("error", r"^\w+ \w+", 0).alias("reason"))


def _sheets(spark: SparkSession, folder: str) -> str:
    """A media directory: contact sheets of up to 64 tiles per subject and modality."""
    root = new_folder(spark, "media")
    vectors = t.table(spark, folder, "embeddings").select(
        F.concat(F.lit("src"), F.col("label").cast("string")).alias("subject_id"),
        F.floor(F.col("vec_id") / SHEET_TILES).alias("sheet"),
        F.struct("vec_id", _grey(F.col("embedding")).alias("tile")).alias("entry"),
    )
    # At most 64 vectors share a sheet number, so a group is bounded whatever the label.
    tiles = F.flatten(F.sort_array(F.collect_list("entry"))["tile"])
    blank = F.array_repeat(F.lit(0), SHEET_SIDE * SHEET_SIDE)
    sheets = vectors.groupBy("subject_id", "sheet").agg(
        F.slice(F.concat(tiles, blank), 1, SHEET_SIDE * SHEET_SIDE).alias("grey")
    )
    encoded = media.encode_png(sheets, "grey", SHEET_SIDE, "content")
    places = F.array(F.lit("iris/{}/left/"), F.lit("fingerprint/{}/"))
    files = encoded.select("subject_id", "sheet", "content", F.explode(places).alias("place"))
    name = F.concat(
        F.replace("place", F.lit("{}"), F.col("subject_id")),
        F.lit("sheet_"), F.col("sheet").cast("string"), F.lit(".png"),
    )
    write_media(files.select(name.alias("name"), "content"), root)
    return root


def media_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_media(spark, _sheets(spark, folder), content=False)
    return found.select("modality", "subject_id", "stem")


def decode_images(spark: SparkSession, folder: str) -> DataFrame:
    """Decode the media directory with Spark's image source and align it to iris tiles."""
    tiles = media.decode_images(read_images(spark, _sheets(spark, folder)), media.IRIS_SIZE)
    return tiles.select(
        F.regexp_extract("path", r"/((?:iris|fingerprint)/.*)$", 1).alias("name"),
        F.size("tile").alias("pixels"),
        _weighted(F.col("tile"), 3).alias("weighted_sum"),
    )


def _tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as decoded tiles, the second modality backwards."""
    return t.table(spark, folder, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: x.cast("double")).alias("iris"),
        F.reverse(F.transform("embedding", lambda x: x.cast("double"))).alias("fingerprint"),
    )


def _sums(df: DataFrame) -> DataFrame:
    return df.select(
        "vec_id", _weighted(F.col("iris")).alias("iris_sum"), _weighted(F.col("fingerprint")).alias("fingerprint_sum")
    )


def normalize_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return _sums(_tiles(spark, folder).transform(media.standardised()))


def augment_flip(spark: SparkSession, folder: str) -> DataFrame:
    return _sums(_tiles(spark, folder).transform(media.random_flip("vec_id", SEED, sizes=SIZES)))


def augment_noise(spark: SparkSession, folder: str) -> DataFrame:
    return _sums(_tiles(spark, folder).transform(media.random_noise("vec_id", SEED, sizes=SIZES)))


def augment_compose(spark: SparkSession, folder: str) -> DataFrame:
    """Flip, then noise, for the second epoch."""
    both = media.compose(
        media.random_flip("vec_id", SEED, 1, sizes=SIZES), media.random_noise("vec_id", SEED, 1, sizes=SIZES)
    )
    return _sums(_tiles(spark, folder).transform(both))


QUERIES = {
    fn.__name__: fn
    for fn in (
        decode_align, decode_quarantine, media_scan, decode_images, normalize_tiles, augment_flip,
        augment_noise, augment_compose,
    )
}

# --- SQL ---------------------------------------------------------------------------------------------

_WEIGHTED_SQL = "round(list_sum(list_transform({tile}, lambda x, i: CAST(x AS DOUBLE) * i)), 6)"
_UNIT_SQL = (
    "list_transform(embedding, lambda x: CAST(CAST(floor((CAST(x AS DOUBLE) + 1.0) * 127.5) AS FLOAT)"
    " / CAST(255 AS FLOAT) AS FLOAT))"
)
_TILES_SQL = """
tiles AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS iris,
         list_reverse(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS fingerprint
  FROM embeddings
)"""
_SUMS_SQL = (
    f" SELECT vec_id, {_WEIGHTED_SQL.format(tile='iris')} AS iris_sum,"
    f" {_WEIGHTED_SQL.format(tile='fingerprint')} AS fingerprint_sum FROM {{source}}"
)


def _word_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _flip_sql(source: str, epoch: int) -> str:
    mirrored = "list_transform({c}, lambda x, i: {c}[((i - 1) // 8) * 8 + 8 - (i - 1) % 8])"
    coin = _word_sql(f"'42:{epoch}:flip:' || vec_id") + " / 4294967296.0::DOUBLE < 0.5::DOUBLE"
    columns = ", ".join(
        f"CASE WHEN {coin} THEN {mirrored.format(c=c)} ELSE {c} END AS {c}" for c in ("iris", "fingerprint")
    )
    return f"\nflipped AS (SELECT vec_id, {columns} FROM {source})"


def _noise_sql(source: str, epoch: int) -> str:
    p = a._PRIME

    def residue(index: str) -> str:
        start = f"((base + ({index} + 1) * 1000003) % {p})"
        second = f"(({start} * {start} + {start} * 7 + base) % {p})"
        return f"(({second} * {second} + {second} * 13 + {index}) % {p})"

    branches = []
    for name in ("iris", "fingerprint"):
        word = _word_sql(f"'42:{epoch}:noise:{name}/' || vec_id")
        branches.append(
            f"SELECT vec_id, '{name}' AS modality, unnest({name}) AS x,"
            f" CAST(unnest(range(len({name}))) AS BIGINT) AS i, {word} AS base FROM {source}"
        )
    u1 = f"(({residue('(i * 2)')} + 1.0::DOUBLE) / {p + 1}.0::DOUBLE)"
    u2 = f"(({residue('(i * 2 + 1)')} + 1.0::DOUBLE) / {p + 1}.0::DOUBLE)"
    noisy = (
        f"greatest(-3.0::DOUBLE, least(3.0::DOUBLE, x + sqrt(ln({u1}) * -2.0::DOUBLE)"
        f" * cos({u2} * 6.283185307179586::DOUBLE) * 0.02::DOUBLE))"
    )
    return f"""
elements AS ({" UNION ALL ".join(branches)}),
noisy AS (
  SELECT vec_id, round(sum({noisy} * (i + 1)) FILTER (modality = 'iris'), 6) AS iris_sum,
         round(sum({noisy} * (i + 1)) FILTER (modality = 'fingerprint'), 6) AS fingerprint_sum
  FROM elements GROUP BY vec_id
)"""


_NOISY = " SELECT vec_id, iris_sum, fingerprint_sum FROM noisy"

SQL = {
    "decode_align": f"""
WITH pictures AS (SELECT *, {_UNIT_SQL} AS tile FROM embeddings)
SELECT 'src' || label AS subject_id, CAST(vec_id AS VARCHAR) AS sample_id, CAST(label AS BIGINT) AS label,
       {_WEIGHTED_SQL.format(tile="tile")} AS iris_sum,
       {_WEIGHTED_SQL.format(tile="list_reverse(tile)")} AS fingerprint_sum
FROM pictures""",
    "decode_quarantine": t.with_ctes(
        t.SAMPLES_SQL,
        """
judged AS (
  SELECT subject_id, sample_id,
         CASE WHEN lang <> 'en' THEN 'iris unreadable'
              WHEN vec_id IS NULL THEN 'iris empty'
              WHEN label = 0 THEN 'fingerprint empty' END AS reason
  FROM samples LEFT JOIN embeddings ON vec_id = doc_id
)""",
        body=" SELECT subject_id, sample_id, reason FROM judged WHERE reason IS NOT NULL",
    ),
    "media_scan": f"""
SELECT DISTINCT modality, 'src' || label AS subject_id, 'sheet_' || vec_id // {SHEET_TILES} AS stem
FROM embeddings, (VALUES ('iris'), ('fingerprint')) AS v(modality)""",
    "decode_images": f"""
WITH placed AS (
  SELECT 'src' || label AS subject_id, vec_id // {SHEET_TILES} AS sheet, {_UNIT_SQL} AS tile,
         row_number() OVER (PARTITION BY label, vec_id // {SHEET_TILES} ORDER BY vec_id) - 1 AS place
  FROM embeddings
),
elements AS (
  SELECT subject_id, sheet, unnest(tile) AS x, place * 64 + unnest(range(1, 65)) AS weight FROM placed
),
sheets AS (
  SELECT subject_id, sheet, round(sum(CAST(x AS DOUBLE) * weight), 3) AS weighted_sum
  FROM elements GROUP BY subject_id, sheet
)
SELECT replace(folder, '#', subject_id) || 'sheet_' || sheet || '.png' AS name,
       CAST({SHEET_SIDE * SHEET_SIDE} AS INTEGER) AS pixels, weighted_sum
FROM sheets, (VALUES ('iris/#/left/'), ('fingerprint/#/')) AS v(folder)""",
    "normalize_tiles": t.with_ctes(
        _TILES_SQL,
        """
scaled AS (
  SELECT vec_id, list_transform(iris, lambda x: (x - 0.5::DOUBLE) / 0.5::DOUBLE) AS iris,
         list_transform(fingerprint, lambda x: (x - 0.5::DOUBLE) / 0.5::DOUBLE) AS fingerprint
  FROM tiles
)""",
        body=_SUMS_SQL.format(source="scaled"),
    ),
    "augment_flip": t.with_ctes(_TILES_SQL, _flip_sql("tiles", 0), body=_SUMS_SQL.format(source="flipped")),
    "augment_noise": t.with_ctes(_TILES_SQL, _noise_sql("tiles", 0), body=_NOISY),
    "augment_compose": t.with_ctes(
        _TILES_SQL, _flip_sql("tiles", 1), _noise_sql("flipped", 1), body=_NOISY
    ),
}
