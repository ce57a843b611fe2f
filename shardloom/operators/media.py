"""Decoding to aligned tiles, and augmentation of decoded tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions import arrays, pixels

# Tile sizes (height, width) of the two modalities and the decoding batch.
IRIS_SIZE = (64, 64)
FINGERPRINT_SIZE = (96, 96)
DECODE_BATCH = 32

ArrowBatches = Iterator[pa.RecordBatch]


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, batch_size: int
) -> DataFrame:
    """Apply ``fn`` to Arrow batches of at most ``batch_size`` rows inside the tasks.

    Select the needed columns first; Catalyst cannot prune below this.
    """

    def run(batches: ArrowBatches) -> ArrowBatches:
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                yield fn(batch.slice(start, batch_size))

    return df.mapInArrow(run, schema)


def _tiles(column: pa.Array, size: tuple[int, int], modality: str):
    """(float list array, error messages) of one column of encoded images."""
    values, errors = [], []
    for raw in column:
        try:
            values.append(pixels.unit_tile(raw.as_py() or b"", *size))
            errors.append(None)
        except ValueError as error:
            values.append(None)
            errors.append(f"{modality} {error}")
    lengths = [0 if v is None else len(v) for v in values]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    flat = [v for v in values if v is not None]
    data = np.concatenate(flat) if flat else np.zeros(0, np.float32)
    missing = pa.array([v is None for v in values])
    return pa.ListArray.from_arrays(offsets, pa.array(data), mask=missing), errors


def decode_frames(
    frames: DataFrame,
    iris_size: tuple[int, int] = IRIS_SIZE,
    fingerprint_size: tuple[int, int] = FINGERPRINT_SIZE,
    batch_size: int = DECODE_BATCH,
    keep: tuple[str, ...] = ("subject_id", "sample_id", "label"),
) -> DataFrame:
    """(keep columns, iris, fingerprint, error): row-major tiles in [0, 1].

    Filter by split before calling. ``error`` names the modality that is empty or unreadable and is
    null for good rows; see :func:`decoded` and :func:`quarantine`.
    """

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        iris, iris_errors = _tiles(batch["iris_bytes"], iris_size, "iris")
        finger, finger_errors = _tiles(batch["fingerprint_bytes"], fingerprint_size, "fingerprint")
        errors = [a or b for a, b in zip(iris_errors, finger_errors, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*(batch[c] for c in keep), iris, finger, pa.array(errors, pa.string())],
            [*keep, "iris", "fingerprint", "error"],
        )

    needed = frames.select(*keep, "iris_bytes", "fingerprint_bytes")
    kept = [f"{name} {kind}" for name, kind in frames.select(*keep).dtypes]
    schema = ", ".join([*kept, "iris array<float>", "fingerprint array<float>", "error string"])
    return map_batches(needed, decode, schema, batch_size)


def decoded(tiles: DataFrame) -> DataFrame:
    return tiles.filter(F.col("error").isNull()).drop("error")


def quarantine(tiles: DataFrame) -> DataFrame:
    return tiles.filter(F.col("error").isNotNull()).drop("iris", "fingerprint")


def decode_images(images: DataFrame, size: tuple[int, int], batch_size: int = DECODE_BATCH) -> DataFrame:
    """(path, tile, error) from Spark's ``image`` source, which has decoded PNG, JPEG or BMP.

    The source marks an unreadable file by a negative height.
    """

    def shrink(batch: pa.RecordBatch) -> pa.RecordBatch:
        tiles, errors = [], []
        columns = (batch[n].to_pylist() for n in ("height", "width", "nChannels", "data"))
        for height, width, channels, data in zip(*columns, strict=True):
            if height < 0:
                tiles.append(None)
                errors.append("unreadable")
                continue
            stored = np.frombuffer(data, np.uint8).reshape(height, width, channels)
            grey = stored[..., 0] if channels == 1 else pixels.luma(stored[..., [2, 1, 0]])
            tile = pixels.resize(grey, *size).astype(np.float32).ravel() / np.float32(255.0)
            tiles.append(tile)
            errors.append(None)
        return pa.RecordBatch.from_arrays(
            [batch["path"], pa.array(tiles, pa.list_(pa.float32())), pa.array(errors, pa.string())],
            ["path", "tile", "error"],
        )

    needed = images.select(
        F.col("image.origin").alias("path"),
        "image.height",
        "image.width",
        "image.nChannels",
        "image.data",
    )
    return map_batches(needed, shrink, "path string, tile array<float>, error string", batch_size)


def encode_png(df: DataFrame, column: str, width: int, into: str) -> DataFrame:
    """Add ``into``: a grey PNG of a row-major array of 0-255 values, ``width`` pixels wide."""

    @F.pandas_udf("binary")
    def encode(values):
        return values.map(
            lambda v: None if v is None else pixels.write_png(np.asarray(v, np.uint8).reshape(-1, width))
        )

    return df.withColumn(into, encode(F.col(column)))


# --- augmentation: column work only, the same coin for both modalities of a sample ---------------


def _sides(df: DataFrame, sizes: dict[str, tuple[int, int]]):
    for name, (height, width) in sizes.items():
        if name in df.columns:
            yield name, F.lit(height), F.lit(width)


TILE_SIZES = {"iris": IRIS_SIZE, "fingerprint": FINGERPRINT_SIZE}


def standardised(columns=("iris", "fingerprint")) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumns({c: arrays.standardise(F.col(c)) for c in columns})


def random_flip(
    key: str, seed: int, epoch: int = 0, probability: float = arrays.FLIP_PROBABILITY, sizes=None
) -> Callable[[DataFrame], DataFrame]:
    """Mirror all tiles of a sample together when its coin says so."""

    def apply(df: DataFrame) -> DataFrame:
        coin = arrays.flip_coin(F.col(key), seed, epoch, probability)
        return df.withColumns(
            {
                name: F.when(coin, arrays.mirror(F.col(name), h, w)).otherwise(F.col(name))
                for name, h, w in _sides(df, sizes or TILE_SIZES)
            }
        )

    return apply


def random_noise(
    key: str, seed: int, epoch: int = 0, std: float = arrays.NOISE_STD, sizes=None
) -> Callable[[DataFrame], DataFrame]:
    """Add clipped normal noise, drawn separately for every modality."""

    def apply(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                name: arrays.gaussian_noise(
                    F.col(name), F.concat(F.lit(f"{name}/"), F.col(key).cast("string")), seed, epoch, std
                )
                for name, _, _ in _sides(df, sizes or TILE_SIZES)
            }
        )

    return apply


def compose(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    def apply(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return apply
