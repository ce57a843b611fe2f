"""How operators reach whole texts: column-adding passes, stored results, sums over blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.text import PIECE_BYTES, pieces
from shardloom.session import new_folder

TEXT = "_text"


def stored(df: DataFrame, purpose: str = "llm") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: nothing is computed twice, and
    lost executors lose nothing."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_columns(
    docs: DataFrame,
    text: str,
    make: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]],
    fields: str,
    keep: Sequence[str] | None = None,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """One pass over whole texts. ``make()`` gives, once a task, a function from a string array to
    arrays of the new ``fields``. ``keep`` names the input columns that stay (all by default); an
    input column with the name of a new one gives way to it."""
    added = docs.sparkSession.createDataFrame([], fields).schema
    names = [c for c in (docs.columns if keep is None else keep) if c not in added.names]
    source = docs.select(*[F.col(c) for c in names], F.col(text).cast("string").alias(TEXT))
    schema = T.StructType([source.schema[c] for c in names] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in pieces(batch, TEXT, piece_bytes):
                kept = [piece.column(c) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *work(piece.column(TEXT))], [*names, *added.names]
                )

    return source.mapInArrow(run, schema)


# --- arrays that many tasks add up, cut into blocks ----------------------------------------------------

BLOCKS = "block long, payload binary"
_CODEC = "zstd"


def squeeze(array: np.ndarray) -> bytes:
    """An array's bytes, compressed, with their length in front."""
    data = np.ascontiguousarray(array).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec=_CODEC, asbytes=True)


def unsqueeze(payload: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(payload[:8], "little")
    return np.frombuffer(pa.decompress(payload[8:], size, codec=_CODEC, asbytes=True), dtype)


def as_blocks(array: np.ndarray, width: int, first: int = 0) -> Iterator[pa.RecordBatch]:
    """Non-zero blocks of ``width`` cells of a flat array."""
    numbers, payloads = [], []
    for k in range(len(array) // width):
        block = array[k * width : (k + 1) * width]
        if block.any():
            numbers.append(first + k)
            payloads.append(squeeze(block))
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int64()), pa.array(payloads, pa.binary())], ["block", "payload"]
    )


def merged(parts: DataFrame, dtype: str, combine: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Combine the blocks of all tasks, two at a time. A task streams through the payloads of its
    blocks and holds one block, however many payloads there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([squeeze(total)], pa.binary())],
                ["block", "payload"],
            )

        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cells = unsqueeze(payload, dtype)
                if block != at:
                    if at is not None:
                        yield done()
                    at, total = block, cells.copy()
                else:
                    total = combine(total, cells)
        if at is not None:
            yield done()

    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(run, BLOCKS)


def gathered(blocks: DataFrame, dtype: str, width: int, n_blocks: int) -> np.ndarray:
    """The whole array on the driver: ``width * n_blocks`` cells, whatever the size of the input."""
    whole = np.zeros((n_blocks, width), dtype)
    for row in blocks.toLocalIterator():
        whole[row["block"]] = unsqueeze(bytes(row["payload"]), dtype)
    return whole.reshape(-1)


# --- rows of packed arrays, dealt out by bucket -----------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Several arrays as one compressed payload."""
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    head = np.array([len(p) for p in parts], "<i8").tobytes()
    return squeeze(np.frombuffer(head + b"".join(parts), np.uint8))


def unpack(payload: bytes, *dtypes) -> list[np.ndarray]:
    data = unsqueeze(payload, np.uint8).tobytes()
    sizes = np.frombuffer(data, "<i8", len(dtypes)).tolist()
    at, out = 8 * len(dtypes), []
    for size, dtype in zip(sizes, dtypes):
        out.append(np.frombuffer(data[at : at + size], dtype))
        at += size
    return out


def by_bucket(
    parts: DataFrame,
    work: Callable[[int, list[bytes]], Iterator[pa.RecordBatch]],
    schema: str,
    through: Sequence[str] = (),
) -> DataFrame:
    """Hand all payloads of a bucket to ``work`` at once. Rows without a payload pass by, with their
    ``through`` columns; give them buckets of their own, spread evenly. Choose the number of buckets by the size of the input, so that each fits a task."""
    names = list(through)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            payload = batch.column("payload")
            passing = batch.filter(payload.is_null()).select(names)
            if passing.num_rows:
                yield passing
            own = batch.filter(payload.is_valid())
            for bucket, data in zip(own.column("bucket").to_pylist(), own.column("payload").to_pylist()):
                if bucket != at and held:
                    yield from work(at, held)
                    held = []
                at = bucket
                held.append(data)
        if held:
            yield from work(at, held)

    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)
