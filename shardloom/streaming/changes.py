"""Change feed: file events to settled files, continuously."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shardloom.operators.changes import DEBOUNCE, debounce

LATENESS = "10 minutes"


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files arriving below ``path`` as a stream; the limit is the back-pressure."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def settled(
    events: DataFrame,
    gap: str = DEBOUNCE,
    lateness: str = LATENESS,
    time: str = "ts",
    tie: str = "event_id",
) -> DataFrame:
    """Last event of every quiet period per path, emitted once the watermark has passed it.

    ``time`` must be a TIMESTAMP; cast a zone-less one first. Events later than ``lateness`` are not
    announced here: write the raw events with :func:`to_table` too, and let :func:`missed` find them.
    """
    last = F.max_by(F.struct(*events.columns), F.struct(time, tie))
    return (
        events.withWatermark(time, lateness)
        .groupBy("path", F.session_window(time, gap))
        .agg(last.alias("e"))
        .select("e.*")
    )


def missed(
    raw: DataFrame,
    settled_rows: DataFrame,
    gap: str = DEBOUNCE,
    time: str = "ts",
    tie: str = "event_id",
) -> DataFrame:
    """Settled events that the stream has not announced, because they came behind its watermark.

    ``raw`` is the table that ``to_table`` has filled with the events as they came, without a watermark;
    ``settled_rows`` is what the stream has put out, up to the same moment. Run it now and then over
    the period that is closed: late changes reach the log after all."""
    known = settled_rows.select("path", tie)
    return debounce(raw, gap, time, tie).join(known, ["path", tie], "left_anti")


def to_table(
    stream: DataFrame, folder: str, checkpoint: str, once: bool = False, interval: str = "10 seconds"
) -> StreamingQuery:
    """Write every micro-batch to its own sub-folder; a repeated batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def drain(
    stream: DataFrame,
    sentinel_rows: DataFrame,
    sentinel_folder: str,
    folder: str,
    checkpoint: str,
) -> None:
    """Process everything available, then close the windows that still wait for the watermark.

    ``stream`` must read ``sentinel_folder`` besides its real input. All input is consumed first;
    only then are the far-future sentinel rows written and the query resumed, so no real row can
    arrive behind them. For finite replays only: a live feed needs no sentinel.
    """
    to_table(stream, folder, checkpoint, once=True).awaitTermination()
    sentinel_rows.write.mode("append").parquet(sentinel_folder)
    to_table(stream, folder, checkpoint, once=True).awaitTermination()
