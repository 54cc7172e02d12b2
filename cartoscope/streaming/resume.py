"""Resumable classification of arriving records.

Each run takes what has arrived since the last (``availableNow``), in bounded
micro-batches, drops repeated keys and appends to a Parquet table. The stream's
checkpoint makes a restarted run go on where the last one stopped; a batch that
was written before a crash is written again under its own batch folder, so
rows are neither lost nor doubled.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import vocabulary as V
from ..operators import search


def run_available(
    spark: SparkSession, source: str, schema, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str | None = None, files: int = 100,
    time: str | None = None, late: str = "7 days",
) -> DataFrame:
    """Process new Parquet files of ``source`` and return all that ``out`` holds.

    Repeats of ``key`` go. With ``time``, an event-time column, keys are forgotten
    ``late`` behind the latest, which bounds the state; without, all are kept.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    if key and time:
        stream = stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    elif key:
        stream = stream.dropDuplicates([key])

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = step(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return spark.read.option("basePath", out).parquet(out)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type and tumbling window; an extra over the catalogue search."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))


def health_stream(events: DataFrame) -> DataFrame:
    """Running worst state of each library, for ``update`` or ``complete`` output."""
    return search.health(events, "library_id", F.col("seq"), F.col("event"), F.col("problem"))


def breaker_stream(log: DataFrame, counted: str = "err", resets: tuple[str, ...] = ("hit", "empty"), limit: int = V.ERROR_LIMIT) -> DataFrame:
    """(source, cut_seq) once for each source, when ``limit`` of ``counted`` come in a row.

    ``log`` streams (source, seq, outcome). The state of a source is how long its
    run is and whether it is cut, whatever the length of the log; an outcome
    that is neither counted nor resets changes nothing. Rows of a batch are
    taken by seq; those that come in a later batch come after.
    """

    def step(key: tuple, frames, state: GroupState):
        run, cut = state.get if state.exists else (0, False)
        rows = pd.concat(list(frames)).sort_values("seq", kind="stable")
        found = None
        for seq, outcome in zip(rows["seq"], rows["outcome"], strict=True):
            run = run + 1 if outcome == counted else 0 if outcome in resets else run
            if outcome == counted and run >= limit and not cut and found is None:
                found = int(seq)
        state.update((run, cut or found is not None))
        yield pd.DataFrame({"source": [key[0]] * (found is not None), "cut_seq": pd.Series([found] * (found is not None), dtype="int64")})

    return log.groupBy("source").applyInPandasWithState(step, "source string, cut_seq long", "run int, cut boolean", "append", GroupStateTimeout.NoTimeout)
