"""Streams: deduplicated appends, event-time windows, step windows and cursors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, key: str, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first row of each key. With an event time, keys older than the delay are forgotten, so state stays bounded."""
    return stream.dropDuplicates([key]) if event_time is None else stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def appended(stream: DataFrame, key: list[str], folder: str, checkpoint: str) -> DataFrame:
    """What a stream holds by now, the first row of each key, appended to a folder and read from it.

    A later call with the same folders goes on where this one ended: neither the rows nor the keys seen are forgotten.
    """
    stream.dropDuplicates(key).writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(folder)


def tallied(stream: DataFrame, by: list[str], value: str, folder: str, checkpoint: str) -> DataFrame:
    """Running counts and sums of a stream by key, kept as state; each batch replaces the table it reports to."""

    def report(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number % 2}")
        batch.sparkSession.createDataFrame([(number % 2,)], "batch int").write.mode("overwrite").json(f"{folder}-last")

    own = stream.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 6).alias("total"))
    own.writeStream.foreachBatch(report).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    spark = stream.sparkSession
    last = spark.read.schema("batch int").json(f"{folder}-last").first()[0]
    return spark.read.schema(own.schema).parquet(f"{folder}/batch={last}")


def resynced(marks: DataFrame, state: DataFrame, run: str, n: int) -> DataFrame:
    """(run, done, epoch, cursor) after a crash: the furthest of the durable state and the marks that were written after it."""
    both = marks.select(run, F.col("done").cast("long").alias("done")).unionByName(state.select(run, F.col("done").cast("long").alias("done")))
    own = both.groupBy(run).agg(F.max("done").alias("done"))
    return own.select(run, "done", F.floor(F.col("done") / n).alias("epoch"), (F.col("done") % n).alias("cursor"))


def counted(stream: DataFrame, event_time: str, size: str, slide: str | None = None, by: str | None = None, value: str | None = None, delay: str | None = None) -> DataFrame:
    """Tumbling windows, or sliding ones, with counts and sums."""
    own = stream.withWatermark(event_time, delay) if delay else stream
    keys = [F.window(event_time, size, slide), *([F.col(by)] if by else [])]
    sums = [F.round(F.sum(value), 6).alias("total")] if value else []
    return own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums).select(F.col("window.start").alias("start"), *([by] if by else []), "n", *(["total"] if value else []))


def sessions(stream: DataFrame, event_time: str, gap: str, by: str, delay: str | None = None) -> DataFrame:
    """Runs of events of a key with no pause as long as the gap."""
    own = stream.withWatermark(event_time, delay) if delay else stream
    return own.groupBy(F.session_window(event_time, gap), by).agg(F.count(F.lit(1)).alias("n")).select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def step_windows(df: DataFrame, run: str, step: str, size: int, value: str) -> DataFrame:
    """Tumbling windows by step number: counts and means that start afresh in each."""
    return df.groupBy(run, F.floor(F.col(step) / size).alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 6).alias("mean"))


def cursors(stream: DataFrame, run: str, n: int) -> DataFrame:
    """(run, done, epoch, cursor) after each batch: how far each run has come over n examples, kept as state."""

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        done = (state.get[0] if state.exists else 0) + sum(len(p) for p in parts)
        state.update((done,))
        yield pd.DataFrame({"run": [key[0]], "done": [done], "epoch": [done // n], "cursor": [done % n]})

    return stream.groupBy(run).applyInPandasWithState(advance, "run long, done long, epoch long, cursor long", "done long", "update", "NoTimeout")
