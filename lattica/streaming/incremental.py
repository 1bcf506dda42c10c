"""Incremental and stateful jobs on Structured Streaming.

`merge_stream` consumes record parts once each and lays them over the catalog; the checkpoint remembers what was consumed, so a
restart after a lost driver merges nothing twice. The stateful operators keep a bounded ring per run. `event_windows` is an
extension: event-time windows with a watermark.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lattica.operators.catalog import last_writer, merge_records
from lattica.session import ship
from lattica.sources.catalogs import current_catalog, write_catalog


def merge_stream(spark: SparkSession, parts: str, schema: T.StructType, folder: str, checkpoint: str, key: str = "sha256", max_files: int = 1000, keep: int = 3) -> Any:
    """Lay all new parquet parts under `parts` over the catalog in `folder`, and stop. A later part name wins; the version is
    the batch number, so a batch run again writes the same version; the newest `keep` versions stay."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("__part", F.input_file_name())
        cells = [c for c in batch.columns if c != key]
        newest = rows.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__part"))).alias(c) for c in cells])
        base = current_catalog(batch.sparkSession, folder)
        merged = merge_records(base, {"new": newest}, key) if base is not None else newest
        write_catalog(merged, folder, f"{number:08d}", keep)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True).parquet(parts)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class RollingPercentile(StatefulProcessor):
    """Per run: the q-quantile of the last `size` finite values, once there are that many, not above cap."""

    def __init__(self, size: int, q: float, cap: float | None = None):
        self.size, self.q, self.cap = size, q, cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", "value double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        ring = [x[0] for x in self.ring.get()] if self.ring.exists() else []
        out = []
        for row in pd.concat(rows).sort_values("step").itertuples():
            if np.isfinite(row.value):
                ring = [*ring[-(self.size - 1) :], row.value] if self.size > 1 else [row.value]
                clip = float(np.quantile(ring, self.q)) if len(ring) == self.size else None
                out.append((key[0], row.step, clip if clip is None or self.cap is None else min(clip, self.cap)))
        self.ring.put([(x,) for x in ring])
        yield pd.DataFrame(out, columns=["run", "step", "clip"])

    def close(self) -> None:
        pass


class MovingAverage(StatefulProcessor):
    """Per run: e = rate e + (1 - rate) x."""

    def __init__(self, rate: float):
        self.rate = rate

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "value double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        e = self.last.get()[0] if self.last.exists() else None
        out = []
        for row in pd.concat(rows).sort_values("step").itertuples():
            e = row.value if e is None else e * self.rate + row.value * (1 - self.rate)
            out.append((key[0], row.step, e))
        self.last.update((e,))
        yield pd.DataFrame(out, columns=["run", "step", "ema"])

    def close(self) -> None:
        pass


def rolling_percentile_stream(stream: DataFrame, size: int, q: float, cap: float | None = None) -> DataFrame:
    """stream: (run string, step long, value double)."""
    ship(stream.sparkSession)
    return stream.groupBy("run").transformWithStateInPandas(RollingPercentile(size, q, cap), "run string, step long, clip double", "append", "none")


def moving_average_stream(stream: DataFrame, rate: float) -> DataFrame:
    ship(stream.sparkSession)
    return stream.groupBy("run").transformWithStateInPandas(MovingAverage(rate), "run string, step long, ema double", "append", "none")


def upsert_progress(stream: DataFrame, folder: str, checkpoint: str, key: str = "key", order: str | None = None, keep: int = 3) -> Any:
    """Keep the last whole record of each key as the catalog in `folder`. order: a column that tells which record is the later
    one, such as a time or an offset, in a batch and between batches; without one a later batch wins, and inside a batch a later
    row of the source's partitions."""

    def upsert(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("__place", F.struct(F.lit(1).alias("new"), F.monotonically_increasing_id().alias("i")))
        base = current_catalog(batch.sparkSession, folder)
        if base is not None:
            rows = rows.unionByName(base.withColumn("__place", F.struct(F.lit(0).alias("new"), F.lit(0).cast("long").alias("i"))))
        if order is not None:
            rows = rows.withColumn("__place", F.struct(F.col(order).alias("order"), F.col("__place.new").alias("new"), F.col("__place.i").alias("i")))
        write_catalog(last_writer(rows, key, "__place").drop("__place"), folder, f"{number:08d}", keep)

    query = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _watermarked(events: DataFrame, ts: str, late: str) -> DataFrame:
    """Streams need a watermark, and that a timestamp with a time zone."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late) if events.isStreaming else events


def event_windows(events: DataFrame, ts: str, kind: str, value: str, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(start, kind, n, total) of tumbling or sliding windows; works on batches and streams."""
    rows = _watermarked(events, ts, late)
    return rows.groupBy(F.window(ts, size, slide).alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")


def sessions(events: DataFrame, ts: str, user: str, gap: str, late: str = "10 minutes") -> DataFrame:
    rows = _watermarked(events, ts, late)
    return rows.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count("*").alias("n")).select(user, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")
