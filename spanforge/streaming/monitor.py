"""Streams: metric rows watched as they arrive, and detection shards that trigger reconciling of their chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "run string, epoch long, best double, bad_rounds long, stop boolean"


def early_stop_stream(metrics: DataFrame, patience: int) -> DataFrame:
    """Per run: the running best and rounds without improvement of ``(run, epoch, val_loss)``, kept in state.

    Epochs of one batch are taken in order; null losses are skipped.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, bad = state.get if state.exists else (float("inf"), 0)
        rows = []
        for epoch, loss in pd.concat(list(frames)).dropna(subset=["val_loss"]).sort_values("epoch")[["epoch", "val_loss"]].itertuples(index=False):
            best, bad = (loss, 0) if loss < best else (best, bad + 1)
            rows.append((key[0], epoch, best, bad, bad >= patience))
        state.update((best, bad))
        yield pd.DataFrame(rows, columns=["run", "epoch", "best", "bad_rounds", "stop"])

    return metrics.groupBy("run").applyInPandasWithState(step, OUT, "best double, bad long", "append", GroupStateTimeout.NoTimeout)


def windowed_rates(events: DataFrame, time: str = "ts", delay: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Counts per event-time window and type, with late rows beyond the watermark dropped."""
    return events.withWatermark(time, delay).groupBy(F.window(time, window), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def on_shards(shards: DataFrame, checkpoint: str, reconcile: Callable[[DataFrame, list[int]], None], chunk: Callable[[DataFrame], DataFrame]):
    """Start a query that, for each batch of arriving shards, calls ``reconcile(batch, touched chunk ids)``."""

    def batch(df: DataFrame, _: int) -> None:
        touched = [r[0] for r in chunk(df).select("chunk_id").distinct().collect()]  # bounded by the chunk grid
        if touched:
            reconcile(df, touched)

    return shards.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
