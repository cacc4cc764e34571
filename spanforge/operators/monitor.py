"""Analytics over metric series: boundaries, early stop, overfitting, time left, padding; mean IoU and AP at IoU 0.5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def boundary_epochs(series: DataFrame, interval: int, epoch: str = "epoch") -> DataFrame:
    return series.where(F.col(epoch) % interval == 0)


def early_stop(series: DataFrame, interval: int, patience: int, key: list[str] | None = None) -> DataFrame:
    """Boundary rows with a validation loss: running best, consecutive rows without improvement, and ``stop``.

    Strictly lower improves. A run's counter is its row number since the last improvement. ``key``: one series each;
    without it the single short series is one window.
    """
    rows = boundary_epochs(series, interval).where("val_loss is not null")
    w = Window.partitionBy(*(key or [F.lit(0)])).orderBy("epoch")
    before = F.min("val_loss").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("improved", before.isNull() | (F.col("val_loss") < before)).withColumn("best", F.min("val_loss").over(w))
    run = marked.withColumn("_run", F.sum(F.col("improved").cast("int")).over(w))
    since = F.row_number().over(Window.partitionBy(*(key or []), "_run").orderBy("epoch")) - 1
    return run.withColumn("bad_rounds", since).withColumn("stop", F.col("bad_rounds") >= patience).drop("_run")


def overfit_warnings(series: DataFrame, interval: int, window: int, key: list[str] | None = None) -> DataFrame:
    """Boundary rows with ``warn``: over the last ``window`` steps training fell and validation rose at every one."""
    rows = boundary_epochs(series, interval).where("val_loss is not null")
    w = Window.partitionBy(*(key or [F.lit(0)])).orderBy("epoch")
    step = (F.col("train_loss") < F.lag("train_loss").over(w)) & (F.col("val_loss") > F.lag("val_loss").over(w))
    marked = rows.withColumn("_step", F.coalesce(step, F.lit(False)).cast("int"))
    return marked.withColumn("warn", F.sum("_step").over(w.rowsBetween(1 - window, 0)) == window).drop("_step")


def eta_window(steps: DataFrame, total: int, window: int = 1000, key: list[str] | None = None) -> DataFrame:
    """Mean of the last ``window`` durations and the time left, for steps ``(i, dt)`` numbered from 1."""
    if total <= 0:
        raise ValueError("total is positive")
    w = Window.partitionBy(*(key or [F.lit(0)])).orderBy("i").rowsBetween(1 - window, 0)
    return steps.withColumn("mean_dt", F.avg("dt").over(w)).withColumn("eta", F.col("mean_dt") * (total - F.col("i")))


def eta_ema(steps: DataFrame, alpha: float, key: str) -> DataFrame:
    """Exponential mean of the durations of each series, seeded by the first."""
    if not 0 < alpha <= 1:
        raise ValueError("alpha lies in (0, 1]")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "dt"))), lambda x: x["dt"].cast("double"))
    folded = F.aggregate(F.slice("_dts", F.lit(2), F.size("_dts")), F.get("_dts", F.lit(0)), lambda r, dt: (1 - alpha) * r + alpha * dt)
    return steps.groupBy(key).agg(ordered.alias("_dts")).select(key, folded.alias("ema_dt"))


def epoch_eta(series: DataFrame, total: int, span: int = 10) -> DataFrame:
    """Mean wall time per epoch over up to the last ``span`` epochs, and the time left."""
    w = Window.partitionBy(F.lit(0)).orderBy("epoch")
    n = F.least(F.row_number().over(w) - 1, F.lit(span - 1))
    first = F.first("wall_s").over(w.rowsBetween(1 - span, 0))
    mean = F.when(n > 0, (F.col("wall_s") - first) / n)
    return series.withColumn("mean_epoch_s", mean).withColumn("eta_s", mean * (total - F.col("epoch")))


def pad_losses(values: str | Column, n: int, fill_last: bool) -> Column:
    """Exactly ``n`` values: cut, or padded with the last one (0 if none), or with null."""
    v = F.col(values) if isinstance(values, str) else values
    last = F.coalesce(F.element_at(v, -1), F.lit(0.0)) if fill_last else F.lit(None).cast("double")
    last = F.when(F.size(v) > 0, last).otherwise(F.lit(0.0)) if fill_last else last
    return F.slice(F.concat(v, F.array_repeat(last, n)), 1, n)


def mean_iou(pixels: DataFrame) -> DataFrame:
    """Mean over images of foreground intersection over union, from pixels ``(image, t, p)``; empty unions are left out."""
    t, p = F.col("t") > 0, F.col("p") > 0
    per = pixels.groupBy("image").agg(F.count_if(t & p).alias("i"), F.count_if(t | p).alias("u")).where("u > 0")
    return per.agg(F.avg(F.col("i") / F.col("u")).alias("mean_iou"), F.count("*").alias("n_images"))


def average_precision(pixels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per image: instances matched one to one at IoU above the threshold, and TP / (TP + FP + FN).

    Above one half a match is unique on both sides, so counting qualifying pairs is exact; ``threshold`` is not lower.
    """
    if threshold < 0.5:
        raise ValueError("matches are only unique from 0.5 up")
    both = pixels.groupBy("image", "t", "p").agg(F.count("*").alias("n"))
    true = both.where("t > 0").groupBy("image", "t").agg(F.sum("n").alias("nt"))
    pred = both.where("p > 0").groupBy("image", "p").agg(F.sum("n").alias("np"))
    pairs = both.where("t > 0 and p > 0").join(true, ["image", "t"]).join(pred, ["image", "p"])
    tp = pairs.where(F.col("n") > threshold * (F.col("nt") + F.col("np") - F.col("n"))).groupBy("image").agg(F.count("*").alias("tp"))
    counts = true.groupBy("image").agg(F.count("*").alias("n_true")).join(pred.groupBy("image").agg(F.count("*").alias("n_pred")), "image", "full")
    out = counts.join(tp, "image", "left").select("image", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_true", "n_pred", "tp")])
    return out.withColumn("ap", F.col("tp") / (F.col("n_true") + F.col("n_pred") - F.col("tp")))
