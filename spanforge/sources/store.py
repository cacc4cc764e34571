"""Detection shards, resumable chunk tables, manifests and metric logs on Spark's own readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARD_ROWS = 5_000


def write_shards(features: DataFrame, path: str, cell: int = 1024, rows: int = SHARD_ROWS) -> None:
    """Features range-dealt by grid cell and sorted, so that files' box statistics are narrow and scans prune."""
    placed = features.withColumn("_cy", F.floor(F.col("y0") / cell)).withColumn("_cx", F.floor(F.col("x0") / cell))
    placed.repartitionByRange("_cy", "_cx").sortWithinPartitions("_cy", "_cx").drop("_cx", "_cy").write.option("maxRecordsPerFile", rows).mode("overwrite").parquet(path)


def read_shards(spark: SparkSession, path: str, bbox: tuple | None = None) -> DataFrame:
    """Features that touch the box (closed); the comparisons are pushed down to the scan."""
    df = spark.read.parquet(path)
    if bbox is None:
        return df
    return df.where((F.col("x0") <= bbox[2]) & (F.col("x1") >= bbox[0]) & (F.col("y0") <= bbox[3]) & (F.col("y1") >= bbox[1]))


def shard_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).groupBy(F.input_file_name().alias("shard_path")).agg(F.count("*").alias("n_features"), F.min("x0").alias("minx"), F.min("y0").alias("miny"), F.max("x1").alias("maxx"), F.max("y1").alias("maxy"))


def write_chunks(results: DataFrame, path: str) -> None:
    """One folder per chunk; only the chunks present are overwritten, so an interrupted run can be taken up again."""
    results.repartition("chunk_id").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("chunk_id").parquet(path)


def pending_chunks(spark: SparkSession, chunks: DataFrame, path: str) -> DataFrame:
    """Chunks without a result yet; all of them if there is no table."""
    try:
        done = spark.read.parquet(path).select(F.col("chunk_id").cast("long").alias("chunk_id")).distinct()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return chunks
        raise
    return chunks.join(done, "chunk_id", "left_anti")


def write_training_tiles(tiles: DataFrame, path: str) -> None:
    tiles.write.mode("overwrite").partitionBy("route").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def write_manifest(sources: DataFrame, path: str) -> None:
    """One JSON array with an object for each source; sources are few, being whole rasters."""
    row = F.struct(*[F.col(c) for c in sources.columns])
    sources.agg(F.to_json(F.sort_array(F.collect_list(row))).alias("value")).write.mode("overwrite").text(path)


def training_pairs(files: DataFrame, image: str = "_img.tif", mask: str = "_masks.tif") -> DataFrame:
    """``(stem, image, mask)`` of the files ``name`` that have both; images without a mask are left out."""
    of = lambda ext, name: files.where(F.col("name").endswith(ext)).select(F.expr(f"substr(name, 1, length(name) - {len(ext)})").alias("stem"), F.col("name").alias(name))
    return of(image, "image").join(of(mask, "mask"), "stem")


def metric_fields() -> list:
    """The text of ``epoch, train_loss, val_loss, wall_s``: six decimals, empty for null, one decimal for wall time."""
    number = lambda c: F.when(F.col(c).isNull(), "").otherwise(F.format_string("%.6f", F.col(c)))
    return [F.col("epoch").cast("string").alias("epoch"), number("train_loss").alias("train_loss"), number("val_loss").alias("val_loss"), F.format_string("%.1f", F.col("wall_s").cast("double")).alias("wall_s")]


def append_metrics(series: DataFrame, path: str) -> None:
    """CSV lines of ``metric_fields``."""
    series.select(*metric_fields()).write.mode("append").option("emptyValue", "").csv(path, header=True)
