"""Binary sources, stores and streams, by round trip."""

import os

import numpy as np

from spanforge.sources import store
from spanforge.sources.gpkg import write_gpkg
from spanforge.sources.las import write_las
from spanforge.sources.raster import register, write_tiff
from spanforge.streaming.monitor import early_stop_stream, on_shards, windowed_rates
from tests.conftest import SF


def test_las_round_trip(spark, tmp_path):
    register(spark)
    rng = np.random.default_rng(0)
    x, y, z = rng.uniform(0, 100, (3, 50))
    write_las(str(tmp_path / "a.las"), x, y, z, np.arange(50) % 3)
    got = spark.read.format("las").option("pointsPerPartition", 20).load(str(tmp_path)).toPandas()
    assert len(got) == 50 and set(got.stem) == {"a"} and np.allclose(sorted(got.x), sorted(x), atol=1e-3) and got.cls.sum() == (np.arange(50) % 3).sum()


def test_gpkg_round_trip_filters(spark, tmp_path):
    register(spark)
    square = lambda a: [[[a, 0.0], [a + 1.0, 0.0], [a + 1.0, 1.0], [a, 0.0]]]
    df = spark.createDataFrame([(square(float(10 * i)), f"n{i}") for i in range(5)], "rings array<array<array<double>>>, name string")
    path = str(tmp_path / "x.gpkg")
    assert write_gpkg(df.coalesce(1), path) == 5
    read = lambda **o: sorted(r.name for r in spark.read.format("gpkg").options(columns="name", featuresPerPartition=2, **o).load(path).collect())
    assert read() == ["n0", "n1", "n2", "n3", "n4"] and read(bbox="9,0,21,1") == ["n1", "n2"] and read(lo=4) == ["n3", "n4"]


def test_tiles_round_trip(spark, tmp_path):
    register(spark)
    image = np.random.default_rng(1).integers(0, 255, (50, 70, 3), dtype=np.uint8)
    write_tiff(str(tmp_path / "x.tif"), image, (0.5, 0, 100, 0, -0.5, 200))
    rows = spark.read.format("tiles").option("window", 40).option("stride", 30).load(str(tmp_path / "x.tif")).collect()
    assert len(rows) == 2 * 2 * 3
    for r in rows:
        assert (np.array(r.px).reshape(r.height, r.width) == image[r.read_y : r.read_y + 40, r.read_x : r.read_x + 40, r.band - 1]).all()
        assert r["transform"][2] == 100 + 0.5 * r.read_x


def test_shards_prune_and_chunks_resume(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "id * 7 % 5000 as x0", "id * 13 % 5000 as y0", "id * 7 % 5000 + 9 as x1", "id * 13 % 5000 + 9 as y1")
    path = str(tmp_path / "shards")
    store.write_shards(df, path, rows=200)
    inside = store.read_shards(spark, path, (0, 0, 500, 500))
    assert inside.count() == df.where("x0 <= 500 and x1 >= 0 and y0 <= 500 and y1 >= 0").count()
    assert "PushedFilters: [IsNotNull" in inside._jdf.queryExecution().toString()
    assert store.shard_index(spark, path).count() >= 10
    chunks = spark.range(4).withColumnRenamed("id", "chunk_id")
    out = str(tmp_path / "chunks")
    assert store.pending_chunks(spark, chunks, out).count() == 4
    store.write_chunks(df.selectExpr("id", "id % 2 as chunk_id"), out)
    assert sorted(r.chunk_id for r in store.pending_chunks(spark, chunks, out).collect()) == [2, 3]


def test_streams(spark, tmp_path):
    spark.createDataFrame([("a", 1, 3.0), ("a", 2, 2.0), ("a", 3, 2.5), ("a", 4, 2.1), ("b", 1, None)], "run string, epoch long, val_loss double").coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("run string, epoch long, val_loss double").parquet(str(tmp_path / "in"))
    q = early_stop_stream(source, 2).writeStream.format("memory").queryName("stops").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.epoch, r.bad_rounds, r.stop) for r in spark.table("stops").orderBy("epoch").collect()] == [(1, 0, False), (2, 0, False), (3, 1, False), (4, 2, True)]
    seen = []
    on_shards(source, str(tmp_path / "c2"), lambda df, ids: seen.append((df.count(), sorted(ids))), lambda df: df.selectExpr("epoch % 2 as chunk_id")).awaitTermination(60)
    assert seen == [(5, [0, 1])]
    os.makedirs(tmp_path / "ev")
    spark.read.parquet(f"{SF}/events.parquet").selectExpr("cast(ts as timestamp) ts", "event_type").write.mode("overwrite").parquet(str(tmp_path / "ev"))
    rates = windowed_rates(spark.readStream.schema("ts timestamp, event_type string").parquet(str(tmp_path / "ev")))
    q = rates.writeStream.format("memory").queryName("rates").outputMode("complete").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("rates").groupBy().sum("n").first()[0] == 1000
