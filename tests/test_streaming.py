import datetime as dt

from pyspark.sql import functions as F

from cinderline.operators.series import ts_features
from cinderline.streaming.live import refresh_touched, stream_table, windowed_summary

SCHEMA = "pixel_id bigint, ts timestamp, nbr double"
T0 = dt.datetime(2020, 1, 1)


def readings(pixel, values, start=0):
    return [(pixel, T0 + dt.timedelta(days=8 * (start + i)), v) for i, v in enumerate(values)]


def test_touched_pixels_are_recomputed(spark, tmp_path):
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    features = lambda df: ts_features(df, pixel="pixel_id", order=["ts"], time=F.col("ts"), nbr="nbr")
    save = lambda rows: spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(src)

    def go():
        stream = stream_table(spark, src, spark.read.parquet(src).schema)
        refresh_touched(stream, history=lambda: spark.read.parquet(src), key="pixel_id", features=features, path=out, checkpoint=f"{tmp_path}/c").awaitTermination()

    save(readings(1, [0.6, 0.6, 0.6, 0.5, 0.6]) + readings(2, [0.5] * 5))
    go()
    save(readings(1, [0.1, 0.1], start=5))
    go()
    got = sorted((r.batch, r.pixel_id, round(r.max_drop, 6)) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1, -0.1), (0, 2, 0.0), (1, 1, -0.5)]


def test_windows_close_behind_the_watermark(spark, tmp_path):
    src = f"{tmp_path}/src"
    spark.createDataFrame(readings(1, [0.1, 0.3, 0.5]), SCHEMA).write.parquet(src)
    out = windowed_summary(stream_table(spark, src, spark.read.parquet(src).schema), ts="ts", by=["pixel_id"], value="nbr", width="16 days", lateness="1 day")
    q = out.writeStream.format("memory").queryName("summary").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(r.n for r in spark.table("summary").collect()) == 3
