from pyspark.sql import functions as F

from corpusloom.functions.text import resolve_pattern
from corpusloom.operators.pieces import piece_counts
from corpusloom.streaming import counts


def test_stream_counts_equal_batch(spark, tmp_path):
    texts = ["the cat sat", "the dog", None, "", "sat sat"]
    for i, t in enumerate(texts):
        spark.createDataFrame([(t,)], "text string").write.mode("append").parquet(str(tmp_path / "in"))
    stream = counts.stream_table(spark, str(tmp_path / "in"), "text string", files_per_trigger=2)
    q = counts.streaming_piece_counts(stream, resolve_pattern(), "live_pieces", str(tmp_path / "cp"))
    q.awaitTermination(60)
    batch = piece_counts(spark.read.parquet(str(tmp_path / "in")), resolve_pattern())
    assert sorted(map(tuple, spark.table("live_pieces").collect())) == sorted(map(tuple, batch.collect()))


def test_stream_windows(spark, tmp_path):
    rows = spark.range(100).select((F.lit("2025-01-01").cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("ts"), F.lit("a").alias("event_type"), F.col("id").cast("double").alias("value"), (F.col("id") % 3).alias("user_id"))
    rows.write.parquet(str(tmp_path / "e"))
    stream = counts.windowed_counts(counts.stream_table(spark, str(tmp_path / "e"), rows.schema))
    out = []
    counts.into_batches(stream, lambda df, n: out.extend(df.collect()), str(tmp_path / "cp")).awaitTermination(60)
    batch = {r["window_start"]: (r["n"], r["total"]) for r in counts.windowed_counts(rows).collect()}
    # The last window stays open: nothing later has arrived.
    assert out and all(batch[r["window_start"]] == (r["n"], r["total"]) for r in out)
    assert counts.sessions(rows).count() == 3
