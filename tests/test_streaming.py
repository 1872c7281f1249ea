from pyspark.sql import functions as F

from ledgerflow import settings
from ledgerflow.operators import aggregates, predicates
from ledgerflow.sources import io
from ledgerflow.streaming import live as s
from tests.test_sources import RECORDS, write_json


def run(spark, stream, tmp_path, name, mode="append"):
    sink = str(tmp_path / name)
    s.start(stream, sink, str(tmp_path / f"{name}-progress"), mode, trigger=None).awaitTermination()
    return s.current(spark, sink, stream.schema) if mode == "complete" else spark.read.schema(stream.schema).parquet(sink)


def same(a, b):
    return sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(b.columns)).collect()))


def test_stream_equals_batch(spark, tmp_path):
    folder = write_json(tmp_path / "in")
    batch = s.flag_stream(io.read_events(spark, folder, settings.EVENTS))
    stream = s.flag_stream(s.stream_events(spark, folder, settings.EVENTS, files_per_trigger=1))
    assert stream.isStreaming
    assert same(run(spark, stream, tmp_path, "all"), batch)
    assert same(run(spark, s.alert_stream(stream), tmp_path, "alerts"), s.alert_stream(batch))
    assert same(run(spark, s.high_amount_stream(stream), tmp_path, "high"), s.high_amount_stream(batch))
    assert same(run(spark, predicates.flagged_list(stream), tmp_path, "list"), predicates.flagged_list(batch))
    assert same(run(spark, s.running_by_type(stream), tmp_path, "types", "complete"), s.running_by_type(batch))
    assert same(run(spark, s.city_rate_stream(stream), tmp_path, "city", "complete"), aggregates.fraud_rate_by_city(batch))
    assert same(run(spark, s.type_volume_stream(stream), tmp_path, "volume", "complete"), aggregates.volume_by_type(batch))
    stats = run(spark, s.running_stats(stream), tmp_path, "stats", "complete").first()
    summary = aggregates.stream_summary(batch).first()
    assert (stats.total, stats.flagged, stats.volume) == (summary.total, summary.flagged, summary.volume) == (3, 2, summary.volume)
    assert summary.flagged_pct == 66.7


def test_restart_reads_only_new_files(spark, tmp_path):
    folder = write_json(tmp_path / "in")
    stream = s.flag_stream(s.stream_events(spark, folder, settings.EVENTS))
    sink, progress = str(tmp_path / "archive"), str(tmp_path / "progress")
    for _ in range(2):
        s.stream_archive(stream, sink, progress, trigger=None).awaitTermination()
    assert spark.read.parquet(sink).count() == len(RECORDS)
    io.read_events(spark, folder, settings.EVENTS).limit(1).withColumn("transaction_id", F.lit("new")).write.mode("append").json(folder)
    s.stream_archive(stream, sink, progress, trigger=None).awaitTermination()
    ids = sorted(r.transaction_id for r in spark.read.parquet(sink).collect())
    assert ids == sorted([r[0] for r in RECORDS] + ["new"])


def test_readers_see_whole_results_only(spark, tmp_path):
    folder = write_json(tmp_path / "in")
    stream = s.running_by_type(s.stream_events(spark, folder, settings.EVENTS))
    sink, progress = str(tmp_path / "types"), str(tmp_path / "progress")
    s.start(stream, sink, progress, "complete", trigger=None).awaitTermination()
    before = sorted(map(tuple, s.current(spark, sink, stream.schema).collect()))
    # A result that was begun and never finished.
    spark.createDataFrame([("half", 1)], "tx_type string, count long").write.parquet(f"{sink}/data/000000000001-begun")
    assert sorted(map(tuple, s.current(spark, sink, stream.schema).collect())) == before
    io.read_events(spark, folder, settings.EVENTS).limit(1).write.mode("append").json(folder)
    s.start(stream, sink, progress, "complete", trigger=None).awaitTermination()
    after = {r.tx_type: r["count"] for r in s.current(spark, sink, stream.schema).collect()}
    assert sum(after.values()) == sum(n for _, n in before) + 1 and "half" not in after
