"""Rejected records, published tables and checksums, and first rows of a stream."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import settings
from ledgerflow.functions.checksums import checksums
from ledgerflow.plans import pipeline
from ledgerflow.sources import published, rejects
from ledgerflow.streaming import first
from ledgerflow.streaming import live as s

PEOPLE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("paid", settings.MONEY)])


# ---- rejects


def test_csv_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("name,extra,id,paid\nAda,x,1,2.50\nBob,y,two,1.00\nCy,z\n\nDi,,3,\n")
    (tmp_path / "in" / "b.csv").write_text('name,extra,id,paid\nEd,x,4,1,5\n"Fay, F",q,5,7.25\n')
    found = rejects.ingest(spark, str(tmp_path / "in"), PEOPLE, str(tmp_path / "out"), "csv")
    assert found.good.schema == PEOPLE
    assert sorted(tuple(map(str, r)) for r in found.good.collect()) == [("1", "Ada", "2.50"), ("3", "Di", "None"), ("5", "Fay, F", "7.25")]
    bad = sorted((r.source.rsplit("/", 1)[1], r.raw) for r in found.rejected.collect())
    assert bad == [("a.csv", "Bob,y,two,1.00"), ("a.csv", "Cy,z"), ("b.csv", "Ed,x,4,1,5")]
    counts = {r.source.rsplit("/", 1)[1]: (r.read, r.good, r.rejected) for r in found.counts().collect()}
    assert counts == {"a.csv": (4, 2, 2), "b.csv": (2, 1, 1)}


def test_columns_of_any_name_can_be_rejected(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("raw", "source", "rejected", "_raw")])
    (tmp_path / "a.json").write_text('{"raw": 1, "source": 2, "rejected": 3, "_raw": 4}\n{"raw": "x"}\n[]\n')
    found = rejects.ingest(spark, str(tmp_path / "a.json"), schema, str(tmp_path / "out"))
    assert [tuple(r) for r in found.good.collect()] == [(1, 2, 3, 4)]
    assert '{"raw": "x"}' in [r.raw for r in found.rejected.collect()]


def test_payloads_that_do_not_fit(spark):
    good = b'{"id": 1, "name": "\xc3\xa9", "paid": 2.5}'
    values = [good, b"{bad", b"", b"  ", None, b'{"id": "x"}', b'{"id": 2, "name": "\xff"}', b"{}", b'{"id": 3, "more": 1}', b"null", b"[1]"]
    frame = spark.createDataFrame([(v, 7) for v in values], "value binary, record int")
    found = rejects.payloads(frame, PEOPLE, source=F.lit("topic/0/1"))
    rows = found.collect()
    assert len(rows) == len(values) and {r.source for r in rows} == {"topic/0/1"}
    assert sorted(r.id for r in rows if not r.rejected and r.id) == [1, 3]
    assert {bytes(r.raw) for r in rows if r.rejected and r.raw is not None} >= {b"{bad", b"", b"  ", b'{"id": "x"}', b'{"id": 2, "name": "\xff"}', b"null"}
    assert all((r.raw is None) == (not r.rejected) or r.raw is None for r in rows)


def test_a_stream_of_lines_is_split_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def lines():
        return rejects.lines(spark, str(source), PEOPLE, stream=True, files_per_trigger=1)

    for n in range(3):
        (source / f"{n}.json").write_text(f'{{"id": {n}}}\n{{"id": {n}\n')
    for n in (3, 4):  # the second run meets one new file
        rejects.start(lines(), out, str(tmp_path / "progress"), trigger=None).awaitTermination()
        found = rejects.load(spark, out, lines().schema)
        assert sorted(r.id for r in found.good.collect()) == list(range(n))
        assert sorted(r.raw for r in found.rejected.collect()) == [f'{{"id": {k}' for k in range(n)]
        (source / f"{n}.json").write_text(f'{{"id": {n}}}\n{{"id": {n}\n')


# ---- checksums


@pytest.mark.parametrize("portable", [False, True])
def test_any_change_of_rows_is_seen(spark, portable):
    draw = random.Random(2)
    rows = [(n, draw.choice(["a", "b", None, "1:a", ""]), draw.choice([None, "x", "n"])) for n in range(50)]
    rows.append(rows[7])

    def taken(some):
        return tuple(checksums(spark.createDataFrame(some, "id long, a string, b string").repartition(3), portable=portable).first())

    own = taken(rows)
    assert taken(rows[::-1]) == own
    changed = [rows[:-1], rows + [rows[3]], rows + [rows[3]] * 2, [(rows[0][0], rows[0][2], rows[0][1]), *rows[1:]] if rows[0][1] != rows[0][2] else rows[1:]]
    changed += [[*rows[:k], (r[0] + 1000, *r[1:]), *rows[k + 1 :]] for k, r in enumerate(rows[:5])]
    assert all(taken(some) != own for some in changed)
    assert taken([]) == (0, 0, 0)
    # Values that look alike when they are put together.
    assert taken([(1, "a,1:b", None)]) != taken([(1, "a", "b")]) and taken([(1, None, "n")]) != taken([(1, "n", None)])


def test_checksums_of_all_kinds(spark):
    one = spark.sql("SELECT 1 AS i, 1.5D AS d, DATE'2024-01-01' AS t, X'00ff' AS x, array(1, null) AS l, map('a', 1) AS m, struct(1 AS p, 'q' AS r) AS s, true AS b")
    assert checksums(one.union(one)).first() != checksums(one).first() and checksums(one, portable=True).first().rows == 1
    assert checksums(one, ["i"]).columns == ["i", "rows", "sum_a", "sum_b"]


# ---- published tables


def orders(spark, n, factor=1):
    i = F.col("id")
    return spark.range(n).select(i, F.when(i % 7 != 0, i % 3).alias("part"), (i * factor).cast("decimal(18,2)").alias("paid"))


def total(df):
    return tuple(df.agg(F.count(F.lit(1)), F.sum("paid")).first())


def test_a_failed_rewrite_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(orders(spark, 90), path, ["part"])
    before = total(published.read(spark, path))
    broken = orders(spark, 90, 2).withColumn("paid", F.when(F.col("id") == 61, F.raise_error(F.lit("stop")).cast("decimal(18,2)")).otherwise(F.col("paid")))
    with pytest.raises(Exception, match="stop"):
        published.publish(broken, path, ["part"])
    assert total(published.read(spark, path)) == before
    assert [m.version for m in published.manifests(spark, path)] == [0]
    assert published.publish(orders(spark, 90, 3), path, ["part"]).version == 1
    assert total(published.read(spark, path))[1] == before[1] * 3


def test_readers_of_an_old_version_are_not_disturbed(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(orders(spark, 50), path)
    reader = published.read(spark, path)  # planned, not read yet
    published.publish(orders(spark, 20, 5), path)
    assert total(reader)[0] == 50 and total(published.read(spark, path))[0] == 20
    assert total(published.read(spark, path, 0))[0] == 50
    with pytest.raises(ValueError, match="was not published"):
        published.read(spark, path, 9)
    with pytest.raises(ValueError, match="nothing is published"):
        published.read(spark, str(tmp_path / "none"))


def test_two_writers_at_a_time(spark, tmp_path):
    """Both finish; readers get one of the two, whole."""
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: published.publish(orders(spark, 40 + k, k), path, ["part"]), range(4)))
    n, paid = total(published.read(spark, path))
    assert n in range(40, 44) and paid == sum(range(n)) * (n - 40)


def test_expiry(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(5):
        published.publish(orders(spark, 10 + k), path, check=False)
    (tmp_path / "t" / "data" / "000000000009-left-behind").mkdir()
    assert published.expire(spark, path, keep=2) == 0  # not old enough
    assert published.expire(spark, path, keep=2, seconds=-5) == 3
    assert [m.version for m in published.manifests(spark, path)] == [3, 4]
    assert sorted(p.name[:12] for p in (tmp_path / "t" / "data").iterdir()) == ["000000000003", "000000000004"]
    with pytest.raises(ValueError, match="version 1 of .* has expired; the newest is 4"):
        published.read(spark, path, 1)
    assert published.publish(orders(spark, 3), path).version == 5


def test_numbered_versions_are_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(orders(spark, 5), path, version=7)
    published.publish(orders(spark, 9), path, version=7)
    published.publish(orders(spark, 9), path, version=3)
    assert total(published.read(spark, path))[0] == 5


@pytest.mark.parametrize("harm", ["lost", "doubled", "changed", "moved"])
def test_one_row_is_enough(spark, tmp_path, harm):
    path = str(tmp_path / "t")
    done = published.publish(orders(spark, 60), path, ["part"])
    assert {r.intact for r in published.verify(spark, path).collect()} == {True}
    folder = f"{path}/data/{done.name}"
    one = spark.read.parquet(f"{folder}/part=1").orderBy("id").limit(1)
    rest = spark.read.parquet(f"{folder}/part=1").join(one.select("id"), "id", "left_anti")
    kept = {"lost": rest, "doubled": rest.union(one).union(one), "changed": rest.union(one.withColumn("paid", F.col("paid") + F.lit(1).cast("decimal(18,2)"))), "moved": rest}[harm]
    rows = kept.select("id", F.col("paid").cast("decimal(18,2)").alias("paid")).collect()
    moved = one.collect()
    spark.createDataFrame(rows, "id long, paid decimal(18,2)").write.mode("overwrite").parquet(f"{folder}/part=1")
    if harm == "moved":
        spark.createDataFrame(moved, "id long, paid decimal(18,2)").write.mode("append").parquet(f"{folder}/part=2")
    broken = {r.part for r in published.verify(spark, path).collect() if not r.intact}
    assert broken == ({1, 2} if harm == "moved" else {1})


def test_empty_and_odd_tables(spark, tmp_path):
    for k, df in enumerate((orders(spark, 0), orders(spark, 1), orders(spark, 3).withColumnRenamed("paid", "a b.c"))):
        path = str(tmp_path / f"t{k}")
        published.publish(df, path, ["part"])
        back = published.read(spark, path)
        assert back.schema.names == df.schema.names and back.count() == df.count()
        assert all(r.intact for r in published.verify(spark, path).collect())


def test_the_batch_run_can_be_repeated(spark, small, tmp_path):
    from ledgerflow.plans.adapter import COPY_ORDER, Star

    star, out = Star(spark, small), str(tmp_path / "run")
    tables = pipeline.run(spark, star.tx_raw, star.accounts_raw, star.customers_raw, out, COPY_ORDER)
    before = tables.full.count()
    with pytest.raises(Exception, match="stop"):
        pipeline.run(spark, star.tx_raw.withColumn("status", F.raise_error(F.lit("stop")).cast("string")), star.accounts_raw, star.customers_raw, out, COPY_ORDER)
    assert pipeline.stored(spark, out).full.count() == before
    again = pipeline.run(spark, star.tx_raw.filter("transaction_id % 2 = 0"), star.accounts_raw, star.customers_raw, out, COPY_ORDER)
    assert 0 < again.full.count() < before and tables.full.count() == before


# ---- streams


def alerts(n, seed=3):
    draw = random.Random(seed)
    return [(k, draw.choice([None, f"2024-01-0{draw.randint(1, 9)} 00:00:00", "2024-01-01 00:00:00.000001"]), f"{draw.random():.2f}") for k in draw.sample(range(10**4), n)]


EVENT = T.StructType([T.StructField("transaction_id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()), T.StructField("amount", settings.MONEY)])


def event_frame(spark, rows):
    return spark.createDataFrame(rows, "transaction_id long, timestamp string, amount string").selectExpr(
        "transaction_id", "CAST(timestamp AS timestamp_ntz) AS timestamp", "CAST(amount AS decimal(18,2)) AS amount"
    )


@pytest.mark.parametrize("files,per_trigger", [(6, 1), (6, 4), (1, 1)])
def test_first_rows_for_any_cut(spark, tmp_path, files, per_trigger):
    rows = alerts(60)
    rows += rows[:2]
    source, sink, progress = (str(tmp_path / n) for n in ("in", "sink", "progress"))
    for part in range(files):
        event_frame(spark, rows[part::files]).coalesce(1).write.mode("append").parquet(source)
    stream = s.stream_events(spark, source, EVENT, "parquet", per_trigger)
    first.start(first.first_rows(stream, 5, buckets=3), sink, progress, trigger=None).awaitTermination()
    got = [tuple(r) for r in first.current(spark, sink, EVENT).orderBy("position").collect()]
    expected = event_frame(spark, rows).orderBy(F.asc_nulls_last("timestamp"), "transaction_id").limit(5).collect()
    assert got == [(*r, n) for n, r in enumerate(map(tuple, expected), 1)]


def test_first_rows_after_a_restart(spark, tmp_path):
    rows = sorted(alerts(40, 8), key=str, reverse=True)
    source, sink, progress = (str(tmp_path / n) for n in ("in", "sink", "progress"))
    seen = []
    for part in range(0, 40, 10):
        event_frame(spark, rows[part : part + 10]).coalesce(1).write.mode("append").parquet(source)
        stream = s.stream_events(spark, source, EVENT, "parquet")
        first.start(first.first_rows(stream, 3, buckets=4), sink, progress, trigger=None, keep=1, seconds=-5).awaitTermination()
        got = [tuple(r)[:3] for r in first.current(spark, sink, EVENT, 3).orderBy("position").collect()]
        expected = event_frame(spark, rows[: part + 10]).orderBy(F.asc_nulls_last("timestamp"), "transaction_id").limit(3).collect()
        assert got == [tuple(r) for r in expected]
        seen.append(got)
    assert seen[0] != seen[-1] and len(published.manifests(spark, sink)) == 1


def test_first_rows_of_nothing(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    event_frame(spark, alerts(3)).limit(0).write.parquet(source)
    stream = s.stream_events(spark, source, EVENT, "parquet")
    first.start(first.first_rows(stream), sink, str(tmp_path / "progress"), trigger=None).awaitTermination()
    assert first.current(spark, sink, EVENT).collect() == []


def test_results_of_many_batches_stay_few(spark, tmp_path):
    """What complete mode publishes for each batch, a thousand times."""
    sink, row = str(tmp_path / "sink"), spark.createDataFrame([(1,)], "n int").coalesce(1)
    reader = None
    for batch in range(20):
        published.publish(row, sink, version=batch, check=False)
        published.expire(spark, sink, 16, -5.0)
        if batch == 1:
            reader = s.current(spark, sink)
    assert s.finished(spark, sink) == list(range(4, 20))
    # Versions that were never written stand for the other batches: a manifest is all that is looked at.
    folder = published.Folder(spark, sink)
    last = json.loads(folder.read(f"manifests/{published.newest(spark, sink).name}"))
    for batch in range(20, 1000):
        name = f"{batch:012d}-x"
        (tmp_path / "sink" / "manifests" / name).write_text(json.dumps({**last, "version": batch, "name": name, "published": time.time()}))
        if batch % 163 == 21:
            published.expire(spark, sink, 16, -5.0)
    assert s.finished(spark, sink) == list(range(984, 1000))
    assert sum(1 for p in tmp_path.rglob("*") if p.is_file()) < 200
    with pytest.raises(Exception, match="(?i)not.?(exist|found)|FileNotFound"):
        reader.collect()
    with pytest.raises(ValueError, match="has expired"):
        s.current(spark, sink, batch=1)
