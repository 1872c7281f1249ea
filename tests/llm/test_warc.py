import gzip
import hashlib
import os
import random
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, size string"


def pages():
    draw = random.Random(3)
    large = "".join(draw.choice("abcdefghij <>/é") for _ in range(5000))
    found = [(i, f"http://a/{i}", "".join(draw.choice("abc <p>") for _ in range(draw.randint(0, 3000)))) for i in range(40)]
    found += [(100 + i, "http://copy/", large) for i in range(9)]  # copies
    found += [(200, None, None), (201, "http://e/\r\nX: 1", ""), (202, "http://s", "short"), (203, "http://s", "short")]
    found += [(204, "u", "x" * 999), (205, "u", "x" * 999), (206, "u", "y" * 1000), (207, "u", "y" * 1000), (None, "n", large)]
    found += [found[0], (300, "long", large * 200), (300, "long", large * 200)]  # repeated rows and a very long one
    return [(*row, "d", "s") for row in found]


def expected(rows):
    kept = {}
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and page is not None:
            kept[body] = max(kept.get(body, page), page)
    out = Counter()
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        keeper = kept.get(body) if page is not None else None
        revisit = keeper is not None and keeper != page
        out[page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None] += 1
    return out


def digest(df):
    body = F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("payload_digest"))
    got = df.select(F.expr("try_cast(record_id AS bigint)").alias("p"), "payload_bytes", body.alias("d"), "record_type", F.col("refers_to").cast("long")).collect()
    return Counter(tuple(r) for r in got)


def test_round_trip_at_any_split(spark):
    table = spark.createDataFrame(pages(), SCHEMA)
    for split in (700, 100_000, 1 << 30):
        assert digest(warc.round_trip(table, 1000, split)) == expected(pages())


def test_archives_are_plain_gzip(spark, tmp_path):
    rows = warc.with_revisits(spark.createDataFrame(pages(), SCHEMA).repartition(3))
    manifest = warc.write_archives(rows, str(tmp_path / "w"), file_bytes=4000).collect()
    assert sum(r.records for r in manifest) == len(pages()) and len(manifest) > 3
    seen = 0
    for r in manifest:
        assert os.path.getsize(r.file) == r.bytes
        with gzip.open(r.file) as file:
            seen += file.read().count(b"WARC/1.1\r\nWARC-Type")
    assert seen == len(pages())


def test_files_outside_the_manifest_are_not_read(spark, tmp_path):
    rows = warc.with_revisits(spark.createDataFrame(pages()[:5], SCHEMA))
    manifest = warc.write_archives(rows, str(tmp_path / "w"))
    stray = warc.member(warc.record("response", "999", "u", b"x", hashlib.sha1(b"x").hexdigest(), 1, None), 6)
    (tmp_path / "w" / "000000-lost.warc.gz").write_bytes(stray)
    assert warc.read_archives(manifest).count() == 5


def read(data, step):
    found = []
    for start in range(0, len(data), step):
        with pa.BufferReader(data) as file:
            found += list(warc.read_range(file, len(data), start, min(len(data), start + step)))
    return found


def test_false_members_are_passed_over():
    """Magic bytes without a member, members that are no records, cut ones, and records inside stored bytes."""
    one = warc.record("response", "1", "u", b"a" * 50, "d", 50, None)
    inner = warc.member(warc.record("response", "9", "u", b"no", "d", 2, None), 6)
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    stored = packer.compress(warc.record("response", "2", "u", b"<" + inner + b">", "d", len(inner) + 2, None)) + packer.flush()
    parts = [warc.member(one, 6), gzip.compress(b"not a record"), warc.MAGIC + b"\0" * 20, stored, warc.member(one, 1)[:-9]]
    data = b"junk" + b"".join(parts)
    for step in (1, 7, 64, 1 << 20):
        found = [(at, fields["warc-record-id"]) for at, fields, _ in read(data, step)]
        assert (4 + len(parts[0]) + len(parts[1]) + 23, "<urn:page:2>") in found
        assert all(name != "<urn:page:9>" for _, name in found)


def test_each_record_has_one_owner():
    draw = random.Random(8)
    bodies = [bytes(draw.choices(range(256), k=draw.randint(0, 900))) for _ in range(60)]
    data = b"".join(warc.member(warc.record("response", str(i), "u", b, "d", len(b), None), 1) for i, b in enumerate(bodies))
    for step in (1, 50, 333, 5000, len(data)):
        found = read(data, step)
        assert [f["warc-record-id"] for _, f, _ in found] == [f"<urn:page:{i}>" for i in range(60)]
        assert [block.partition(b"\r\n\r\n")[2] for _, _, block in found] == bodies


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_headers_of_any_length(spark):
    draw = random.Random(8)
    urls = {n: "http://a/" + "".join(draw.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n)) for n in (10, 70_000, 200_000, 3_000_000)}
    table = spark.createDataFrame([(n, u, f"page {n}") for n, u in urls.items()], "page_id long, url string, html string")
    for split in (50_000, 1 << 30):
        assert {int(r.record_id): r.target_uri for r in warc.round_trip(table, split_bytes=split).collect()} == urls


def test_counts_of_the_manifest_are_held(spark, tmp_path):
    table = spark.createDataFrame([(i, "http://a", f"page {i}") for i in range(30)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.with_revisits(table), str(tmp_path))
    assert warc.read_archives(manifest).count() == 30
    with pytest.raises(ValueError, match="the manifest has"):
        warc.read_archives(manifest.withColumn("records", F.col("records") + 1))
