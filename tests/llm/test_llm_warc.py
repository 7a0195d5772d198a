import hashlib

import zstandard
from llm_cases import SF, on_tables
from pyspark.sql import functions as F

from keyflow.llm import files
from keyflow.llm import warc as W
from keyflow.llm.common import shared_folder


def want(pages):
    """Types by payload; of rows with one id and payload the first is the response."""
    rows = [(i, (h or "").encode()) for i, h in pages]
    first, seen, out = {}, set(), []
    for i, b in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if len(b) >= W.MIN_REVISIT:
            first.setdefault(b, i)
    for i, b in rows:
        original = len(b) < W.MIN_REVISIT or (first[b] == i and b not in seen)
        if original:
            seen.add(b)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if original else "revisit",
                    None if original else first[b]))
    return sorted(out, key=repr)


def check(spark, folder):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert sorted(map(tuple, W.op5_warc_bundles(spark, folder).collect()), key=repr) == want(pages)


def test_query_against_brute_force(spark):
    check(spark, SF)


def test_odd_pages(spark, tmp_path):
    big = "<p>é" * 200
    rows = [(1, "u", None, 1), (2, None, "", 1), (3, "a\r\nWARC-Type: x", big, 1), (4, "u", big, 1), (4, "u", big, 1),
            (None, "u", big, 1), (5, "u", "x" * 99, 1), (6, "u", "x" * 99, 1), (7, "u", "y" * 100, 1), (8, "u", "y" * 100, 1),
            (9, "u", "WARC/1.1\r\n\r\n" * 30, 1), (10, "u", "long" * 400_000, 1), (None, None, None, 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, number int")
    check(spark, on_tables(spark, tmp_path / "a", pages=df))
    check(spark, on_tables(spark, tmp_path / "b", pages=df.limit(0)))


def test_frames_stand_alone_and_bundles_are_plain_zstandard(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    folder = shared_folder(spark, "warc-test")
    catalogue = W.write_bundles(W.records_of(pages), folder, frame_bytes=20_000, bundle_bytes=15_000)
    rows = catalogue.collect()
    assert len(rows) > 5 and len({r.bundle for r in rows}) > 1
    name = rows[0].bundle
    with files.open_file(folder, name) as f:
        raw = f.read()
        f.seek(0)
        frames = [W.Bundle(f).frame(r.frame) for r in rows if r.bundle == name]
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole == b"".join(frames)
    # random access to a few records, payloads included
    ids = spark.createDataFrame([(3,), (17,), (40,)], "page_id bigint")
    part = W.find_records(catalogue, ids)
    got = {r.page_id: bytes(r.payload).decode() for r in W.read_records(part, folder, with_payload=True).collect()}
    assert got == {r.page_id: r.html for r in pages.where(F.col("page_id").isin(3, 17, 40)).collect()}


def test_a_damaged_payload_is_noticed():
    raw = W.build_record(1, 2, "u", "response", None, None, 3, hashlib.sha256(b"abc").hexdigest(), b"abc")
    assert W.parse_record(raw)["payload"] == b"abc"
    try:
        W.parse_record(raw.replace(b"abc\r\n", b"abd\r\n"))
    except ValueError:
        return
    raise AssertionError("not noticed")


def test_records_are_found_in_another_session(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    folder = shared_folder(spark, "warc-test")
    W.write_bundles(W.records_of(pages), folder, frame_bytes=20_000)
    other = spark.newSession()
    part = W.find_records(W.open_bundles(other, folder), other.createDataFrame([(17,)], "page_id bigint"))
    got = W.read_records(part, folder, with_payload=True).collect()
    assert [(r.page_id, bytes(r.payload).decode()) for r in got] == [(17, pages.where("page_id = 17").first().html)]
