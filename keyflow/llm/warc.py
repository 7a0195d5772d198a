"""WARC archives as seekable Zstandard bundles.

Pages become WARC records (one response per payload, revisits for its copies).
A task packs its records into frames of about ``FRAME`` bytes that decompress
independently, and frames into bundles that end with a seek table in a skippable
frame (the public seekable format), so plain Zstandard tools read a bundle and
others can jump. The catalogue holds a row per frame: bundle, frame number, and
each record's id, offset in the frame and length.

Which record is the response is decided on digests alone: the smallest page of
each digest is found with map-side combining, and a payload travels once for
each digest, so a payload that a third of all pages share is no hot group.

Defined results: null html is an empty payload; payloads under 100 bytes are
always responses; of repeated rows one is the response and the others revisit
it; a null id sorts last and is read back as null; an empty table gives empty
archives.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm import files
from keyflow.llm.common import checkpointed, load_table, row_id, shared_folder, ship_package, written

FRAME = 1 << 20        # uncompressed bytes
BUNDLE = 64 << 20      # compressed bytes
MIN_REVISIT = 100      # payload bytes
LEVEL = 3
# Fixed values of the seekable format: skippable frame, table footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"
_LINE_BREAKS = re.compile(r"[\r\n\x00]")


def record_id(page_id: int | None, number: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{number}>"


def _page_of(urn: str) -> int | None:
    page = urn.strip("<>").split(":")[2]
    return int(page) if page else None


def build_record(page_id, number, url, kind, refers_page, refers_number, size, digest, payload) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, number)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _LINE_BREAKS.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(refers_page, refers_number)), ("X-Payload-Length", str(size))]
        block = b""
    else:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                 % len(payload)) + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Page, kind, target, and the full payload's size and digest of one record; checks the digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    out = {"page_id": _page_of(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
           "payload_digest": digest, "refers_to": None}
    if fields["WARC-Type"] == "revisit":
        return out | {"refers_to": _page_of(fields["WARC-Refers-To"]), "payload_bytes": int(fields["X-Payload-Length"])}
    payload = block.partition(b"\r\n\r\n")[2]
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of page {out['page_id']} does not have its digest")
    return out | {"payload_bytes": len(payload), "payload": payload}


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (compressed, decompressed) size of each frame, and its footer."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries)) + entries


class Bundle:
    """Random access to the frames of a bundle."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        source.seek(end - 9)
        n, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        source.seek(end - 9 - 8 * n)
        sizes = list(struct.iter_unpack("<II", source.read(8 * n)))
        self.starts, at = [], 0
        for packed, plain in sizes:
            self.starts.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.starts[number]
        self.source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain)


CATALOGUE_FOLDER = "catalogue"
CATALOGUE = ("bundle string, frame int, records array<struct<page_id:bigint, number:bigint, offset:int, length:int>>")
_RECORDS = pa.list_(pa.struct([("page_id", pa.int64()), ("number", pa.int64()), ("offset", pa.int32()),
                               ("length", pa.int32())]))


def records_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The records to write: (number, page_id, url, kind, refers_page, refers_number, size, digest, payload)."""
    body = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    sized = rows.select(row_id().alias("number"), "page_id", "url", F.octet_length("payload").alias("size"),
                        F.sha2("payload", 256).alias("digest"),
                        F.when(F.octet_length("payload") < MIN_REVISIT, F.col("payload")).alias("payload"))
    slim = checkpointed(sized)  # no payload but small ones
    first = (slim.where(F.col("size") >= MIN_REVISIT).groupBy("digest")
             .agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "number")).alias("low"))
             .select("digest", F.col("low.page_id").alias("refers_page"), F.col("low.number").alias("refers_number")))
    names = ["number", "page_id", "url", "kind", "refers_page", "refers_number", "size", "digest", "payload"]
    none = F.lit(None).cast("bigint")
    small = slim.where(F.col("size") < MIN_REVISIT).select(
        "*", F.lit("response").alias("kind"), none.alias("refers_page"), none.alias("refers_number"))
    large = slim.where(F.col("size") >= MIN_REVISIT).drop("payload").join(first, "digest").withColumn(
        "kind", F.when(F.col("number") == F.col("refers_number"), "response").otherwise("revisit"))
    revisits = large.where("kind = 'revisit'").withColumn("payload", F.lit(None).cast("binary"))
    payloads = (rows.where(F.octet_length("payload") >= MIN_REVISIT)
                .select(F.sha2("payload", 256).alias("digest"), "payload").dropDuplicates(["digest"]))
    responses = (large.where("kind = 'response'").withColumn("refers_page", none).withColumn("refers_number", none)
                 .join(payloads, "digest"))
    return responses.select(*names).union(revisits.select(*names)).union(small.select(*names))


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = FRAME, bundle_bytes: int = BUNDLE) -> DataFrame:
    """Write the records as bundles in ``folder``; returns the catalogue, a row per frame, which lies beside them."""
    ship_package(records.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = _BundleWriter(folder, bundle_bytes)
        frame, places = bytearray(), []
        for batch in batches:
            for r in batch.to_pylist():
                raw = build_record(r["page_id"], r["number"], r["url"], r["kind"], r["refers_page"],
                                   r["refers_number"], r["size"], r["digest"], r["payload"] or b"")
                places.append({"page_id": r["page_id"], "number": r["number"], "offset": len(frame), "length": len(raw)})
                frame += raw
                if len(frame) >= frame_bytes:
                    yield from bundle.add(bytes(frame), places)
                    frame, places = bytearray(), []
        if frame:
            yield from bundle.add(bytes(frame), places)
        yield from bundle.close()
    return written(records.mapInArrow(pack, CATALOGUE), f"{folder}/{CATALOGUE_FOLDER}")


def open_bundles(spark, folder: str) -> DataFrame:
    """The catalogue of bundles that ``write_bundles`` left in a folder, in any session."""
    return spark.read.schema(CATALOGUE).parquet(f"{folder}/{CATALOGUE_FOLDER}")


@dataclass
class _BundleWriter:
    """Holds one bundle in memory until it is full; its catalogue rows follow when it is written."""

    folder: str
    limit: int
    count: int = 0

    def __post_init__(self):
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.body, self.sizes, self.places = bytearray(), [], []

    def add(self, frame: bytes, places: list[dict]) -> Iterator[pa.RecordBatch]:
        packed = self.packer.compress(frame)
        self.body += packed
        self.sizes.append((len(packed), len(frame)))
        self.places.append(places)
        if len(self.body) >= self.limit:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if not self.sizes:
            return
        name = files.attempt_name("warc.zst", self.count)
        files.write_bytes(self.folder, name, bytes(self.body) + seek_table(self.sizes))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(self.sizes)), pa.array(range(len(self.sizes)), pa.int32()),
             pa.array(self.places, _RECORDS)], ["bundle", "frame", "records"])
        self.count += 1
        self.body, self.sizes, self.places = bytearray(), [], []


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_records(catalogue: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The catalogued records, read from their bundles. A catalogue with fewer rows or
    records reads only their frames."""
    ship_package(catalogue.sparkSession)
    schema = _READ.append(pa.field("payload", pa.binary())) if with_payload else _READ

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, bundle = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    if source is not None:
                        source.close()
                    name, source = row["bundle"], files.open_file(folder, row["bundle"])
                    bundle = Bundle(source)
                frame = bundle.frame(row["frame"])
                found = [parse_record(frame[x["offset"]:x["offset"] + x["length"]]) for x in row["records"]]
                yield pa.RecordBatch.from_pylist([{k: x.get(k) for k in schema.names} for x in found], schema=schema)
        if source is not None:
            source.close()
    return catalogue.mapInArrow(unpack, READ + ", payload binary" * with_payload)


def find_records(catalogue: DataFrame, ids: DataFrame) -> DataFrame:
    """The part of the catalogue that holds the pages of ``ids`` (column page_id)."""
    wanted = ids.select("page_id").distinct()
    return (catalogue.select("bundle", "frame", F.explode("records").alias("r"))
            .join(wanted, F.col("r.page_id") == wanted["page_id"], "left_semi")
            .groupBy("bundle", "frame").agg(F.collect_list("r").alias("records")))


def op5_warc_bundles(spark, sf_dir: str) -> DataFrame:
    """Contract query: archives of all pages are written, then read back."""
    folder = shared_folder(spark, "warc")
    pages = load_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return read_records(write_bundles(records_of(pages), folder), folder)
