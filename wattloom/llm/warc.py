"""WARC archives: a writer of gzip members, one per record, and a splittable reader.

Writing: which records are revisits is settled on digests alone (a combinable maximum per payload, joined back on small
rows); then every task writes the records of its rows to files of its own, and a manifest names the files of the tasks
that finished. Each file starts with a warcinfo record, and each record names it.

Reading: files are cut into byte ranges. A task scans its range for the gzip magic, decodes the start of each candidate
member, and takes it for a record if that is a WARC header which names the file's warcinfo record (a payload may itself
hold archives). A task owns the records that start inside its range and reads past its end to complete the last one.
Payloads are compared with their digests, and the number of records of each file with the manifest. A header may have any
length.

Nulls and edges: a null payload is empty; a null page_id is kept, and is the target of revisits only if no other
identifier has the payload; a null url is left out. Rows that share the largest page_id of a payload are all responses.
Line breaks and other controls in a url are percent-encoded. An empty table gives no file and an empty result.
Identifiers are integers.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import written
from wattloom.llm.files import create, open_file
from wattloom.session import scratch_dir, shuffle_partitions

FILE_BYTES = 1 << 30
SPLIT_BYTES = 4 << 20
LEAST_PAYLOAD = 0
GZIP = b"\x1f\x8b\x08"
STEP = 1 << 16
DATE = "1970-01-01T00:00:00Z"  # the pages carry no time of their own
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH = "X-Payload-Length"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def urn_page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def warcinfo(info_id: str) -> bytes:
    return member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", info_id), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def page_record(page_id: int | None, url: str | None, payload: bytes, target: int | None, info_id: str) -> bytes:
    revisit = target is not None
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", page_urn(page_id)), ("WARC-Warcinfo-ID", info_id), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest32(payload)}"), (LENGTH, str(len(payload))), ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", page_urn(target))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return member(fields, http if revisit else http + payload)


def with_targets(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, url, payload, and target: the page that a revisit refers to, null for responses."""
    source = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    source = source.withColumns({"digest": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")})
    signs = source.where(F.col("size") >= least_payload).select("page_id", "digest", "size")
    shared = signs.groupBy("digest", "size").agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = signs.join(shared.select("digest", "size", "target"), ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("target")))
    revisits = revisits.select(F.col("page_id").alias("id"), F.col("digest").alias("d"), "target").distinct()
    same = source["page_id"].eqNullSafe(revisits["id"]) & (source["digest"] == revisits["d"])
    return source.join(revisits, same, "left").select("page_id", "url", "payload", "target")


def write_warc(pages: DataFrame, folder: str, least_payload: int = LEAST_PAYLOAD, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the pages as archives under ``folder``; the manifest: file, bytes, records."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, info, size, count, done = "", None, "", 0, 0, []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "target")]
            for row in range(batch.num_rows):
                page_id, url, payload, target = (c[row].as_py() for c in columns)
                if file is None:
                    name, file = create(folder, ".warc.gz")
                    info, count = f"<urn:uuid:{uuid.uuid4()}>", 0
                    first = warcinfo(info)
                    file.write(first)
                    size = len(first)
                record = page_record(page_id, url, payload, target, info)
                file.write(record)
                size, count = size + len(record), count + 1
                if size >= file_bytes:
                    file.close()
                    done.append((name, size, count))
                    file = None
        if file is not None:
            file.close()
            done.append((name, size, count))
        if done:
            names, sizes, counts = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["file", "bytes", "records"])

    return written(with_targets(pages, least_payload).mapInArrow(write, "file string, bytes bigint, records bigint"), "warc-manifest")


class Members:
    """The gzip members of a file, found from any place in it."""

    def __init__(self, file: BinaryIO):
        self.file = file

    def at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def header(self, place: int) -> dict[str, str] | None:
        """The WARC header of the member that starts at ``place``, or None if none starts there."""
        unpack, text, seen = zlib.decompressobj(31), bytearray(), 0
        while True:
            data = unpack.unconsumed_tail
            if not data:
                data = self.at(place, STEP)
                place += len(data)
            try:
                text += unpack.decompress(data, STEP)
            except zlib.error:
                return None
            if not text.startswith(b"WARC/1."[: len(text)]):
                return None
            end = text.find(b"\r\n\r\n", max(0, seen - 3))
            if end >= 0:
                lines = text[:end].decode("utf-8", "replace").split("\r\n")[1:]
                return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
            if not data or unpack.eof:
                return None
            seen = len(text)

    def whole(self, place: int) -> tuple[bytes, int]:
        """The content of the member that starts at ``place``, and where it ends."""
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            data = self.at(place, 1 << 20)
            if not data:
                raise ValueError("a record is cut off")
            parts.append(unpack.decompress(data))
            place += len(data)
        return b"".join(parts), place - len(unpack.unused_data)

    def records(self, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
        """Header and block of every record that starts in [start, end)."""
        first = self.header(0) or {}
        info = first.get("warc-record-id") if first.get("warc-type") == "warcinfo" else None
        place, held, held_at = start, b"", start
        while place < end:
            if place < held_at or place + len(GZIP) > held_at + len(held):
                held, held_at = self.at(place, 1 << 20), place
            if len(held) - (place - held_at) < len(GZIP):
                return
            found = held.find(GZIP, place - held_at)
            if found < 0:
                place = held_at + len(held) - len(GZIP) + 1
                continue
            place = held_at + found
            if place >= end:
                return
            head = self.header(place)
            own = head is not None and (info is None or info in (head.get("warc-warcinfo-id"), head.get("warc-record-id")))
            if not own:
                place += 1
                continue
            content, place = self.whole(place)
            yield head, content.partition(b"\r\n\r\n")[2][: int(head["content-length"])]


def read_warc(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """Every response and revisit of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The records read are counted by file; a file that gives more or fewer than its manifest says is an error.
    """
    starts = F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    ranges = manifest.where("bytes > 0").select("file", starts).withColumn("end", F.col("start") + split_bytes)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("file", pa.string())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, end in zip(*[c.to_pylist() for c in batch.columns]):
                with open_file(folder, name) as file:
                    rows, held = [], 0
                    for head, block in Members(file).records(start, end):
                        kind = head.get("warc-type")
                        if kind not in ("response", "revisit"):
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                        size = int(head[LENGTH.lower()]) if kind == "revisit" else len(payload)
                        if kind == "response" and digest32(payload) != digest:
                            raise ValueError(f"the payload of {head.get('warc-record-id')} does not match its digest")
                        kept = payload if with_payload and kind == "response" else None
                        rows.append((urn_page(head.get("warc-record-id")), head.get("warc-target-uri"), size, digest, kind, urn_page(head.get("warc-refers-to")), kept, name))
                        held += len(kept or b"") + 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    kinds = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary, file string"
    rows = written(ranges.repartition(shuffle_partitions(manifest.sparkSession)).mapInArrow(read, kinds), "warc-records")
    counts = rows.groupBy(F.col("file").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    wrong = manifest.join(counts, manifest["file"] == counts["name"], "left").where("coalesce(n, 0) <> records").head()
    if wrong is not None:
        raise ValueError(f"{wrong.file} has {wrong.records} records, {wrong.n or 0} were read")
    return rows.drop("file")


def warc_report(pages: DataFrame) -> DataFrame:
    """Write the pages as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = scratch_dir(pages.sparkSession, "warc")
    found = read_warc(write_warc(pages, folder), folder, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
