"""Archives in exact round trips, with ranges cut anywhere."""

import base64
import gzip
import hashlib
import io
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wattloom.llm.warc import Members, page_record, read_warc, warc_report, warcinfo, write_warc


def pages():
    inner = warcinfo("<urn:uuid:x>") + page_record(99, None, b"inner", None, "<urn:uuid:x>")
    noise = random.Random(4).randbytes(3000).hex() + inner.hex()
    rows = [(i, f"http://h/{i}", f"<p>{'text ' * i}{i % 7}</p>") for i in range(60)]
    rows += [(i, None, "same") for i in range(200, 240)] + [(300, "http://a b\r\nX: 1", None), (301, "u", ""), (None, "u", "same"), (None, "u", "only"), (302, "u", noise), (239, "u", "same")]
    return rows


def expected(rows):
    out = []
    for page_id, _, html in rows:
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        target = max(same, default=None)
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = target is not None and page_id != target
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=repr)


def test_report(spark):
    docs = spark.createDataFrame([(*r, 0) for r in pages()], "page_id long, url string, html string, payload int")
    assert sorted(map(tuple, warc_report(docs).collect()), key=repr) == expected(pages())
    assert warc_report(docs.limit(0)).collect() == []


@pytest.mark.parametrize("split", [97, 700, 1 << 22])
def test_ranges_and_payloads(spark, tmp_path, split):
    docs = spark.createDataFrame(pages(), "page_id long, url string, html string").repartition(3)
    manifest = write_warc(docs, str(tmp_path), file_bytes=4000)
    assert manifest.agg({"records": "sum"}).head()[0] == len(pages())
    found = read_warc(manifest, str(tmp_path), split).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=repr) == expected(pages())
    texts = {r[0]: r[2] or "" for r in pages() if r[0] is not None}
    for r in found:
        if r.record_type == "response" and r.page_id is not None:
            assert r.payload.decode() == texts[r.page_id]
    for name in os.listdir(tmp_path):
        if name.endswith(".gz"):
            assert gzip.open(tmp_path / name).read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_members_inside_payloads_are_not_records():
    inner = warcinfo("<urn:uuid:in>") + page_record(1, None, b"a", None, "<urn:uuid:in>")
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    record = gzip.decompress(page_record(2, None, inner, None, "<urn:uuid:out>"))
    outer = warcinfo("<urn:uuid:out>") + stored.compress(record) + stored.flush() + page_record(3, None, b"b", None, "<urn:uuid:out>")
    assert outer.count(b"\x1f\x8b\x08") == 5
    found = []
    for start in range(0, len(outer), 50):
        found += [h["warc-record-id"] for h, _ in Members(io.BytesIO(outer)).records(start, start + 50)]
    assert found == ["<urn:uuid:out>", "<urn:page:2>", "<urn:page:3>"]


def test_damage_is_found():
    data = warcinfo("<urn:uuid:out>") + page_record(2, None, b"x" * 1000, None, "<urn:uuid:out>")
    with pytest.raises((ValueError, zlib.error)):
        list(Members(io.BytesIO(data[:-20])).records(0, len(data)))


def test_a_header_of_any_length(spark):
    rng = random.Random(9)
    rows = [(1, "http://h/" + "a" * (1 << 21), "long"), (2, "http://h/" + rng.randbytes(800_000).hex(), "noise"), (3, "http://h/3", "short")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(map(tuple, warc_report(docs).collect()), key=repr) == expected(rows)


def test_missing_records_are_found(spark, tmp_path):
    docs = spark.createDataFrame(pages()[:20], "page_id long, url string, html string").repartition(1)
    manifest = write_warc(docs, str(tmp_path)).withColumn("records", F.col("records") + 1)
    with pytest.raises(ValueError, match="has 21 records, 20 were read"):
        read_warc(manifest, str(tmp_path))
