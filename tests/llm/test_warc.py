import hashlib
import io
import random
import re

import pyarrow as pa
import pyarrow.fs
import zstandard

from tidemark.llm import warc as W


def pages_of(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}", h, "e", "f") for i, h in rows], "page_id BIGINT, url STRING, html STRING, digest STRING, kind STRING")


def brute(rows):
    first = {}
    for i, h in rows:
        b = (h or "").encode()
        if i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, h in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and b in first and first[b] != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def rows_of(draw):
    html = ["".join(draw.choices("abc <>\r\né", k=draw.choice([0, 40, 99, 100, 5000]))) for _ in range(30)]
    rows = [(i, draw.choice(html)) for i in range(200)] + [(200 + i, "hot page " * 40) for i in range(120)]
    rows += [(400, None), (401, ""), (None, html[0]), (None, "lone" * 50), (3, "hot page " * 40), (402, "x" * 3_000_000), (402, "x" * 3_000_000)]
    draw.shuffle(rows)
    return rows


def test_round_trip_matches_brute_force(spark):
    rows = rows_of(random.Random(4))
    index, folder = W.archive(pages_of(spark, rows))
    back = W.read_bundles(index, folder)
    found = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    for r in back.where("record_type = 'response'").collect():
        assert hashlib.sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"]


def test_records_have_the_fields_that_the_format_demands():
    digest = hashlib.sha256(b"x" * 100).hexdigest()
    first = W.record(5, "http://x/a b\r\nWARC-Type: c", b"x" * 100, digest, "response", None, "2024-05-01T10:00:00Z")
    second = W.record(9, None, b"x" * 100, digest, "revisit", 5)
    (_, a, body), (_, b, empty) = W.parse(first + second)
    for fields in (a, b):
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"])
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"])
        assert fields["WARC-Target-URI"] and " " not in fields["WARC-Target-URI"]
    assert (a["WARC-Type"], a["WARC-Date"], a["Content-Length"], body) == ("response", "2024-05-01T10:00:00Z", "100", b"x" * 100)
    assert (b["WARC-Type"], b["WARC-Refers-To"], b["Content-Length"], empty) == ("revisit", a["WARC-Record-ID"], "0", b"")
    assert b["WARC-Profile"].endswith("/revisit/identical-payload-digest") and "WARC-Profile" not in a
    assert a["WARC-Record-ID"] != b["WARC-Record-ID"]


def test_lookup_reads_only_the_named_records(spark):
    rows = [(i, f"page {i} " * 400) for i in range(300)]
    folder = W.new_folder(spark, "warc")
    index = W.write_bundles(W.decide(pages_of(spark, rows)), folder, frame_bytes=20_000, bundle_bytes=5_000)
    found = W.lookup(index, folder, spark.createDataFrame([(7,), (250,), (999,)], "page_id BIGINT")).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in found} == {i: f"page {i} " * 400 for i in (7, 250)}
    assert index.select("bundle").distinct().count() > 1


def test_bundles_are_seekable_and_plain_zstandard(spark):
    rows = [(i, f"page {i} " * 500) for i in range(50)]
    folder = W.new_folder(spark, "warc")
    index = W.write_bundles(W.decide(pages_of(spark, rows)), folder, frame_bytes=30_000)
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    seen = 0
    for (name,) in index.select("bundle").distinct().collect():
        data = files.open_input_file(f"{root}/{name}").read()
        table = W.read_seek_table(pa.BufferReader(data), len(data))
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        assert len(plain) == sum(p for _, _, p in table)
        seen += plain.count(b"WARC/1.1\r\n")
    assert seen == 50


def test_empty_table(spark):
    index, folder = W.archive(pages_of(spark, []))
    assert W.read_bundles(index, folder).collect() == []
