"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames; each frame is an independent Zstandard frame, so any frame can be
read alone. A bundle is a file of frames that ends with a skippable frame holding the seek table
(compressed and plain size of every frame) and its footer, as the seekable format has it. The index
maps each record to its bundle, frame and place inside the frame.

Every write task makes its bundles under names of its own and reports them in the index; the index
is a table that Spark commits. A bundle of a failed or repeated task is in no index and is never read.
Bundles go to the shared folder through Arrow's file systems (local, HDFS, S3, GCS).

Payloads that occur more than once and have at least ``MIN_SHARED`` bytes are stored once, as the
response of the smallest page id; other pages revisit it.

Rows that are equal in page id and payload have equal record ids.

Cases: null html is an empty payload. Rows that repeat the response's page id are responses too. Rows
with a null page id are responses unless an equal payload has an id. Empty tables give an empty
index and no bundle. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import spread_join, stored
from tidemark.session import new_folder

MIN_SHARED = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
#: Neighbouring frames that are read by one task.
FRAMES_A_TASK = 16
#: The records' date unless the caller gives the crawl's, so that archives of equal pages have equal records.
DATE = "1970-01-01T00:00:00Z"
#: Fixed value of the WARC 1.1 format: revisits that are known by an equal payload digest.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("bundle", T.StringType()), T.StructField("frame", T.IntegerType()),
    T.StructField("frame_at", T.LongType()), T.StructField("frame_size", T.LongType()),
    T.StructField("record_at", T.LongType()), T.StructField("record_size", T.LongType()),
])


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle; ``sizes``: (compressed, plain) bytes of each frame."""
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(source: pa.NativeFile, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed, plain) of each frame of an open bundle of ``size`` bytes."""
    source.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the bundle has no seek table")
    source.seek(size - 9 - 8 * count)
    table = np.frombuffer(source.read(8 * count), "<u4").reshape(-1, 2).astype(np.int64)
    ends = np.cumsum(table[:, 0])
    return [(int(e - c), int(c), int(p)) for e, (c, p) in zip(ends, table, strict=True)]


def urn(page_id: int | None, digest: str) -> str:
    """The record id of a page with a payload: a UUID made of both, so that reruns are equal."""
    return uuid.uuid5(uuid.NAMESPACE_OID, f"{page_id}:{digest}").urn


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record; a revisit has no block and names the record and the page it refers to.

    A page without url gets its record id for one. Control characters of a url are percent-encoded.
    """
    own = urn(page_id, digest)
    target = re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url or own)
    block = payload if kind == "response" else b""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{own}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", f"<{urn(refers_to, digest)}>"),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of every record of a plain frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        stop = start + int(fields["Content-Length"])
        yield at, fields, frame[start:stop]
        at = stop + 4


def decide(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload`` with its length and digest, record type and the page it refers to."""
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    payload = F.coalesce(F.encode("html", "utf-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    large = F.octet_length("payload") >= MIN_SHARED
    shared = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = spread_join(rows, shared, "digest", F.col("page_id"), "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False))
    return joined.select(
        "page_id", "url", "payload", F.lower(F.hex("digest")).alias("digest"),
        F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> DataFrame:
    """Write the rows of ``decide`` as bundles under ``folder``; returns the stored index.

    ``date``: when the pages were fetched, in the format's form of ISO 8601.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=3)
        out, name, sizes, frame, places, rows = None, "", [], [], [], []

        def flush() -> None:
            """Close the frame that is being filled."""
            nonlocal frame, places
            if not frame:
                return
            plain = b"".join(frame)
            packed = packer.compress(plain)
            at = sum(c for c, _ in sizes)
            out.write(packed)
            rows.extend((page, name, len(sizes), at, len(packed), start, size) for page, start, size in places)
            sizes.append((len(packed), len(plain)))
            frame, places = [], []

        def close() -> None:
            nonlocal out, sizes
            if out is not None:
                flush()
                out.write(seek_table(sizes))
                out.close()
            out, sizes = None, []

        def index() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], INDEX.fieldNames()
            )

        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        filled = 0
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for row in zip(*columns, strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                data = record(*row, date)
                places.append((row[0], filled, len(data)))
                frame.append(data)
                filled += len(data)
                if filled >= frame_bytes:
                    flush()
                    filled = 0
                    if sum(c for c, _ in sizes) >= bundle_bytes:
                        close()
            if rows:
                yield index()
        close()
        if rows:
            yield index()

    return stored(records.mapInArrow(work, INDEX), "warc-index")


_RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("payload", T.BinaryType()),
])


def _page(field: str | None) -> int | None:
    return None if field is None else int(field)


def read_bundles(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all bundles that ``index`` names, read frame by frame and checked on the way.

    Frames are dealt over tasks. The seek table must agree with the index, and each response's payload
    with its digest. ``payload`` is null for revisits, and for all rows without ``payloads``.
    """
    frames = index.groupBy("bundle", "frame", "frame_at", "frame_size").agg(F.sort_array(F.collect_list("record_at")).alias("places"))

    # The index is small beside its frames: deal it by number, or few tasks would read all bundles.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frames = frames.repartition(tasks, "bundle", F.floor(F.col("frame") / FRAMES_A_TASK))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        name, source, table = None, None, []
        for batch in batches:
            for row in sorted(batch.to_pylist(), key=lambda r: (r["bundle"], r["frame"])):
                if row["bundle"] != name:
                    if source is not None:
                        source.close()
                    name, path = row["bundle"], f"{root}/{row['bundle']}"
                    source = files.open_input_file(path)
                    table = read_seek_table(source, source.size())
                at, packed, plain = table[row["frame"]]
                if (at, packed) != (row["frame_at"], row["frame_size"]):
                    raise ValueError(f"{name}: frame {row['frame']} is not where the index says")
                source.seek(at)
                data = unpack.decompress(source.read(packed), max_output_size=plain)
                found = []
                for place, fields, block in parse(data):
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if fields["WARC-Type"] == "response" and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"{name}: the payload at {place} does not have its digest")
                    found.append((place, _page(fields.get("X-Page-ID")), int(fields["X-Payload-Length"]), digest, fields["WARC-Type"], _page(fields.get("X-Refers-To-Page")), block))
                if [x[0] for x in found] != row["places"]:
                    raise ValueError(f"{name}: frame {row['frame']} does not hold the records that the index names")
                _, page, size, digest, kind, refers, block = zip(*found, strict=True)
                shown = [b if payloads and k == "response" else None for b, k in zip(block, kind, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(page, pa.int64()), pa.array(size, pa.int64()), pa.array(digest, pa.string()),
                        pa.array(kind, pa.string()), pa.array(refers, pa.int64()), pa.array(shown, pa.binary()),
                    ],
                    _RECORD.fieldNames(),
                )
        if source is not None:
            source.close()

    return frames.mapInArrow(work, _RECORD)


def lookup(index: DataFrame, folder: str, ids: DataFrame) -> DataFrame:
    """The records of some pages (column page_id of ``ids``): only their frames are read."""
    wanted = ids.select("page_id").distinct()
    frames = index.join(wanted, "page_id", "left_semi").select("bundle", "frame").distinct()
    return read_bundles(index.join(frames, ["bundle", "frame"], "left_semi"), folder).join(wanted, "page_id", "left_semi")


def archive(pages: DataFrame, date: str = DATE) -> tuple[DataFrame, str]:
    """Write all pages; returns the index and the folder of the bundles."""
    folder = new_folder(pages.sparkSession, "warc")
    return write_bundles(decide(pages), folder, date=date), folder
