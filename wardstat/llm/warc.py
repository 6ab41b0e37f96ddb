"""WARC archives: written with an index, read back by coalesced byte ranges.

The writer makes compressed WARC/1.1 files, a gzip member per record, and an index row per record: file, offset,
length, URL and digest. Readers select index rows first. Selected records of a file are sorted by offset, close ones
are read in one range, and each is cut out of it. Archives lie in a folder that all executors reach and that
``pyarrow.fs`` can open (a shared folder, S3, GCS or HDFS). A file's name is new with every attempt of a task and only
the index of the attempt that succeeds names it, so lost executors leave at most files that nothing refers to.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wardstat.llm.common import chunks, sql_type, stored, text_of

#: Payloads below this size are always stored.
LEAST_SHARED = 100
#: Bytes after which a task begins a new archive.
ARCHIVE_BYTES = 1 << 30
#: Bytes of one read at most, and the gap between records that is read along.
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def with_kind(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """(key, url, payload, bytes, digest, first): ``first`` is the smallest key among rows of the same payload of at
    least LEAST_SHARED bytes, if there are several.

    Keys are gathered before the shuffle; a payload that much of the table shares is split by the adaptive
    planner, and rows of small payloads are spread by their own key.
    """
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), text_of(payload).alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    shared = rows.where(F.col("bytes") >= LEAST_SHARED).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    # Stored, so that the join is of plain shuffles.
    shared = stored(shared.where("n > 1").select(F.col("digest").alias("met"), "first"), "warc-shared")
    met = F.when(F.col("bytes") >= LEAST_SHARED, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("key").cast("string"), F.lit(""))))
    return rows.withColumn("met", met).join(shared, "met", "left").drop("met")


def record(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    """One record as a gzip member; fields without a value are left out."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, **fields}
    lines = [f"{name}: {_line(value)}" for name, value in head.items() if value is not None]
    whole = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def _line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _value(line: str) -> str:
    return line.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields and the block of one record."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name: _value(value) for name, _, value in (line.partition(": ") for line in lines[1:])}
    return fields, rest[: int(fields["Content-Length"])]


INDEX = [("file", StringType()), ("offset", LongType()), ("length", LongType()), ("url", StringType()), ("digest", StringType())]


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``rows`` of ``with_kind`` as archives under ``folder``; the index, to be stored by the caller at once: a second
    evaluation writes the archives a second time.

    A row is a revisit if another with a smaller key has the same payload of at least LEAST_SHARED bytes. Rows that
    share the smallest key are all responses, and a null key is never smaller than another.
    """
    kind = sql_type(rows, "key")
    schema = StructType([StructField(c, t) for c, t in INDEX] + [StructField("key", kind)])
    later = F.col("first").isNotNull() & (F.col("key").isNull() | (F.col("key") > F.col("first")))
    rows = rows.select(
        "key", F.col("key").cast("string").alias("name"), "url", F.col("payload").alias("text"), "bytes", "digest",
        F.when(later, F.col("first").cast("string")).alias("refers"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, path, offset = None, "", 0
        try:
            for part in chunks(batches):
                index = []
                for r in part.drop_columns(["key"]).to_pylist():
                    if out is None or offset >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        path, offset = posixpath.join(base, f"{uuid.uuid4().hex}.warc.gz"), 0
                        out = store.open_output_stream(path, compression=None)
                    payload = r["text"].encode()
                    fields = {
                        "WARC-Target-URI": r["url"],
                        "WARC-Payload-Digest": "sha256:" + r["digest"],
                        "Content-Type": "application/http; msgtype=response",
                        "X-Key": r["name"],
                        "X-Payload-Length": str(r["bytes"]),
                    }
                    if r["refers"] is None:
                        member = record("response", fields, HTTP % len(payload) + payload)
                    else:
                        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                        fields["X-Refers-To-Key"] = r["refers"]
                        member = record("revisit", fields, HTTP % len(payload))
                    out.write(member)
                    index.append((path, offset, len(member), r["url"], r["digest"]))
                    offset += len(member)
                columns = [pa.array(c, t) for c, t in zip(zip(*index), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, part.column("key")], schema.names)
        finally:
            if out is not None:
                out.close()

    return rows.mapInArrow(run, schema)


def ranges(spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """Sorted (file, offset, length) spans coalesced: file, begin, end and the numbers of the spans inside."""
    group: list[int] = []
    for i, (file, offset, length) in enumerate(spans):
        if group:
            same, begin = spans[group[0]][:2]
            end = sum(spans[group[-1]][1:])
            if file != same or offset - end > GAP_BYTES or offset + length - begin > RANGE_BYTES:
                yield same, begin, end, group
                group = []
        group.append(i)
    if group:
        yield spans[group[0]][0], spans[group[0]][1], sum(spans[group[-1]][1:]), group


READ = "name string, url string, bytes long, digest string, kind string, refers string, payload string"


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` rows name: key as text, URL, payload length and digest, kind, the key that a revisit
    refers to, and the payload (null for revisits, or if not wanted). A response whose payload has another digest than its
    header stops the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        at, source = None, None
        names = [c.split()[0] for c in READ.split(", ")]
        for batch in batches:
            spans = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for file, begin, end, group in ranges(spans):
                if file != at:
                    at, source = file, store.open_input_file(file)
                data = source.read_at(end - begin, begin)
                rows = []
                for i in group:
                    _, offset, length = spans[i]
                    fields, block = parse(data[offset - begin : offset - begin + length])
                    digest, payload = fields["WARC-Payload-Digest"].partition(":")[2], None
                    if fields["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(fields["X-Payload-Length"]):
                            raise ValueError(f"damaged record in {file} at {offset}")
                    text = payload.decode() if with_payload and payload is not None else None
                    rows.append((fields.get("X-Key"), fields.get("WARC-Target-URI"), int(fields["X-Payload-Length"]), digest,
                                 fields["WARC-Type"], fields.get("X-Refers-To-Key"), text))
                kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    spans = index.select("file", "offset", "length", F.expr(f"offset div {RANGE_BYTES}").alias("stretch"))
    spans = spans.repartition("file", "stretch").sortWithinPartitions("file", "offset")
    return spans.select("file", "offset", "length").mapInArrow(run, READ)
