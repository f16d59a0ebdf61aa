"""WARC archives: monolithic gzip files, made into one gzip member per record with an offset index.

The writer stores records through Spark's text sink, one gzip stream per file. The normaliser inflates
each such stream once, cuts it by Content-Length, compresses every record as a member of its own, and
writes members and index through the same sink, so that any file system that Spark knows will do.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import fresh_path, stage

END = "\r\n\r\n"
#: An empty gzip member. The sink puts it after every record's member; readers skip it.
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003" "0300" "0000000000000000")
INDEX_LINES = 1000


def with_revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Adds payload, payload_bytes, payload_digest, record_type and refers_to.

    Of the pages with equal payloads of at least ``least_bytes`` bytes, the one with the smallest id is
    the response and the others revisit it.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.withColumn("payload", payload).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)}
    )
    repeated = hashed.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies")
    )
    repeated = stage(repeated.where("copies > 1 and first_id is not null").select("payload_digest", "first_id"), "repeated")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return hashed.join(repeated, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_monolithic(records: DataFrame, path: str, most_records: int = 50_000) -> None:
    """One WARC record per row, many records in one gzip stream per file."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    text = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), "record_type",
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20"),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha256:"), "payload_digest",
        F.lit("\r\nWARC-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))
        .otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(END), body,
    )
    writer = records.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", most_records).text(path)


def inflated(content: memoryview, piece: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of one or more gzip members, in pieces; the stream is read once."""
    state, at, rest = zlib.decompressobj(31), 0, b""
    while rest or at < len(content):
        if not rest:
            rest, at = bytes(content[at : at + piece]), at + piece
        out = state.decompress(rest, piece)
        if out:
            yield out
        rest = state.unconsumed_tail
        if state.eof:
            rest = state.unused_data
            state = zlib.decompressobj(31)
    out = state.flush()
    if out:
        yield out


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records_in(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, the closing line breaks included; holds one record and a piece at a time."""
    held, mark = bytearray(), END.encode()
    need = -1
    for piece in pieces:
        held += piece
        while True:
            if need < 0:
                at = held.find(mark)
                if at < 0:
                    break
                need = at + 4 + int(headers_of(bytes(held[:at]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = -1
    if held.strip():
        raise ValueError("the archive ends within a record")


def _member(raw: bytes, level: int) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


def normalise(spark, source: str, target: str, level: int = 6) -> None:
    """Rewrite every monolithic archive below ``source`` as members below ``target``.

    ``target/archive=NAME/kind=data`` holds the members, ``kind=index`` a gzip file of JSON lines with
    each record's id, offset and length.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "content")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(archive, kind, seqs, values):
            n = len(seqs)
            return pa.RecordBatch.from_arrays(
                [pa.array([archive] * n), pa.array([kind] * n), pa.array(seqs, pa.int64()), pa.array(values, pa.binary())],
                ["archive", "kind", "seq", "value"],
            )

        for batch in batches:
            for k in range(batch.num_rows):
                name = batch.column(0)[k].as_py().rpartition("/")[2].partition(".")[0]
                content = memoryview(batch.column(1)[k].as_buffer())
                offset, lines, packed, seqs, held = 0, [], [], [], 0
                for seq, record in enumerate(records_in(inflated(content))):
                    member = _member(record, level)
                    head = headers_of(record[: record.find(b"\r\n\r\n")])
                    lines.append(json.dumps({"id": head["warc-record-id"], "offset": offset, "length": len(member)}))
                    offset += len(member) + len(EMPTY_MEMBER)
                    packed.append(member)
                    seqs.append(seq)
                    held += len(member)
                    if held >= 4 << 20:
                        yield rows(name, "data", seqs, packed)
                        packed, seqs, held = [], [], 0
                    if len(lines) == INDEX_LINES:
                        yield rows(name, "index", [seq], [_member(("\n".join(lines) + "\n").encode(), level)])
                        lines = []
                if packed:
                    yield rows(name, "data", seqs, packed)
                if lines:
                    yield rows(name, "index", [1 << 62], [_member(("\n".join(lines) + "\n").encode(), level)])

    done = files.mapInArrow(rewrite, "archive string, kind string, seq long, value binary")
    ordered = done.sortWithinPartitions("archive", "kind", "seq").select("archive", "kind", F.col("value").cast("string").alias("value"))
    writer = ordered.write.partitionBy("archive", "kind").option("encoding", "ISO-8859-1")
    writer.option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(target)


def read_indexed(spark, target: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record.

    Each record is inflated alone, at the offset that the index gives.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(target)
    named = files.select(
        F.regexp_extract("path", "archive=([^/]*)/", 1).alias("archive"),
        F.regexp_extract("path", "kind=([^/]*)/", 1).alias("kind"), "content",
    )

    def index(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                lines = b"".join(inflated(memoryview(batch.column(1)[k].as_buffer()))).splitlines()
                entries = [json.loads(x) for x in lines]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[k].as_py()]), pa.array([[e["offset"] for e in entries]], pa.list_(pa.int64())),
                     pa.array([[e["length"] for e in entries]], pa.list_(pa.int64()))],
                    ["archive", "offsets", "lengths"],
                )

    def number(urn):
        digits = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
        return int(digits) if digits else None

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                content = memoryview(batch.column(0)[k].as_buffer())
                out = []
                for offset, length in zip(batch.column(1)[k].as_py(), batch.column(2)[k].as_py(), strict=True):
                    record = zlib.decompress(content[offset : offset + length], 31)
                    at = record.find(b"\r\n\r\n")
                    h = headers_of(record[:at])
                    body = memoryview(record)[at + 4 : -4]
                    digest = h["warc-payload-digest"].removeprefix("sha256:")
                    size = int(h["warc-payload-length"])
                    if h["warc-type"] == "response":
                        if len(body) != size or hashlib.sha256(body).hexdigest() != digest:
                            raise ValueError(f"payload of {h['warc-record-id']} does not match its header")
                    out.append((number(h["warc-record-id"]), size, digest, h["warc-type"], number(h.get("warc-refers-to")), h["warc-target-uri"]))
                    if len(out) == 1000:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    offsets = named.where("kind = 'index'").select("archive", "content").mapInArrow(
        index, "archive string, offsets array<long>, lengths array<long>"
    )
    data = named.where("kind = 'data'").join(stage(offsets, "offsets"), "archive")
    return data.select("content", "offsets", "lengths").mapInArrow(read, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def archive_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write pages as archives, normalise these, and read them back by their index.

    A null html is an empty payload, a null url an empty target; control characters and blanks in a URL
    become %20. A null id never is the response that others refer to, unless its payload is alone. Rows
    that repeat an id and payload of the response are responses too. An empty table gives no rows. Other
    columns are ignored.
    """
    spark = pages.sparkSession
    source, target = fresh_path(spark, "warc"), fresh_path(spark, "warc-members")
    clean = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    write_monolithic(with_revisits(clean), source)
    normalise(spark, source, target)
    return read_indexed(spark, target)
