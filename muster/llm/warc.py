"""WARC archives: one gzip member per record, written from rows and read back in sequence.

Archives are files that Python workers write and read through Arrow's file systems (local, HDFS, S3,
GCS). A task names its archives anew at each attempt and returns their names; the names of the attempts
that Spark commits are stored as a table, the manifest, and only archives of a manifest are read. So
lost executors and speculative tasks leave files that nothing reads, and no doubled records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.tables import stored, table
from muster.session import shared_folder

MIN_BYTES = 1000
ARCHIVE_BYTES = 512 << 20
# Compressed bytes read, and bytes of text inflated, in one step.
CHUNK = 1 << 16
MAX_HEAD = 1 << 20
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
BUFFER = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("problem", T.StringType()),
    ]
)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path there."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


# Records


def label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def digest_of(value: str | None) -> str | None:
    """Hexadecimal form of a labelled SHA-1; null if it is none."""
    kind, _, text = (value or "").partition(":")
    try:
        found = base64.b32decode(text.upper()) if len(text) == 32 else bytes.fromhex(text)
    except ValueError:
        return None
    return found.hex() if kind.lower() == "sha1" and len(found) == 20 else None


def record_id(key: object, digest: bytes) -> str:
    """Rows of one key and payload have one id; rows without key have an id each."""
    return f"<urn:uuid:{uuid.uuid4() if key is None else uuid.uuid5(IDS, f'{key}/{digest.hex()}')}>"


def uri(url: str) -> str:
    """``url`` as a header value: what is no visible ASCII is percent-encoded."""
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in url.encode())


def member(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as one gzip member."""
    fields = [*headers, ("WARC-Block-Digest", label(hashlib.sha1(block).digest())), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in fields if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(key: object, url: str | None, payload: bytes, original: object, date: str) -> bytes:
    """A response, or, if an original is named, a revisit without the payload."""
    digest = hashlib.sha1(payload).digest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    again = original is not None and original != key
    return member(
        [
            ("WARC-Type", "revisit" if again else "response"),
            ("WARC-Record-ID", record_id(key, digest)),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if url is None else uri(url)),
            ("WARC-Payload-Digest", label(digest)),
            ("WARC-Profile", PROFILE if again else None),
            ("WARC-Refers-To", record_id(original, digest) if again else None),
            ("X-Key", None if key is None else quote(str(key), safe="")),
            ("Content-Type", "application/http;msgtype=response"),
        ],
        head.encode() + (b"" if again else payload),
    )


class Archive:
    """Reads an archive in sequence: inflates a member piece by piece, frames its record by the stated
    length and checks its digests. At most one payload is held."""

    def __init__(self, stream: BinaryIO, payloads: bool):
        self.stream, self.payloads = stream, payloads
        self.raw, self.at = b"", 0
        self.text, self.inflater = b"", zlib.decompressobj(31)

    def _fill(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        return bool(self.raw)

    def _inflate(self) -> bool:
        """Adds some text of the member; false at its end."""
        while not self.inflater.eof:
            if not self._fill():
                raise ValueError("TRUNCATED")
            piece = self.inflater.decompress(self.raw, CHUNK)
            rest = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            self.at += len(self.raw) - len(rest)
            self.raw = rest
            if piece:
                self.text += piece
                return True
        return False

    def _head(self) -> tuple[str, dict[str, str]]:
        """First line and fields up to the empty line."""
        while (end := self.text.find(b"\r\n\r\n")) < 0:
            if len(self.text) > MAX_HEAD or not self._inflate():
                raise ValueError("HEADER")
        first, *lines = self.text[:end].decode("utf-8", "replace").split("\r\n")
        self.text = self.text[end + 4 :]
        fields = {}
        for line in lines:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        return first, fields

    def _block(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.text and not self._inflate():
                raise ValueError("CONTENT_LENGTH")
            piece, self.text = self.text[:length], self.text[length:]
            length -= len(piece)
            yield piece

    def _record(self) -> dict:
        first, fields = self._head()
        length = fields.get("content-length", "")
        if not first.startswith("WARC/") or not length.isdecimal():
            raise ValueError("HEADER")
        found = {
            "record_type": fields.get("warc-type"),
            "record_id": fields.get("warc-record-id"),
            "key": unquote(fields["x-key"]) if "x-key" in fields else None,
            "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to"),
        }
        whole, body = hashlib.sha1(), hashlib.sha1()
        http = fields.get("content-type", "").startswith("application/http")
        head, size, kept = (b"" if http else None), 0, []
        for piece in self._block(int(length)):
            whole.update(piece)
            if head is not None:
                head, end, piece = (head + piece).partition(b"\r\n\r\n")
                if not end:
                    continue
                stated, head = head, None
            body.update(piece)
            size += len(piece)
            if self.payloads:
                kept.append(piece)
        while len(self.text) <= 4 and self._inflate():
            pass
        if self.text != b"\r\n\r\n":
            raise ValueError("CONTENT_LENGTH")
        digest = digest_of(fields.get("warc-payload-digest"))
        if found["record_type"] == "revisit":
            said = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", stated) if http and head is None else None
            found |= {"payload_bytes": int(said[1]) if said else None, "payload_digest": digest}
        else:
            found |= {"payload_bytes": size, "payload_digest": body.hexdigest(), "payload": b"".join(kept)}
            if digest is not None and digest != body.hexdigest():
                found["problem"] = "PAYLOAD_DIGEST"
        if digest_of(fields.get("warc-block-digest")) not in (None, whole.hexdigest()):
            found["problem"] = "BLOCK_DIGEST"
        return found

    def records(self) -> Iterator[dict]:
        """All records in order; a part that cannot be framed ends the archive with a ``problem``."""
        while self._fill():
            offset = self.at
            self.text, self.inflater = b"", zlib.decompressobj(31)
            try:
                yield {"offset": offset, **self._record()}
            except (ValueError, zlib.error) as broken:
                yield {"offset": offset, "problem": "INFLATE" if isinstance(broken, zlib.error) else str(broken)}
                return


# Tables


def revisits(pages: DataFrame, min_bytes: int, key: str, url: str, payload: str) -> DataFrame:
    """(key, url, payload, original): the largest key of the rows of equal payload, null if it has no other.

    Payloads are equal if length, SHA-1 and SHA-256 are. Keys are counted per payload with partial
    maxima; the originals are stored, so that adaptive execution can split a payload of many rows.
    """
    text = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), text.alias("payload"))
    same = [F.octet_length("payload").alias("n"), F.sha1("payload").alias("s1"), F.sha2("payload", 256).alias("s2")]
    shared = (
        rows.select("key", *same)
        .filter(F.col("n") >= min_bytes)
        .groupBy("n", "s1", "s2")
        .agg(F.count(F.lit(1)).alias("m"), F.max("key").alias("original"))
        .filter("m > 1 and original is not null")
        .drop("m")
    )
    shared = stored(shared, "warc-originals")
    return rows.select("*", *same).join(shared, ["n", "s1", "s2"], "left").select("key", "url", "payload", "original")


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = MIN_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: datetime | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
) -> DataFrame:
    """Writes a record per row into archives below ``folder``; gives the manifest (archive, records, bytes).

    Of rows with equal payloads of ``min_bytes`` or more, those of the largest key are responses and the
    others revisit them. An archive begins with a ``warcinfo`` record and is closed when it has
    ``archive_bytes``; a task writes its rows as they come and holds one.

    Null payload: empty. Null url: a record without target. Rows without key are responses if no row
    with a key has their payload. Repeated rows of a key and payload: a record each, of one id. Very long
    payloads are one record each. Empty table: no archives. Extra columns are not written.
    """
    rows = revisits(pages, min_bytes, key, url, payload)
    stamp = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    names = MANIFEST.names

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = file_system(folder)
        system.create_dir(place, recursive=True)
        out, done = None, []
        for batch in batches:
            for k, u, p, o in zip(*(c.to_pylist() if n != 2 else c for n, c in enumerate(batch.columns)), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, records, size = system.open_output_stream(f"{place}/{name}", None, BUFFER), 0, 0
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, b"")), ("WARC-Date", stamp)]
                    packed = member([*info, ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n")
                    out.write(packed)
                    size += len(packed)
                packed = page_record(k, u, p.as_py(), o, stamp)
                out.write(packed)
                records, size = records + 1, size + len(packed)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder.rstrip('/')}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder.rstrip('/')}/{name}", records, size))
        columns = list(zip(*done, strict=True)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return stored(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All page records of the archives of a manifest, read in sequence; columns of ``RECORD``.

    A task reads one archive or a few. Lengths and digests are those of the bytes read; a revisit gives
    those that it states. ``problem`` names what is wrong with a record: ``PAYLOAD_DIGEST`` or ``BLOCK_DIGEST``;
    what cannot be framed (``HEADER``, ``CONTENT_LENGTH``, ``TRUNCATED``, ``INFLATE``) ends its archive.
    Without ``payloads`` they are checked and left out. Empty manifest: no rows.
    """
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in RECORD.names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                system, place = file_system(archive)
                with system.open_input_stream(place, None, BUFFER) as stream:
                    for record in Archive(stream, payloads).records():
                        if record.get("record_type") == "warcinfo":
                            continue
                        if not payloads:
                            record.pop("payload", None)
                        rows.append({"archive": archive, **record})
                        size += len(record.get("payload") or b"")
                        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    archives = max(1, manifest.count())
    return manifest.select("archive").repartition(archives).mapInArrow(read, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with ``original``: key, length, digest and payload of the response that a revisit names.

    Rows that are no revisits, and revisits of no response read, have null. A revisit whose digest or
    length is not that of its response has the problem ``REVISIT``. Repeated responses of one id are
    equal, and count once. ``records`` must be a stored table: it is read twice, and so adaptive execution
    can split a response that very many rows revisit.
    """
    named = F.struct("key", "payload_bytes", "payload_digest", "payload")
    responses = records.filter("record_type = 'response' and problem is null and key is not null")
    wanted = records.filter("refers_to is not null").select(F.col("refers_to").alias("record_id")).distinct()
    originals = (
        responses.join(wanted, "record_id", "left_semi")
        .groupBy(F.col("record_id").alias("refers_to"))
        .agg(F.first(named).alias("original"))
    )
    found = records.join(stored(originals, "warc-responses"), "refers_to", "left")
    other = F.expr(
        "original.payload_digest <> payload_digest or original.payload_bytes <> payload_bytes"
    )
    return found.withColumn("problem", F.when(other & F.col("problem").isNull(), "REVISIT").otherwise(F.col("problem")))


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to archives and read back; a record with a problem stops the query."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    manifest = write_archives(pages, shared_folder(spark, "warc"))
    records = stored(read_archives(manifest, payloads=False), "warc-records")
    found = resolved(records)
    sound = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat_ws(" ", "problem", "archive", "offset"))
    )
    return found.select(
        F.col("key").cast(pages.schema["page_id"].dataType).alias("page_id"),
        F.coalesce("original.payload_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("original.payload_digest", "payload_digest").alias("payload_digest"),
        sound.alias("record_type"),
        F.col("original.key").cast(pages.schema["page_id"].dataType).alias("refers_to"),
    )


def sql() -> str:
    return f"""
with rows as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n from pages
), named as (
  select *, case when n >= {MIN_BYTES} then max(page_id) over (partition by html) end as last from rows
)
select page_id, cast(n as bigint) as payload_bytes, sha1(html) as payload_digest,
  case when page_id <> last then 'revisit' else 'response' end as record_type,
  case when page_id <> last then last end as refers_to
from named"""
