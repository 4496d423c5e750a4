"""WARC archives of pages: writing with revisits, reading, and assembly of transactions.

A page becomes a request, a response and a metadata record; request and metadata name the response in WARC-Concurrent-To. Of
the pages with equal payloads of at least ``MIN_REVISIT`` bytes one is a response, the others are revisits that refer to it and
store no payload. Archives are gzip, one member per record, at most about ``ARCHIVE_BYTES`` each.

Reading streams an archive record by record, so memory is bounded by the longest record. Transaction assembly joins request,
response and metadata records through the concurrent-to identifiers, whichever side names the other, and emits one nested row
per capture. All that meets there by key is narrow or one row per key: what is attached to a capture is combined before the
shuffle, and the join of revisits with what they refer to is between stored tables, so Spark can split a hot one.

Task attempts write under names of their own, and the list of archives names those of the attempts that counted.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from hashlib import sha256
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagemill.llm.shared import BATCH_BYTES, file_system, new_folder, store, store_from_python
from passagemill.operators.relate import number_copies

MIN_REVISIT = 100
ARCHIVE_BYTES = 256 << 20
LEVEL = 4
_READ = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format

ARCHIVES = "path string, n_records long"
RECORDS = (
    "record_id string, type string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
    "payload_digest string, payload_bytes long, head string, payload binary"
)


def _uuid(key: str, kind: str) -> str:
    """The identifier of one of a transaction's records; ``key`` is hex."""
    return f"<urn:uuid:{uuid.UUID(bytes=sha256(f'{key} {kind}'.encode()).digest()[:16], version=5)}>"


def _record(kind: str, record_id: str, date: str, fields: dict[str, str | None], block: bytes) -> bytes:
    lines = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": date, **fields, "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _transaction(row: dict, date: str) -> Iterator[bytes]:
    """The records of a page: page_id, url, key, refers_key (null: a response), digest, size, payload."""
    own = _uuid(row["key"], "response")
    uri = None if row["url"] is None else quote(row["url"], safe="%/:=&?~#+!$,;'@()*[]") or None
    try:
        parts = urlsplit(uri or "")
        path = parts.path if parts.path.startswith("/") else f"/{parts.path}"
        host, path = parts.netloc, path + (f"?{parts.query}" if parts.query else "")
    except ValueError:  # not an address; it stays in the metadata as it is
        host, path = "", "/"
    told = {"WARC-Target-URI": uri}
    request = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    yield _record("request", _uuid(row["key"], "request"), date, told | {"WARC-Concurrent-To": own, "Content-Type": "application/http;msgtype=request"}, request)
    told |= {"Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha256:{row['digest']}"}
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    if row["refers_key"] is None:
        yield _record("response", own, date, told, head + row["payload"])
    else:
        told |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": _uuid(row["refers_key"], "response")}
        yield _record("revisit", own, date, told, head)
    known = {} if row["page_id"] is None else {"page-id": row["page_id"]}
    fields = "".join(f"{k}: {json.dumps(v)}\r\n" for k, v in (known | {"url": row["url"]}).items())
    yield _record(
        "metadata", _uuid(row["key"], "metadata"), date, {"WARC-Concurrent-To": own, "Content-Type": "application/warc-fields"}, fields.encode()
    )


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _write(folder: str, date: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        name, made, stream = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, None
        n_records, size = 0, 0

        def done() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}-{made:04d}.warc.gz"], "n_records": [n_records]})

        for batch in batches:
            for i in range(batch.num_rows):
                if stream is None:
                    files.create_dir(root, recursive=True)
                    stream = files.open_output_stream(f"{root}/{name}-{made:04d}.warc.gz", compression=None)
                    n_records, size = 0, 0
                for record in _transaction({c: batch[c][i].as_py() for c in batch.schema.names}, date):
                    size += stream.write(_member(record))
                    n_records += 1
                if size >= archive_bytes:
                    yield done()
                    made, stream = made + 1, None
        if stream is not None:
            yield done()

    return write


def write_archives(
    pages: DataFrame, min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None
) -> DataFrame:
    """Write WARC archives into the shared folder; returns the stored list of them: path, n_records.

    Needs page_id (long), url, html, whatever else there is. A null html is an empty payload, a null url has no target. Of equal
    payloads of ``min_revisit`` bytes and more the page with the smallest page_id is the response, ties go to the smaller url and
    then to one of the repeated rows; rows without page_id come last. Every row is a transaction of its own, repeated ones too.
    An archive is closed after the transaction that fills it. No pages: no archives.
    """
    spark = pages.sparkSession
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    page = page.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    spelled = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit("="), "url"), F.lit("-")), "digest")
    page = page.withColumn("row_key", F.sha2(spelled.cast("binary"), 256))

    seen = page.groupBy("row_key").agg(F.count("*").alias("n"), *(F.any_value(c).alias(c) for c in ("page_id", "url", "digest", "size")))
    seen = store(seen, "pages_seen")
    rank = F.struct(F.col("page_id").isNull(), "page_id", "url", "row_key")
    large = seen.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.sum("n").alias("n"), F.min(rank).alias("first"))
    firsts = store(large.where("n > 1").select("digest", F.col("first.row_key").alias("first_key")), "first_pages")
    repeated = store(seen.where("n > 1").select("row_key"), "repeated_pages")
    if repeated.isEmpty():
        page = page.withColumn("copy", F.lit(1).cast("long"))
    else:
        copies = number_copies(page.join(repeated, "row_key", "left_semi"))
        page = page.join(repeated, "row_key", "left_anti").withColumn("copy", F.lit(1).cast("long")).unionByName(copies)

    def key(row_key: str, copy) -> F.Column:
        return F.sha2(F.concat(row_key, F.lit(":"), copy).cast("binary"), 256)

    is_first = (F.col("row_key") == F.col("first_key")) & (F.col("copy") == 1)
    refers = F.when(F.col("first_key").isNotNull() & ~is_first, key("first_key", F.lit("1")))
    placed = page.join(firsts, "digest", "left").withColumn("refers_key", refers)
    kept = F.when(F.col("refers_key").isNull(), F.col("payload")).alias("payload")
    rows = placed.select("page_id", "url", key("row_key", F.col("copy").cast("string")).alias("key"), "refers_key", "digest", "size", kept)
    return store_from_python(rows.mapInArrow(_write(new_folder(spark, "warc"), date, archive_bytes), ARCHIVES), "archives")


class _Bytes:
    """The unpacked bytes of an archive: gzip members one after another, or plain."""

    def __init__(self, stream):
        self.stream, self.waiting, self.unpacker, self.have, self.plain = stream, b"", None, bytearray(), None

    def _more(self) -> bool:
        if not self.waiting:
            self.waiting = self.stream.read(_READ)
            if not self.waiting:
                if self.unpacker is not None:
                    raise ValueError("the archive ends inside a member")
                return False
        if self.plain is None:
            self.plain = not self.waiting.startswith(b"\x1f")
        if self.plain:
            self.have += self.waiting
            self.waiting = b""
            return True
        self.unpacker = self.unpacker or zlib.decompressobj(31)
        self.have += self.unpacker.decompress(self.unpacker.unconsumed_tail + self.waiting)
        self.waiting = self.unpacker.unused_data
        if self.unpacker.eof:
            self.unpacker = None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is taken too; None at the end of the archive."""
        start = 0
        while (at := self.have.find(mark, start)) < 0:
            start = max(0, len(self.have) - len(mark))
            if not self._more():
                if self.have.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        found = bytes(self.have[:at])
        del self.have[: at + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        found = bytes(self.have[:n])
        del self.have[:n]
        return found


def parse_archive(stream) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(header fields, names in lower case; block) of each record of an open archive."""
    source = _Bytes(stream)
    while (head := source.until(b"\r\n\r\n")) is not None:
        version, *lines = head.decode().lstrip("\r\n").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = [(k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines)]
        yield fields, source.take(int(dict(fields)["content-length"]))
        source.take(4)


def _row(fields: list[tuple[str, str]], block: bytes, payloads: bool) -> dict:
    """A record as a row. A response's digest is that of its payload as read; it must agree with the declared one."""
    named = dict(fields)
    kind, payload, digest, size = named["warc-type"], None, named.get("warc-payload-digest", "").partition(":")[2] or None, None
    head = block
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "response":
            found = sha256(payload).hexdigest()
            if digest not in (None, found):
                raise ValueError(f"the payload of {named['warc-record-id']} does not have its digest")
            digest = found
        else:
            lengths = [line.partition(b":")[2] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
            size, payload = (int(lengths[0]) if lengths else None), None
    return {
        "record_id": named["warc-record-id"], "type": kind, "target_uri": named.get("warc-target-uri"), "date": named.get("warc-date"),
        "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"], "refers_to": named.get("warc-refers-to"),
        "payload_digest": digest, "payload_bytes": size, "head": head.decode(errors="replace"), "payload": payload if payloads else None,
    }


_TYPES = {"array<string>": pa.list_(pa.string()), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in RECORDS.split(", "))])


def _read(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                files, name = file_system(path)
                rows, size = [], 0
                with files.open_input_stream(name, compression=None) as stream:
                    for fields, block in parse_archive(stream):
                        rows.append(_row(fields, block, payloads))
                        size += 512 + (len(block) if payloads else 0)
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return read


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives (column path), as :data:`RECORDS`; without ``payloads`` only their digests and lengths."""
    return archives.select("path").repartition(max(1, archives.count())).mapInArrow(_read(payloads), RECORDS)


def assemble_transactions(records: DataFrame) -> DataFrame:
    """One row per capture (response or revisit record): record_id, type, target_uri, date, refers_to, and the structs
    response (payload_digest, payload_bytes, head, payload), request and metadata (record_id, head), n_requests, n_metadata.

    ``records`` is read several times: hand in a stored table. Request and metadata are null where no such record is concurrent
    to the capture; of several, that with the smallest record_id is shown and all are counted. A record that several captures
    share is in each of them; one that no capture knows is in none. No records: no rows.
    """
    is_capture = F.col("type").isin("response", "revisit")
    captures, others = records.where(is_capture), records.where(F.col("type").isin("request", "metadata"))
    named = F.explode("concurrent_to")
    pairs = others.select(named.alias("capture_id"), "record_id").union(captures.select(F.col("record_id").alias("capture_id"), named.alias("record_id")))
    beside = others.select("record_id", "type", "head").join(pairs.distinct(), "record_id")
    shown = F.struct("record_id", "head")

    def of(kind: str):
        return F.min(F.when(F.col("type") == kind, shown)), F.count_if(F.col("type") == kind)

    (request, n_requests), (metadata, n_metadata) = of("request"), of("metadata")
    attached = beside.groupBy(F.col("capture_id").alias("record_id")).agg(
        request.alias("request"), metadata.alias("metadata"), n_requests.alias("n_requests"), n_metadata.alias("n_metadata")
    )
    response = F.struct("payload_digest", "payload_bytes", "head", "payload").alias("response")
    own = captures.select("record_id", "type", "target_uri", "date", "refers_to", response)
    return own.join(attached, "record_id", "left").na.fill(0, ["n_requests", "n_metadata"])


def page_captures(captures: DataFrame) -> DataFrame:
    """page_id, url (from the metadata), payload_bytes, payload_digest, record_type, refers_to: the page_id of a revisit's response.

    For captures written by :func:`write_archives`. A revisit whose response is missing has a null ``refers_to``.
    """
    field = lambda name: F.regexp_extract("metadata.head", rf"(?m)^{name}: (.*?)\r?$", 1)
    page_id = F.nullif(field("page-id"), F.lit("")).cast("long")
    url = F.from_json(F.concat(F.lit('{"u":'), field("url"), F.lit("}")), "u string")["u"]
    own = captures.select(
        "record_id", "refers_to", page_id.alias("page_id"), url.alias("url"), "response.payload_bytes", "response.payload_digest",
        F.col("type").alias("record_type"),
    )
    own = store(own, "page_captures")
    wanted = own.where("record_type = 'revisit'").select(F.col("refers_to").alias("record_id")).distinct()
    targets = own.where("record_type = 'response'").join(wanted, "record_id", "left_semi")
    targets = store(targets.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first_page")), "revisited")
    return own.join(targets, "refers_to", "left").select(
        "page_id", "url", "payload_bytes", "payload_digest", "record_type", F.col("first_page").alias("refers_to")
    )
