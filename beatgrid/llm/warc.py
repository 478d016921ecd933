"""WARC archives: writing, normalising monolithic gzip files, reading by offset index.

An archive is first written as one gzip stream, as many crawlers leave it. The normaliser inflates
such a file once, front to back, rewrites every record as a gzip member of its own and writes a
sidecar index (one JSON line a record: offset, length, type, record id, target), so that readers can
seek. Pages of equal payload are stored once; the others are revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.llm.common import join_unique, pieces
from beatgrid.llm.store import random_access, read_stream, written
from beatgrid.sources.files import materialised, scratch_path

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 31  # zlib's window setting for a gzip wrapper

DATE = "1970-01-01T00:00:00Z"  # pages carry no crawl time; a constant keeps files repeatable
CHUNK = 1 << 20
MANIFEST = "path string, n_records bigint, n_bytes bigint"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    name = uri.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def _block(fields: dict[str, str]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record; a revisit has the HTTP head only, which states the payload's length."""
    http = b"HTTP/1.1 200 OK\r\n" + _block({"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))})
    body = http + payload if kind == "response" else http
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or "", safe="%!#$&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(body)),
    }
    if kind == "revisit":
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to)}
    return VERSION + b"\r\n" + _block(fields) + body + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    """Fields of a record or HTTP head, names in lower case."""
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def with_kinds(pages: DataFrame, ident: str, url: str, html: str, least: int) -> DataFrame:
    """(ident, url, payload, digest, kind, refers_to) of each page."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(ident).cast("bigint").alias("ident"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    copies = (
        rows.filter(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("ident").alias("keep"), F.count("*").alias("n"))
        .filter("n > 1 and keep is not null")
    )
    joined = join_unique(rows, materialised(copies, "copies"), "digest", "n")
    revisit = F.col("keep").isNotNull() & ~F.col("ident").eqNullSafe(F.col("keep"))
    return joined.select(
        "ident", "url", "payload", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("keep")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    ident: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 1000,
    level: int = 4,
    archive_bytes: int = 512_000_000,
) -> DataFrame:
    """Write all pages as monolithic gzip archives; returns the staged manifest.

    The id column is an integer; the payload is the page in UTF-8, null as empty. Of pages with
    equal payloads (equal SHA-1) of at least ``least`` bytes the one with the largest id is a
    response and the others revisit it; repeated rows of that id are all responses, pages without
    an id refer to it as well, and a group without any id is all responses. An empty table writes
    no archive. A new archive begins after ``archive_bytes`` of payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        waiting = (row for batch in batches for piece in pieces(batch, 2) for row in zip(*(c.to_pylist() for c in piece.columns)))
        row = next(waiting, None)
        while row is not None:
            uri = f"{folder}/part-{part:06d}-{number:04d}.warc.gz"
            n = held = size = 0
            with written(uri) as out:
                gz = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                while row is not None and held < archive_bytes:
                    data = gz.compress(record(*row))
                    n, held, size = n + 1, held + len(row[2]), size + len(data)
                    out.write(data)
                    row = next(waiting, None)
                data = gz.flush()
                out.write(data)
            yield pa.RecordBatch.from_pydict({"path": [uri], "n_records": [n], "n_bytes": [size + len(data)]})
            number += 1

    return materialised(with_kinds(pages, ident, url, html, least).mapInArrow(run, MANIFEST), "archives")


class _Inflated:
    """The content of a gzip file of one or more members, read forward with bounded memory."""

    def __init__(self, source):
        self.source, self.gz = source, zlib.decompressobj(GZIP)
        self.begun = self.ended = False
        self.held = bytearray()

    def _raw(self) -> bytes:
        """The next compressed bytes; empty at the end of the file. Zeros between members are padding."""
        raw = self.gz.unconsumed_tail
        if self.gz.eof:  # what follows the member is in unused_data, whatever the tail holds
            raw, self.gz, self.begun = self.gz.unused_data.lstrip(b"\0"), zlib.decompressobj(GZIP), False
        while not raw and not self.ended:
            raw = self.source.read(CHUNK)
            self.ended = not raw
            if not self.begun:
                raw = raw.lstrip(b"\0")
        return raw

    def _more(self) -> bool:
        while True:
            raw = self._raw()
            if not raw and not self.begun:
                return False
            self.begun = True
            data = self.gz.decompress(raw, CHUNK)
            if data:
                self.held += data
                return True
            if not raw and not self.gz.eof:
                raise ValueError("an archive ends within a member")

    def head(self) -> bytes | None:
        """Up to the next empty line, or None at the end."""
        at = 0
        while (end := self.held.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(self.held) - 3)
            if not self._more():
                if self.held.strip():
                    raise ValueError("an archive ends within a record")
                return None
        head = bytes(self.held[: end + 4])
        del self.held[: end + 4]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise ValueError("an archive ends within a record")
            part = bytes(self.held[:n])
            del self.held[: len(part)]
            n -= len(part)
            yield part


def normalise_file(source: str, target: str, level: int = 4) -> tuple[int, int]:
    """Rewrite one archive record by record and write ``target`` + .idx; gives records and bytes."""
    offset = n = 0
    with written(target) as out, written(target + ".idx") as index:
        stream = _Inflated(read_stream(source))
        while (head := stream.head()) is not None:
            fields = parse_head(head)
            gz, size = zlib.compressobj(level, zlib.DEFLATED, GZIP), 0
            for part in itertools.chain([head], stream.take(int(fields["content-length"]) + 4), [None]):
                data = gz.flush() if part is None else gz.compress(part)
                out.write(data)
                size += len(data)
            line = {"offset": offset, "length": size, "type": fields["warc-type"], "id": fields["warc-record-id"], "target": fields["warc-target-uri"]}
            index.write(json.dumps(line).encode() + b"\n")
            offset, n = offset + size, n + 1
    return n, offset


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Normalise every archive of a manifest into ``folder``; returns the staged manifest of the new ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                target = f"{folder}/{uri.rpartition('/')[2]}"
                n, size = normalise_file(uri, target)
                yield pa.RecordBatch.from_pydict({"path": [target], "n_records": [n], "n_bytes": [size]})

    files = manifest.select("path").repartition(max(1, min(manifest.count(), 8192)))
    return materialised(files.mapInArrow(run, MANIFEST), "normalised")


def read_archives(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each record, by the index."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def rows(uri: str) -> Iterator[tuple]:
        with random_access(uri) as source, random_access(uri + ".idx") as index:
            for line in _lines(index):
                entry = json.loads(line)
                raw = zlib.decompress(source.read_at(entry["length"], entry["offset"]), GZIP)
                head, _, rest = raw.partition(b"\r\n\r\n")
                fields = parse_head(head)
                http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
                stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                if fields["warc-type"] == "response":
                    if hashlib.sha1(payload).hexdigest() != stated:
                        raise ValueError(f"a payload of {uri} differs from its digest")
                    size, refers = len(payload), None
                else:
                    size, refers = int(parse_head(http)["content-length"]), page_of(fields["warc-refers-to"])
                yield page_of(fields["warc-record-id"]), size, stated, fields["warc-type"], refers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held: list[tuple] = []
                for row in rows(uri):
                    held.append(row)
                    if len(held) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)

    files = manifest.select("path").repartition(max(1, min(manifest.count(), 8192)))
    return files.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def _lines(source) -> Iterator[bytes]:
    held = b""
    while part := source.read(CHUNK):
        *lines, held = (held + part).split(b"\n")
        yield from lines
    if held:
        yield held


def archive_pages(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write, normalise and read back: one row a page."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(normalise(write_archives(pages, f"{folder}/monolithic", **options), f"{folder}/records"))
