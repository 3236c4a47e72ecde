"""WARC: archives that are one gzip stream each are rewritten with a member per record, and indexed.

A file compressed as a whole can only be read from its start. ``normalise`` inflates each such stream once,
front to back and in bounded memory, compresses every record as a member of its own and notes the members'
offsets in a sidecar (one line of JSON per record) and in the index rows it returns; ``read_records`` then
seeks to any record. Archives that already have several members, or one per record, pass the same way.

Defined results: an empty input gives no archive and no index row; a null payload is empty, a null url or page
id leaves its header out; line breaks and blanks in a url are percent-encoded; payloads of any length are
copied in chunks. Rows that repeat a page id with an equal payload have the same role. Other columns of the
pages are ignored. An archive that ends inside a record is an error, or with ``strict=False`` one index row of
type ``truncated`` without an offset.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import materialized, open_in, open_out

CHUNK = 1 << 20
GZIP = 31  # zlib's window bits for a gzip member
INDEX = (
    "file string, record_offset long, record_length long, record_id string, warc_type string, "
    "target_uri string, headers map<string,string>"
)
RECORD = INDEX + ", payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


# ---- roles -------------------------------------------------------------------------------------------------


def with_roles(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, digest, record_type, refers_to: who is the response among equal payloads.

    Only digests that occur more than once are joined back. A digest that a third of all pages have is reduced
    by partial aggregates, and the join's other side has one row per digest. That side is written first, so that
    Spark knows its size: payloads are shuffled only where it is too large to be broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = F.length("payload") >= min_bytes
    firsts = materialized(
        rows.filter(large)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    again = large & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(firsts, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
    )


# ---- writing -----------------------------------------------------------------------------------------------


def _urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'page:{page_id}'.encode()).digest())}>"


def _uri(url: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record_head(page_id: int | None, url: str | None, size: int, digest: str, kind: str, first: int | None) -> bytes:
    """The WARC and HTTP headers of a page's record; a revisit names its full payload's size and digest."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(first)}", f"X-Refers-To-Page-ID: {first}"]
    body = len(http) + (size if kind != "revisit" else 0)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {body}", "", ""]
    return "\r\n".join(head).encode() + http


def write_monolithic(rows: DataFrame, folder: str, max_bytes: int = 64 << 20) -> DataFrame:
    """Archives that are one gzip stream each, of about ``max_bytes`` compressed; returns their paths.

    Lazy: the tasks of whatever reads the paths write the files. A file has a name of its own for each attempt,
    so what a lost task leaves behind is in no result.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = squeeze = path = None
        for batch in batches:
            for page_id, url, payload, digest, kind, first in batch.itertuples(index=False, name=None):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, squeeze = open_out(path), zlib.compressobj(1, zlib.DEFLATED, GZIP)
                page_id, first = (int(x) if isinstance(x, str) else None for x in (page_id, first))
                url = url if isinstance(url, str) else None
                out.write(squeeze.compress(record_head(page_id, url, len(payload), digest, kind, first)))
                if kind != "revisit":
                    out.write(squeeze.compress(payload))
                out.write(squeeze.compress(b"\r\n\r\n"))
                if out.tell() >= max_bytes:
                    out.write(squeeze.flush())
                    out.close()
                    yield pd.DataFrame({"file": [path]})
                    out = None
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield pd.DataFrame({"file": [path]})

    # As text: pandas would make floats of numbers among which is a null, and floats do not hold all of them.
    page_id, first = (F.col(name).cast("string") for name in ("page_id", "refers_to"))
    return rows.select(page_id, "url", "payload", "digest", "record_type", first).mapInPandas(
        write, "file string"
    )


# ---- the normaliser ----------------------------------------------------------------------------------------


class Inflated:
    """The bytes of a gzip file of one or more members, read forward with a bounded buffer."""

    def __init__(self, source) -> None:
        self.source, self.stream, self.buffer, self.ended = source, zlib.decompressobj(GZIP), b"", False
        self.rest, self.started = b"", False

    def _more(self) -> bool:
        """One more chunk into the buffer; False at the end."""
        while not self.ended:
            if self.stream.eof:
                self.rest = self.stream.unused_data or self.rest
                self.stream, self.started = zlib.decompressobj(GZIP), False
            data = self.rest or self.source.read(CHUNK)
            if not data:
                self.ended = True
                if self.started:
                    raise EOFError("the gzip stream ends early")
                return False
            self.started = True
            got = self.stream.decompress(data, CHUNK)
            self.rest = self.stream.unconsumed_tail
            if got:
                self.buffer += got
                return True
        return False

    def line(self) -> bytes:
        """Up to and with the next line feed; what is left at the end."""
        while (at := self.buffer.find(b"\n")) < 0 and self._more():
            pass
        cut = at + 1 if at >= 0 else len(self.buffer)
        got, self.buffer = self.buffer[:cut], self.buffer[cut:]
        return got

    def chunks(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self._more():
                raise EOFError("the record ends early")
            got, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(got)
            yield got


def next_head(stream: Inflated) -> tuple[bytes, dict[str, str]] | None:
    """The next record's header block as it stands, and its fields; None at the end of the archive."""
    line = stream.line()
    while line in (b"\r\n", b"\n"):
        line = stream.line()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record starts with {line[:40]!r}")
    raw, fields, last = [line], {}, ""
    while (line := stream.line()) not in (b"\r\n", b"\n"):
        if not line:
            raise EOFError("the header ends early")
        raw.append(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[0] in " \t" and last:
            fields[last] += " " + text.strip()
        else:
            last, _, value = text.partition(":")
            last = last.strip().lower()
            fields[last] = value.strip()
    return b"".join([*raw, b"\r\n"]), fields


def normalise(files: DataFrame, folder: str, level: int = 6, strict: bool = True) -> DataFrame:
    """Rewrite each archive of ``files`` with one gzip member per record; returns the index rows (INDEX).

    An archive is a sequence of its own, so the unit of work is a file. Each output has its index beside it as
    ``.idx``. Lazy, and safe to run again, as ``write_monolithic``.
    """

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for source in (x for batch in batches for x in batch["file"]):
            path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
            rows = []
            with open_in(source) as archive, open_out(path) as out, open_out(f"{path}.idx") as side:
                stream = Inflated(archive)
                while True:
                    at = out.tell()
                    try:
                        if (head := next_head(stream)) is None:
                            break
                        raw, fields = head
                        squeeze = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                        out.write(squeeze.compress(raw))
                        for piece in stream.chunks(int(fields["content-length"])):
                            out.write(squeeze.compress(piece))
                        out.write(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
                    except EOFError as error:
                        if strict:
                            raise ValueError(f"{source}: {error}") from error
                        rows.append((path, None, None, None, "truncated", None, {}))
                        break
                    row = (path, at, out.tell() - at, fields.get("warc-record-id"), fields.get("warc-type"))
                    row += (fields.get("warc-target-uri"), fields)
                    side.write(json.dumps([row[1], row[2], *row[3:6]]).encode() + b"\n")
                    rows.append(row)
                    if len(rows) >= 1000:
                        yield pd.DataFrame(rows, columns=COLUMNS)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=COLUMNS).astype({"record_offset": "Int64", "record_length": "Int64"})

    return files.select("file").mapInPandas(rewrite, INDEX)


COLUMNS = ["file", "record_offset", "record_length", "record_id", "warc_type", "target_uri", "headers"]


def read_records(index: DataFrame) -> DataFrame:
    """Each indexed record by its offset: the index row, the HTTP fields among ``headers`` with an ``http-``
    before their names, and the payload (null for a revisit, which has none)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, archive = None, None
        for batch in batches:
            done, size = [], 0
            for row in batch.itertuples(index=False, name=None):
                if row[0] != name:
                    if archive is not None:
                        archive.close()
                    name, archive = row[0], open_in(row[0])
                archive.seek(int(row[1]))
                data = zlib.decompress(archive.read(int(row[2])), GZIP)
                _, _, body = data.partition(b"\r\n\r\n")
                fields = dict(row[6])
                body = body[: int(fields["content-length"])]
                if fields.get("content-type", "").startswith("application/http"):
                    http, _, body = body.partition(b"\r\n\r\n")
                    for line in http.decode("utf-8", "replace").split("\r\n")[1:]:
                        key, _, value = line.partition(":")
                        fields["http-" + key.strip().lower()] = value.strip()
                done.append((*row[:6], fields, None if row[4] == "revisit" else body))
                size += len(body)
                if size > 16 * CHUNK:
                    yield pd.DataFrame(done, columns=[*COLUMNS, "payload"])
                    done, size = [], 0
            if done:
                yield pd.DataFrame(done, columns=[*COLUMNS, "payload"])
        if archive is not None:
            archive.close()

    return index.filter("record_offset is not null").select(*COLUMNS).mapInPandas(read, RECORD)


def page_view(records: DataFrame) -> DataFrame:
    """The digest columns of archived pages: what a response holds is measured anew, a revisit's is as stated."""

    def field(name: str) -> Column:
        return F.element_at("headers", F.lit(name))

    stated = F.substring_index(field("warc-payload-digest"), ":", -1)
    return records.select(
        field("x-page-id").cast("long").alias("page_id"),
        F.coalesce(F.length("payload"), field("http-content-length")).cast("long").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), stated).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        field("x-refers-to-page-id").cast("long").alias("refers_to"),
        "target_uri",
        "record_offset",
        "record_length",
    )
