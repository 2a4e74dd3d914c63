"""WARC archives: written once with an index, read back by coalesced byte ranges.

Every partition writes one gzip-per-record archive to the shared folder and returns an index row
(file, offset, length, URL, digest) for each record; a retried task writes another file, and only the
files of tasks that ended well are in the index. Reading takes any selection of the index, sorts it by
file and offset, joins neighbouring ranges into one read, and cuts the records from it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grafloom.llm.common import bare, scratch_path

#: One read covers ranges at most so far apart, and at most so many bytes unless one record is longer.
GAP_BYTES, RANGE_BYTES = 64 * 1024, 4 * 1024 * 1024
#: Rows are handed on when so many payload bytes are held.
HELD_BYTES = 8 * 1024 * 1024
INDEX = "file string, offset long, length long, url string, digest string, record_type string"
RECORDS = "source_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"
CRLF = b"\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(row_id: str | None, digest: str) -> str:
    """A record's id: the row's id, whatever its characters, and the payload's digest; that of a null id has another beginning."""
    return f"<urn:x-row-without-id:{digest}>" if row_id is None else f"<urn:x-row:{quote(row_id, safe='')}:{digest}>"


def _row_id(name: str | None) -> str | None:
    return unquote(name.removeprefix("<urn:x-row:").rpartition(":")[0]) if name and name.startswith("<urn:x-row:") else None


def record(source_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A `response` record, or a `revisit` of `refers_to`, as one gzip member."""
    digest = base32_sha1(payload)
    head = [f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode(), b"" if refers_to is not None else payload]
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _name(source_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", None if refers_to is None else _name(refers_to, digest)),
        ("WARC-Profile", None if refers_to is None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(sum(map(len, head)))),
    ]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None)
    return gzip.compress(b"WARC/1.1\r\n" + lines + CRLF + b"".join(head) + CRLF + CRLF, compresslevel=6, mtime=0)


def parse(raw: bytes) -> dict:
    """The record's type, ids, digest and payload. Raises ValueError if lengths or the payload's digest don't hold."""
    data = gzip.decompress(raw)
    head, _, block = data.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    if not lines[0].startswith("WARC/") or len(block) != int(fields["Content-Length"]) + 4:
        raise ValueError("not a whole WARC record")
    http, _, payload = block[:-4].partition(CRLF + CRLF)
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError("the payload doesn't match its digest")
    return {"source_id": _row_id(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "refers_to": _row_id(fields.get("WARC-Refers-To")), "payload_digest": digest, "payload_bytes": length, "payload": None if revisit else payload}


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes archives into the folder `path` and its index to `path`/index; returns the index.

    A null html is an empty payload. Of rows with equal payloads of at least `least_bytes` bytes the
    one with the largest id is a response and the others are revisits of it; shorter payloads are all
    responses. Rows that repeat the largest id are all responses, as no record refers to its own id. Ids may be
    any text, payloads any length. A null id counts as the smallest; if all ids of a
    payload are null, all are responses. An empty table gives an empty index. Further columns are not looked at.
    """
    rows = bare(pages, id_col, url_col, html_col).toDF("id", "url", "html").select("id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha1", F.sha1("html"))
    slim = rows.where(F.octet_length("html") >= least_bytes).select("id", "sha1")
    kept = slim.groupBy("sha1").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1 and keep is not null").select("sha1", "keep")
    revisits = slim.join(kept, "sha1").where("id is null or id < keep").select(F.col("id").alias("id_"), F.col("sha1").alias("sha1_"), "keep").distinct()
    # by id and digest: copies of one payload, however many, are dealt to all tasks
    rows = rows.join(revisits, F.col("id").eqNullSafe(F.col("id_")) & (F.col("sha1") == F.col("sha1_")), "left")
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "html", F.col("keep").cast("string").alias("keep"))
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        out, name, offset = None, f"{uuid.uuid4().hex}.warc.gz", 0
        try:
            for b in batches:
                index = []
                for source_id, url, html, keep in b.itertuples(index=False):
                    out = out or store.open_output_stream(f"{folder}/{name}", compression=None)
                    payload = html.encode()
                    raw = record(source_id, url, payload, keep, date)
                    out.write(raw)
                    index.append((f"{path}/{name}", offset, len(raw), url, base32_sha1(payload), "response" if keep is None else "revisit"))
                    offset += len(raw)
                yield pd.DataFrame(index, columns=["file", "offset", "length", "url", "digest", "record_type"])
        finally:
            if out:
                out.close()

    rows.mapInPandas(put, INDEX).write.parquet(f"{path}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{path}/index")


def ranges(found: Iterator[tuple], gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> Iterator[tuple[str, int, int, list]]:
    """(file, first byte, end, entries) of joint reads for (file, offset, length, ...) entries sorted by file and offset."""
    file, first, end, held = None, 0, 0, []
    for x in found:
        if held and (x[0] != file or x[1] > end + gap or x[1] + x[2] - first > most):
            yield file, first, end, held
            held = []
        if not held:
            file, first, end = x[0], x[1], x[1]
        held.append(x)
        end = max(end, x[1] + x[2])
    if held:
        yield file, first, end, held


def read(index: DataFrame) -> DataFrame:
    """The records of the index's rows: id and refers_to as text, URL, type, digest and length of the full payload, payload (null: revisit)."""

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, held, size, opened = [x.split()[0] for x in RECORDS.split(", ")], [], 0, (None, None)
        entries = (x for b in batches for x in b.itertuples(index=False, name=None))
        for file, first, end, wanted in ranges(entries):
            if opened[0] != file:
                store, at = fs.FileSystem.from_uri(file)
                opened = (file, store.open_input_file(at))
            data = opened[1].read_at(end - first, first)
            for _, offset, length, url in wanted:
                x = parse(data[offset - first : offset - first + length])
                held.append(x | {"url": url})
                size += len(x["payload"] or b"")
                if size >= HELD_BYTES:
                    yield pd.DataFrame(held, columns=names)
                    held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=names)

    return index.select("file", "offset", "length", "url").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInPandas(get, RECORDS)


def round_trip(pages: DataFrame, path: str | None = None, id_col: str = "page_id", **kw) -> DataFrame:
    """Writes archives of all rows and reads all records back, with id and refers_to in the id's own type."""
    path, kind = path or scratch_path(pages.sparkSession, "warc"), bare(pages, id_col).schema[0].dataType
    records = read(write(pages, path, id_col, **kw))
    return records.select(F.col("source_id").cast(kind).alias(id_col), "url", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "payload")
