"""WARC archives, index first.

Writing gives, next to the archives, an index with file, offset, length, url
and payload digest of every record; reading starts from the index: the rows
of the wanted records are sorted by file and offset, neighbouring byte ranges
are coalesced into one read, and the records are cut out of it.

Each record is its own gzip member, as ``.warc.gz`` files have it.  A payload
of at least ``REVISIT_BYTES`` bytes that several records share is stored once
(the largest id) and the others are ``revisit`` records without a payload.
Archives are written under a new name by each task attempt and count only
through the index, which Spark commits: what a lost executor left behind is
never read.

Defined results: null html is an empty payload; a null url is written as an
empty target; rows that repeat an id and a payload get the same record type;
a null id is smaller than any id; an empty table gives an empty index; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import c, join_spreading_hot, materialize, shuffle_width, text_of
from tidemark.session import scratch_path

#: shorter payloads are always stored
REVISIT_BYTES = 1000
#: a new archive begins beyond this size
ARCHIVE_BYTES = 1 << 30
#: ranges at most so far apart are read together, up to so many bytes
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
URN = "urn:x-page:"
INDEX = ("page_id long, url string, file string, offset long, length long, "
         "payload_bytes long, payload_digest string, record_type string, refers_to long")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _name(page_id) -> str:
    return f"<{URN}{'null' if page_id is None else page_id}>"


def _record(page_id, url: str, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}",
            "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
            "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
            f"X-Payload-Length: {len(payload)}", "Content-Type: application/http;msgtype=response"]
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {_name(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(root: str, date: str, limit: int):
    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(root)
        out, at, name = None, 0, ""
        try:
            for pdf in batches:
                rows = []
                for pid, url, html, digest, ref in zip(pdf["page_id"], pdf["url"], pdf["html"],
                                                       pdf["digest"], pdf["refers_to"]):
                    pid = None if pd.isna(pid) else int(pid)
                    ref = None if pd.isna(ref) else int(ref)
                    if out is None or at >= limit:
                        if out:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    payload = html.encode()
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = z.compress(_record(pid, url, payload, digest, ref, date)) + z.flush()
                    out.write(member)
                    rows.append((pid, url, f"{root}/{name}", at, len(member), len(payload), digest,
                                 "response" if ref is None else "revisit", ref))
                    at += len(member)
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in INDEX.split(", ")], dtype=object)
        finally:
            if out:
                out.close()
    return write


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", root: str | None = None,
                   date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row; returns the index (``INDEX``), stored as Parquet."""
    spark = pages.sparkSession
    root = root or scratch_path(spark, "warc")
    html = text_of(html_col).cast("binary")
    slim = materialize(pages.select(c(id_col).cast("long").alias("page_id"), F.sha1(html).alias("digest"),
                                    F.octet_length(html).cast("long").alias("size")), "warc_digests")
    # payloads that several records share; one pre-aggregated row for each
    shared = (slim.where(F.col("size") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    shared = materialize(shared, "warc_shared")
    revisits = (join_spreading_hot(slim, shared, "digest", "n", slim.count())
                .where(F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
                .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to").distinct())
    rows = pages.select(c(id_col).cast("long").alias("page_id"), text_of(url_col).alias("url"),
                        text_of(html_col).alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    rows = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_id"))
                     & (F.col("digest") == F.col("_digest")), "left").drop("_id", "_digest")
    # the archives' folder must exist before tasks write into it
    store, base = _store(root)
    store.create_dir(base, recursive=True)
    return materialize(rows.mapInPandas(_writer(root, date, archive_bytes), INDEX), "warc_index")


def _parse(member: bytes) -> tuple[dict[str, str], bytes]:
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _ranges(rows: Iterable[tuple], gap: int, most: int) -> Iterator[tuple[str, list[tuple]]]:
    """Group index rows sorted by (file, offset) into reads of neighbouring bytes."""
    run: list[tuple] = []
    for r in rows:
        if run and (r[0] != run[0][0] or r[1] - (run[-1][1] + run[-1][2]) > gap
                    or r[1] + r[2] - run[0][1] > most):
            yield run[0][0], run
            run = []
        run.append(r)
    if run:
        yield run[0][0], run


READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _reader(payloads: bool):
    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in batches:
                yield from zip(pdf["file"], pdf["offset"], pdf["length"])
        last, handle, got, size = None, None, [], 0

        def frame():
            return pd.DataFrame(got, columns=[x.split()[0] for x in READ.split(", ")], dtype=object)
        for file, run in _ranges(rows(), GAP_BYTES, READ_BYTES):
            if file != last:
                if handle:
                    handle.close()
                store, path = _store(file)
                last, handle = file, store.open_input_file(path)
            begin = run[0][1]
            block = handle.read_at(int(run[-1][1] + run[-1][2] - begin), int(begin))
            for _, offset, length in run:
                fields, payload = _parse(block[offset - begin:offset - begin + length])
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                ref = fields.get("WARC-Refers-To")
                if ref is None and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"damaged record at {file}:{offset}")
                pid, ref = (None if x in (None, "null") else int(x) for x in (
                    y and y[len(URN) + 1:-1] for y in (fields["WARC-Record-ID"], ref)))
                got.append((pid, fields["WARC-Target-URI"], payload if payloads and ref is None else None,
                            int(fields["X-Payload-Length"]), digest, fields["WARC-Type"], ref))
                size += len(payload)
            if size > READ_BYTES or len(got) >= 10_000:
                yield frame()
                got, size = [], 0
        if handle:
            handle.close()
        yield frame()
    return read


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Read the records that the rows of ``index`` name, checking each digest.

    Returns ``READ``; a revisit has no payload of its own.  Select from the
    index first (by url, digest, id): only those byte ranges are read.
    """
    places = index.select("file", "offset", "length")
    return (places.repartitionByRange(shuffle_width(index.sparkSession), "file", "offset")
            .sortWithinPartitions("file", "offset").mapInPandas(_reader(payloads), READ))
