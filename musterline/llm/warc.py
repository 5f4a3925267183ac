"""WARC archives with an index: written once, then read by sorted, coalesced byte ranges.

Every writing task makes one archive file below the shared folder, one gzip member per record, and
yields an index row per record: file, offset, length, URL, digest. The index is what counts: files of
a failed attempt are in no index and are never read. The reader takes index rows, sorts them by place,
reads neighbouring records in one request and parses each member.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from musterline.llm.text_hashing import slices
from musterline.operators.small_side import collect_if_small
from musterline.session import work_folder, written

#: Equal payloads of at least so many bytes are stored once.
REVISIT_FROM = 1000
#: Records at most so far apart are read in one request, of at most so many bytes.
GAP, REQUEST = 1 << 16, 8 << 20
#: Bytes of archives that a reading task takes.
PART = 8 << 20
_DATE = "2000-01-01T00:00:00Z"
_INDEX = "file string, offset long, length long, key long, url string, digest string, record_type string"


def _files(folder: str):
    """File system and path of a folder given as a path or URI."""
    if "://" in folder or folder.startswith("file:"):
        plain = folder if "://" in folder else "file://" + folder.removeprefix("file:")
        return fs.FileSystem.from_uri(plain)
    return fs.LocalFileSystem(), folder


def record_bytes(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has no payload and names the record that has it."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, payload, digest, refers_to) per row: which records hold their payload.

    Of rows with equal payloads of REVISIT_FROM bytes or more, that with the largest key holds it (among
    equal keys the one with the smallest URL), the others refer to it. Null html is an empty payload.
    Rows without a key always hold theirs.
    """
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    large = rows.where((F.col("size") >= REVISIT_FROM) & F.col("key").isNotNull())
    # Grouped by digest and size of the narrow columns only, combined on the map side.
    groups = large.groupBy("digest", "size").agg(F.max("key").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    small = collect_if_small(groups)
    joined = rows.join(F.broadcast(small) if small is not None else groups, ["digest", "size"], "left")
    refers = F.when(F.col("key") < F.col("holder"), F.col("holder"))
    return joined.select("key", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """The index of the records written below ``folder``; evaluated once and stored there."""

    def write(batches):
        system, path = _files(folder)
        system.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in slices(batches, "payload"):
            index = []
            for row in batch.to_pylist():
                data = record_bytes(row["key"], row["url"], row["payload"], row["digest"], row["refers_to"])
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(data) + packer.flush()
                out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                out.write(member)
                kind = "response" if row["refers_to"] is None else "revisit"
                index.append((name, at, len(member), row["key"], row["url"], row["digest"], kind))
                at += len(member)
            names = ["file", "offset", "length", "key", "url", "digest", "record_type"]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            # The rows of a batch go out before the file is closed; they count only if the task ends well.
            yield pa.record_batch([pa.array([r[i] for r in index], k) for i, k in enumerate(kinds)], names=names)
        if out:
            out.close()

    return written(records.mapInArrow(write, _INDEX), f"{folder}-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """(file, offset, fields, payload) of the records that ``index`` selects.

    Records are dealt out by place in parts of about PART bytes, whatever the number of archives. Repeated index
    rows give repeated records; an index without rows gives none.
    """
    size = index.agg(F.sum("length")).first()[0] or 0

    def read(batches):
        system, path = _files(folder)
        name, source = None, None

        def fetch(run):
            nonlocal name, source
            if run[0]["file"] != name:
                if source is not None:
                    source.close()
                name = run[0]["file"]
                source = system.open_input_file(f"{path}/{name}")
            start = run[0]["offset"]
            end = run[-1]["offset"] + run[-1]["length"]
            data = source.read_at(end - start, start)
            for r in run:
                raw = zlib.decompress(data[r["offset"] - start : r["offset"] - start + r["length"]], 31)
                fields, payload = parse_record(raw)
                yield r["file"], r["offset"], list(fields.items()), payload

        kinds = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]

        def packed(rows):
            return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["file", "offset", "fields", "payload"])

        for batch in batches:
            run, out, held = [], [], 0
            for row in batch.to_pylist():
                if run and (row["file"] != run[-1]["file"] or row["offset"] - run[-1]["offset"] - run[-1]["length"] > GAP or row["offset"] + row["length"] - run[0]["offset"] > REQUEST):
                    out += fetch(run)
                    run = []
                run.append(row)
                held += row["length"]
                if held > REQUEST:
                    out += fetch(run)
                    yield packed(out)
                    run, out, held = [], [], 0
            if run:
                out += fetch(run)
            yield packed(out)
        if source is not None:
            source.close()

    # Neighbours in a file come to one task, in order of their place.
    places = index.select("file", "offset", "length")
    parts = int(size) // PART + 1
    places = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return places.mapInArrow(read, "file string, offset long, fields map<string,string>, payload binary")


def archive_and_read(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` what its record says once read back; a revisit's payload size and digest are those of the full payload."""
    folder = work_folder(spark)
    index = write_archives(plan_records(pages), folder)
    records = read_archives(index, folder)

    def number(name: str):
        return F.regexp_extract(F.col("fields")[name], "<urn:page:(-?[0-9]+)>", 1).try_cast("long")

    holds = F.col("fields")["WARC-Type"] == "response"
    return records.select(
        number("WARC-Record-ID").alias("page_id"),
        F.col("fields")["X-Payload-Length"].cast("long").alias("payload_bytes"),
        # Of a response, the digest is taken anew from what was read.
        F.when(holds, F.sha1("payload")).otherwise(F.substring_index(F.col("fields")["WARC-Payload-Digest"], ":", -1)).alias("payload_digest"),
        F.col("fields")["WARC-Type"].alias("record_type"),
        F.when(~holds, number("WARC-Refers-To")).alias("refers_to"),
    )


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written as a record and read back; odd rows as in :func:`plan_records`."""
    return archive_and_read(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


#: DuckDB has no SHA-1 of a text's bytes but through sha1(); payloads are grouped by their text.
OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     n AS (SELECT page_id, html, octet_length(encode(html)) AS size FROM p),
     g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS holder FROM n)
SELECT page_id,
       CAST(size AS BIGINT) AS payload_bytes,
       sha1(html) AS payload_digest,
       CASE WHEN size >= 1000 AND page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id < holder THEN holder END AS refers_to
FROM g
"""
