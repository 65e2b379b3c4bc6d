"""Web archives (WARC) written with their index first, and read by sorted, coalesced byte ranges.

Every task writes its rows as gzip members, one for each record, to archives of
its own below the given folder, and hands one index row per record to Spark:
archive, offset, length, key, url, digest. Readers start from the index: the
selected records are sorted by archive and offset, neighbours less than `GAP`
bytes apart in the same stretch of `READ_BYTES` become one range, and ranges are
dealt over the tasks, which read each with one request and cut the records out.

Payloads are compared by SHA-256 over all rows. Of equal ones, that of the largest
key becomes a response record with the payload, the others become revisit records
that refer to it. The table of repeated payloads is joined with the rows by
content: frequent contents are broadcast and their rows salted, so a payload that
a third of all rows hold is spread over tasks and stored once.

Archives are written through Arrow's file systems (local or mounted folders and
object stores). A task that runs again writes other files, and the index names
only those of the attempt that Spark committed.

Defined results: a null payload is an empty one; a null key comes before all
others and refers_to is null if the response has it; of rows alike in key and
payload that with the largest url (nulls first) is the response, and of rows alike in all three
one; a null url has no header, control characters and blanks in a url are
percent-encoded in the header and unchanged in the index; very long payloads are
records of their own range; an empty table gives no archive and no rows; other
columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stormgrid.llm.common import release_memory, slices, small_batches
from stormgrid.operators.ordered import attach_by_value
from stormgrid.session import materialize

#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
#: Bytes between records that are read along, length of the stretches that ranges keep to, bytes a reading task is dealt.
GAP, READ_BYTES, TASK_BYTES, MOST_TASKS = 64 << 10, 4 << 20, 16 << 20, 100_000
#: Records carry a date; the run has no clock of its own.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, offset bigint, length bigint, key string, url string, digest string, record_type string"


def name_of(key: object) -> str:
    return "urn:page-without-id" if key is None else f"urn:page:{quote(str(key), safe='')}"


def key_of(name: str) -> str | None:
    return None if name == "urn:page-without-id" else unquote(name.removeprefix("urn:page:"))


def record(key: str | None, url: str | None, digest: str, size: int, payload: bytes | None, refers_to: str | None, date: str = DATE) -> bytes:
    """One record: a response with its payload, or a revisit (payload None) with the HTTP head alone."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    kind = "response" if payload is not None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name_of(key)}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: quote(c[0], safe=""), url)))
    if payload is None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{name_of(refers_to)}>")]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n".encode() + "".join(f"{name}: {value}\r\n" for name, value in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, payload size by the HTTP head, and the payload that the record itself holds."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    headers = {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}
    block = rest[: int(headers["content-length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not one whole WARC record")
    http, payload = block.split(b"\r\n\r\n", 1)
    size = next(int(line[16:]) for line in http.decode().split("\r\n") if line.lower().startswith("content-length: "))
    return headers, size, payload


def base32_sha1(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _store(folder: str):
    """File system and folder for a path that may have a scheme."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", folder))


def typed(pages: DataFrame, key: str, url: str, payload: str, least: int = 0) -> DataFrame:
    """Rows to archive: key, url, size, sha1, whether the row is the response of its payload, refers_to and, for responses, the payload."""
    rows = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload")
    )
    rows = rows.withColumns({"content": F.sha2("payload", 256), "size": F.octet_length("payload").cast("bigint"), "sha1": F.sha1("payload")})
    narrow = rows.where(F.col("size") >= least).groupBy("content", "key", "url").agg(F.count("*").alias("same"))
    top = F.max(F.struct("key", "url", "same"))
    repeated = narrow.groupBy("content").agg(F.sum("same").alias("_n"), top.alias("top")).where("_n > 1")
    repeated = materialize(repeated.select("content", "_n", F.lit(True).alias("again"), F.col("top.key").alias("top_key"), F.col("top.url").alias("top_url"), F.col("top.same").alias("same")))
    found = attach_by_value(rows, repeated, "content")
    first = F.col("again").isNull() | (F.col("key").eqNullSafe(F.col("top_key")) & F.col("url").eqNullSafe(F.col("top_url")))
    found = found.withColumn("response", first)
    columns = [
        "key", "url", "size", "sha1", "response", F.when(~F.col("response"), F.col("top_key")).alias("refers_to"), F.when(F.col("response"), F.col("payload")).alias("payload")
    ]
    if repeated.where("same > 1").isEmpty():
        return found.select(*columns)
    # Rows alike in all three: one response, and as many revisits as are left.
    alike = F.col("response") & (F.col("same") > 1)
    merged = found.where(alike).groupBy("key", "url", "size", "sha1", "content").agg(F.first("payload").alias("payload"), F.count("*").alias("same"))
    single = merged.select(
        "key", "url", "size", "sha1", F.lit(True).alias("response"), F.lit(None).cast(rows.schema["key"].dataType).alias("refers_to"), "payload", "same"
    )
    others = single.drop("payload").withColumn("_i", F.explode(F.sequence(F.lit(2), F.col("same"))))
    revisits = others.select(
        "key", "url", "size", "sha1", F.lit(False).alias("response"), F.col("key").alias("refers_to"), F.lit(None).cast("binary").alias("payload")
    )
    return found.where(~F.coalesce(alike, F.lit(False))).select(*columns).unionByName(single.drop("same")).unionByName(revisits)


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> None:
    """Archives every row below `folder`, and the index beside them."""
    archives = f"{folder.rstrip('/')}/archives"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, below = _store(archives)
        stem, number, out, offset, name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, None, 0, ""
        try:
            for whole in batches:
                for batch in slices(whole, "payload"):
                    index: list[tuple] = []
                    for k, u, size, sha1, refers_to, content in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                        digest = base32_sha1(sha1)
                        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                        raw = squeeze.compress(record(k, u, digest, size, content, refers_to, date)) + squeeze.flush()
                        if out is not None and offset + len(raw) > archive_bytes:
                            out.close()
                            out = None
                        if out is None:
                            store.create_dir(below, recursive=True)
                            name, offset, number = f"{stem}-{number:04d}.warc.gz", 0, number + 1
                            out = store.open_output_stream(f"{below}/{name}", compression=None)
                        out.write(raw)
                        index.append((name, offset, len(raw), k, u, digest, "response" if content is not None else "revisit"))
                        offset += len(raw)
                    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
                    columns = list(zip(*index, strict=True)) or [[]] * len(types)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()
        release_memory()

    small_batches(pages.sparkSession)
    rows = typed(pages, key, url, payload, least).select(F.col("key").cast("string").alias("key"), "url", "size", "sha1", F.col("refers_to").cast("string").alias("refers_to"), "payload")
    # The last rows of an archive are on disk before its index rows are committed: the stream ends with the task.
    rows.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")


def ranges(index: DataFrame, gap: int = GAP, read_bytes: int = READ_BYTES) -> DataFrame:
    """Byte ranges that hold the given records: archive, start, stop, and offsets and lengths of the records in order."""
    within = Window.partitionBy("archive").orderBy("offset")
    end = F.lag(F.col("offset") + F.col("length")).over(within)
    apart = end.isNull() | (F.col("offset") - end > gap) | (F.floor(F.col("offset") / read_bytes) != F.floor(F.lag("offset").over(within) / read_bytes))
    numbered = index.withColumn("apart", apart.cast("int")).withColumn("range", F.sum("apart").over(within))
    placed = F.array_sort(F.collect_list(F.struct("offset", "length")))
    grouped = numbered.groupBy("archive", "range").agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"), placed.alias("records"))
    return grouped.select("archive", "start", "stop", F.col("records.offset").alias("offsets"), F.col("records.length").alias("lengths"))


def read(spark: SparkSession, folder: str, kind: str = "bigint", where: Column | None = None, with_payload: bool = False) -> DataFrame:
    """Records of the archives, all or those whose index row meets `where`: key, url, payload_bytes,
    payload_digest, record_type, refers_to and, if wanted, the payload that the record holds.

    The digest of every response is computed again from its payload.
    """
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    chosen = index if where is None else index.where(where)
    total = chosen.agg(F.sum("length")).first()[0] or 0
    archives = f"{folder.rstrip('/')}/archives"
    schema = "key string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string" + ", payload binary" * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, below = _store(archives)
        names = [f.split()[0] for f in schema.split(", ")]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()][: len(names)]
        for batch in batches:
            for archive, start, stop, offsets, lengths in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                with store.open_input_file(f"{below}/{archive}") as file:
                    stretch = file.read_at(stop - start, start)
                out = []
                for offset, length in zip(offsets, lengths, strict=True):
                    raw = zlib.decompress(stretch[offset - start : offset - start + length], 31)
                    headers, size, payload = parse(raw)
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    response = headers["warc-type"] == "response"
                    if response and (size != len(payload) or base32_sha1(hashlib.sha1(payload).hexdigest()) != digest):
                        raise ValueError(f"payload of the record at {offset} of {archive} does not have its digest")
                    refers_to = headers.get("warc-refers-to")
                    row = (
                        key_of(headers["warc-record-id"][1:-1]), headers.get("warc-target-uri"), size, digest, headers["warc-type"], refers_to and key_of(refers_to[1:-1]),
                    )
                    out.append(row + (payload if response else None,) * with_payload)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        release_memory()

    dealt = ranges(chosen).repartition(min(-(-total // TASK_BYTES) or 1, MOST_TASKS), "archive", "start")
    found = dealt.mapInArrow(run, schema)
    return found.withColumns({"key": F.col("key").cast(kind), "refers_to": F.col("refers_to").cast(kind)})
