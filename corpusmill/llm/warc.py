"""WARC archives with a two-level capture index.

Archives hold one gzip member for each record. The index has a line for each record, sorted by
reversed-host URL and page, cut into compressed blocks; a sparse directory keeps the first key
and the place of every block. A look-up searches the directory, reads one block by its range,
searches in it and gets the range of the record in its archive. Files are written below a
shared folder under names of their own; the rows that tell of them come from the task
attempt that Spark keeps, so an attempt that was lost leaves nothing but an unused file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import named
from ..session import scratch_path
from .common import saved, small_batches

BLOCK_LINES = 1000
MAX_BLOCKS = 100_000
READ_CHUNK = 32 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2020-01-01T00:00:00Z"
_BREAK = b"\r\n"


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """A file system and the folder's path in it, from a URI of any kind that Arrow knows."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(folder)


def surt(url: str | None) -> str:
    """The URL with its host reversed, ``com,example,www)/path?query``; its fragment is dropped."""
    rest = (url or "").partition("://")[2] or (url or "")
    rest = rest.partition("#")[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host = ",".join(reversed(rest[:cut].lower().split(".")))
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in f"{host}){rest[cut:] or '/'}")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headers(pairs: list[tuple[str, str]], first: str) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in pairs)]
    return _BREAK.join(line.encode("utf-8", "surrogatepass") for line in lines) + _BREAK * 2


def record(page: str | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: str | None) -> bytes:
    """A response with its payload, or without one a revisit of the page ``refers_to``.

    As the standard has it, a revisit keeps the HTTP header, with the length of the full payload.
    """
    http = _headers(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))], "HTTP/1.1 200 OK"
    )
    block = http + (payload or b"")
    clean = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    pairs = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{'' if page is None else page}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", clean),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        pairs += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
    return _headers(pairs, "WARC/1.1") + block + _BREAK * 2


def parse(data: bytes) -> dict:
    """Headers of a record, the HTTP headers of its block, and the payload."""

    def pairs(head: bytes) -> dict[str, str]:
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
        return {k: v for k, _, v in (line.partition(": ") for line in lines)}

    head, _, rest = data.partition(_BREAK * 2)
    warc = pairs(head)
    http, _, payload = rest[: int(warc["Content-Length"])].partition(_BREAK * 2)
    return {"warc": warc, "http": pairs(http), "payload": payload}


def _bare(identifier: str) -> str:
    return identifier.removeprefix("<urn:x-page:").removesuffix(">")


def record_kinds(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """(page, url, payload, size, sha, first): ``first`` is the response's page, for payloads of
    several pages only.

    Only payloads that occur again are looked up, so the join has one row for each on one side,
    and AQE splits the other where a payload is very frequent.
    """
    rows = pages.withColumn("sha", F.sha1(F.col("payload"))).withColumn("size", F.octet_length("payload"))
    again = saved(
        rows.where(F.col("size") >= min_revisit_bytes)
        .groupBy("sha")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("sha", "first"),
        "payloads-again",
    )
    return rows.join(again, "sha", "left").withColumn(
        "first", F.when(F.col("size") >= min_revisit_bytes, F.col("first"))
    )


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", min_revisit_bytes: int = 0
) -> DataFrame:
    """Write a record for each row below ``folder``; (url_key, page, file, at, length) of each.

    Of the rows with one payload of at least ``min_revisit_bytes`` bytes, those of the smallest
    id are responses and the others revisits. A null payload is empty, a null URL has the empty
    key; a null id is never the one referred to, and rows that have only null ids are responses.
    """
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    source = pages.select(
        named(key).alias("page"),
        named(url).cast("string").alias("url"),
        F.coalesce(named(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    kinds = record_kinds(source, min_revisit_bytes)
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    ready = kinds.select(
        F.col("page").cast("string").alias("page"),
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("first")).cast("string").alias("refers_to"),
        "sha",
        "size",
    )

    def write(batches):
        fs, path = _filesystem(folder)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in batches:
                if out is None and len(batch):
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                rows = []
                for r in batch.itertuples(index=False):
                    digest = base64.b32encode(bytes.fromhex(r.sha)).decode()
                    packer = zlib.compressobj(wbits=31)
                    plain = record(r.page, r.url, r.payload, digest, r.size, r.refers_to)
                    member = packer.compress(plain) + packer.flush()
                    out.write(member)
                    rows.append((surt(r.url), r.page or "", name, at, len(member)))
                    at += len(member)
                yield pd.DataFrame(rows, columns=["url_key", "page", "file", "at", "length"])
        finally:
            if out is not None:
                out.close()

    return saved(
        ready.mapInPandas(write, "url_key string, page string, file string, at bigint, length bigint"), "captures"
    )


def build_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted captures as compressed blocks; the directory (url_key, page, file, at, length).

    Blocks grow with the index, so that there are at most ``MAX_BLOCKS`` and one for each task.
    """
    lines_each = max(block_lines, -(-captures.count() // MAX_BLOCKS))

    def write(batches):
        fs, path = _filesystem(folder)
        name, at, out, lines = f"{uuid.uuid4().hex}.idx.gz", 0, None, []

        def flush():
            nonlocal at
            block = gzip.compress("\n".join("\t".join(line) for line in lines).encode("utf-8", "surrogatepass"))
            out.write(block)
            row = (*lines[0][:2], name, at, len(block))
            at += len(block)
            lines.clear()
            return pd.DataFrame([row], columns=["url_key", "page", "file", "at", "length"])

        try:
            for batch in batches:
                if out is None and len(batch):
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                for r in batch.itertuples(index=False):
                    lines.append((r.url_key, r.page, r.file, str(r.at), str(r.length)))
                    if len(lines) == lines_each:
                        yield flush()
            if lines:
                yield flush()
        finally:
            if out is not None:
                out.close()

    order = ["url_key", "page", "file", "at"]
    return saved(
        captures.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(write, "url_key string, page string, file string, at bigint, length bigint"),
        "index-directory",
    )


def look_up(wanted: DataFrame, directory: DataFrame, folder: str, parts: int | None = None) -> DataFrame:
    """(page, file, at, length) of the records of ``wanted`` (url_key, page); one row for each record.

    The directory is bounded by ``MAX_BLOCKS`` and goes to every task. Each block that has wanted
    keys is read once, by one task, and searched for each of them. ``parts`` tasks share the blocks;
    the rows that tell of them are small, so Spark would give them to too few.
    """
    blocks = sorted(tuple(r) for r in directory.select("url_key", "page", "file", "at", "length").collect())
    handed = wanted.sparkSession.sparkContext.broadcast(blocks)

    @F.pandas_udf("array<int>")
    def blocks_of(url_keys: pd.Series, pages: pd.Series) -> pd.Series:
        firsts = [b[:2] for b in handed.value]
        out = []
        for k in zip(url_keys, pages, strict=True):
            out.append(list(range(max(0, bisect_left(firsts, k) - 1), bisect_right(firsts, k))))
        return pd.Series(out, dtype=object)

    def search(batches):
        fs, path = _filesystem(folder)
        held, lines = None, []
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if r.block != held:
                    held = r.block
                    _, _, name, at, length = handed.value[held]
                    with fs.open_input_file(f"{path}/{name}") as f:
                        text = gzip.decompress(f.read_at(length, at)).decode("utf-8", "surrogatepass")
                    lines = [tuple(line.split("\t")) for line in text.split("\n")]
                at = bisect_left(lines, (r.url_key, r.page))
                while at < len(lines) and lines[at][:2] == (r.url_key, r.page):
                    rows.append((r.page, lines[at][2], int(lines[at][3]), int(lines[at][4])))
                    at += 1
            yield pd.DataFrame(rows, columns=["page", "file", "at", "length"])

    return (
        wanted.select("url_key", "page")
        .distinct()
        .select("url_key", "page", F.explode(blocks_of("url_key", "page")).alias("block"))
        .repartition(parts or max(1, len(blocks)), "block")
        .sortWithinPartitions("block", "url_key", "page")
        .mapInPandas(search, "page string, file string, at bigint, length bigint")
    )


def read_records(places: DataFrame, folder: str, parts: int | None = None) -> DataFrame:
    """(page, payload_bytes, payload_digest, record_type, refers_to, payload): the records at ``places``.

    Length and digest of a response are those of the payload that was read, and a digest that
    differs from the header's is an error. ``parts`` tasks share the archives in chunks and
    read each chunk in order.
    """

    def read(batches):
        fs, path = _filesystem(folder)
        held, file = None, None
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                if r.file != held:
                    if file is not None:
                        file.close()
                    held, file = r.file, fs.open_input_file(f"{path}/{r.file}")
                found = parse(gzip.decompress(file.read_at(r.length, r.at)))
                kind, said = found["warc"]["WARC-Type"], found["warc"]["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(found["http"]["Content-Length"])
                if kind == "response":
                    if (len(found["payload"]), digest_of(found["payload"])) != (size, said):
                        raise ValueError(f"damaged record at {r.at} in {r.file}")
                refers = found["warc"].get("WARC-Refers-To")
                rows.append(
                    (_bare(found["warc"]["WARC-Record-ID"]), size, said, kind, refers and _bare(refers), found["payload"])
                )
            yield pd.DataFrame(
                rows, columns=["page", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            )

    chunk = (F.col("at") / READ_CHUNK).cast("bigint")
    return (
        places.repartition(parts or places.sparkSession.sparkContext.defaultParallelism, "file", chunk)
        .sortWithinPartitions("file", "at")
        .mapInPandas(
            read,
            "page string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary",
        )
    )


def archive_round_trip(
    spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_revisit_bytes: int = 0
) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to): pages written, indexed, looked up
    by URL key and page, and read again. Repeated rows have a record each; an empty table gives an empty table."""
    small_batches(spark)
    folder = scratch_path(spark, "archives")
    captures = write_archives(pages, folder, key, url, html, min_revisit_bytes)
    directory = build_index(captures, folder)

    @F.pandas_udf("string")
    def url_key(urls: pd.Series) -> pd.Series:
        return urls.map(surt)

    wanted = pages.select(
        url_key(named(url).cast("string")).alias("url_key"), F.coalesce(named(key).cast("string"), F.lit("")).alias("page")
    )
    kind = pages.schema[key].dataType
    size = captures.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(spark.sparkContext.defaultParallelism, 4 * size // READ_CHUNK)
    found = read_records(look_up(wanted, directory, folder, parts), folder, parts)
    return found.select(
        F.when(F.col("page") != "", F.col("page")).cast(kind).alias(key),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
