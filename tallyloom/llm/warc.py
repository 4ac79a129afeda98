"""WARC archives with a two-level capture index: compressed blocks of sorted keys below a sparse block directory."""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.common import stored
from tallyloom.llm.shared_files import Ranges, open_folder
from tallyloom.session import checkpointed, fresh_path

ENTRY = "key string, page_id long, uri string, archive string, offset long, length long"
BLOCK = "part int, block int, first string, last string, file string, offset long, length long, entries int"
CAPTURE = "uri string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, intact boolean"
MIME = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
DAY = "2000-01-01T00:00:00Z"  # pages carry no capture time


def url_key(url: str | None) -> str:
    """The sort key of a URL: host labels reversed, then path and query, without scheme, "www.", port 80/443 or fragment.

    Null and empty give an empty key; what does not parse as a URL is taken as a path.
    """
    url = url or ""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return ")" + url
    if not host:
        return ")" + url if url else ""
    host = re.sub(r"^www\d*\.", "", host)
    at = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + at + ")" + (parts.path or "/") + query


def _header_text(value: str) -> str:
    """No control character may end a header early; the percent sign is escaped along, so that this can be undone."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def _plain_text(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member with one record. A revisit has the headers of its payload, not the payload itself."""
    revisit = refers_to is not None
    block = MIME + f"Content-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{i}')}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DAY}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_text(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {name(refers_to)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse_record(data: bytes) -> dict:
    """The record in one gzip member; ``intact``: lengths fit, and a response's payload has the digest it names."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block = rest[:length]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = lines[0] == "WARC/1.1" and rest[length:] == b"\r\n\r\n"
    if not revisit:
        size, found = len(payload), hashlib.sha1(payload).hexdigest()
        whole, digest = whole and found == digest, found
    uri = fields.get("WARC-Target-URI")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "uri": None if uri is None else _plain_text(uri), "page_id": number("X-Page-ID"), "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page"), "payload": None if revisit else payload, "intact": whole,
    }


def _frame(rows: list[dict], columns: str) -> pd.DataFrame:
    """Columns of Python objects: a null must not turn integers into floats."""
    names = [c.strip().split()[0] for c in columns.split(",")]
    return pd.DataFrame({c: pd.Series([r[c] for r in rows], dtype=object) for c in names}, columns=names)


def _whole(value) -> int | None:
    return None if value is None or pd.isna(value) else int(value)


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> tuple[DataFrame, DataFrame]:
    """``page_id``, ``url``, ``html``, ``digest`` and ``refers_to``: of equal payloads the largest id is the response.

    Only digests and ids shuffle for the choice; each payload then finds the id it refers to by its digest.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    large = rows.filter(F.octet_length("html") >= least_bytes)
    copies = large.groupBy("digest").agg(F.max("page_id").alias("latest"), F.count("*").alias("n")).filter("n > 1")
    return rows, checkpointed(copies.select(F.col("digest").alias("twin"), "latest"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 1000, archive_bytes: int = 64 * 2**20, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Write every page as a WARC record below ``folder``; returns the index entries (key, page, archive, offset, length).

    Each task writes archives of about ``archive_bytes`` under names of its own, and the entries are stored before
    use: what an attempt that was lost has written is never referred to. Payloads do not shuffle unless more than
    ``broadcast_rows`` digests repeat.
    """
    rows, copies = mark_revisits(pages, id_col, url_col, html_col, least_bytes)
    few = copies.count() <= broadcast_rows
    twin = (F.col("digest") == F.col("twin")) & (F.octet_length("html") >= least_bytes)
    rows = rows.join(F.broadcast(copies) if few else copies, twin, "left")
    refers = F.when(F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest")), F.col("latest"))
    # Ids as strings: pandas would turn integers with nulls into floats.
    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "digest", refers.cast("string").alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        out, name, at, entries = None, "", 0, []
        for batch in batches:
            for page_id, url, html, digest, refers_to in batch.itertuples(index=False):
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                page_id = _whole(page_id)
                data = record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, _whole(refers_to))
                out.write(data)
                entries.append({"key": url_key(url), "page_id": page_id, "uri": url, "archive": name, "offset": at, "length": len(data)})
                at += len(data)
                if at >= archive_bytes:
                    out.close()
                    out = None
            if out is None or len(entries) >= 10_000:
                yield _frame(entries, ENTRY)
                entries = []
        if out is not None:
            out.close()
        if entries:
            yield _frame(entries, ENTRY)

    return stored(rows.mapInPandas(write, ENTRY), "captures")


def build_index(entries: DataFrame, folder: str, parts: int, block_entries: int = 3000) -> DataFrame:
    """Sort the entries by key and write them as compressed blocks; returns the directory, one row per block.

    Entries are range-partitioned by key, archive and offset, so a key with a third of all captures is spread over
    many parts. A part is one file of blocks; its number orders the parts.
    """
    ranged = entries.repartitionByRange(parts, "key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")
    ranged = ranged.withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        name, out, at, blocks, held, part = f"{uuid.uuid4().hex}.cdx", None, 0, [], [], 0

        def flush() -> None:
            nonlocal out, at, held
            if out is None:
                out = system.open_output_stream(f"{root}/{name}", compression=None)
            data = zlib.compress("\n".join(json.dumps(e, ensure_ascii=True) for e in held).encode())
            out.write(data)
            blocks.append({"part": part, "block": len(blocks), "first": held[0][0], "last": held[-1][0], "file": name, "offset": at, "length": len(data), "entries": len(held)})
            at, held = at + len(data), []

        for batch in batches:
            for key, page_id, uri, archive, offset, length, part in batch.itertuples(index=False):  # noqa: B007
                held.append([key, uri, archive, int(offset), int(length)])
                if len(held) >= block_entries:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
        yield _frame(blocks, BLOCK)

    return stored(ranged.mapInPandas(write, BLOCK), "directory")


def read_tasks(hits: DataFrame, task_bytes: int = 64 * 2**20) -> int:
    """Tasks for reading the found records, by their bytes: the entries are tiny, so adaptive execution would put all into one."""
    return max(1, -(-(hits.agg(F.sum("length")).first()[0] or 0) // task_bytes))


def lookup(spark: SparkSession, urls: DataFrame, directory: DataFrame, index_folder: str, archive_folder: str, url_col: str = "url", most_parts: int = 100_000) -> DataFrame:
    """All captures of the URLs in ``urls``: uri, page_id, payload_bytes, payload_digest, record_type, refers_to, payload, intact.

    URLs are compared by key, each distinct one once. The first level, the key bounds of each part (one row per
    part, refused beyond ``most_parts``), goes to every task: a binary search finds the parts a key lies in. A part
    then loads its own slice of the directory, binary-searches the blocks, and range-reads only those. Found
    entries are stored, dealt out by archive and offset to as many tasks as their records' bytes need, and each
    record is range-read and parsed.
    """
    parts = directory.groupBy("part").agg(F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last"))
    top = sorted((r["first"], r["last"], r["part"]) for r in parts.limit(most_parts + 1).collect())
    if len(top) > most_parts:
        raise ValueError(f"the index has more than {most_parts} parts; build it with fewer")
    firsts, lasts, numbers = [t[0] for t in top], [t[1] for t in top], [t[2] for t in top]

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url in batch["url"]:
                key = url_key(url)
                lo, hi = bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key)
                rows += [(key, numbers[i]) for i in range(lo, hi)]
            yield pd.DataFrame(rows, columns=["key", "part"])

    keys = urls.select(F.col(f"`{url_col}`").alias("url")).distinct().mapInPandas(locate, "key string, part int").distinct()
    # A part's directory rows come first in its stream, then the keys in order.
    blocks = directory.select("part", F.lit(0).alias("kind"), F.col("first").alias("key"), "block", "last", "file", "offset", "length")
    stream = blocks.unionByName(keys.select("part", F.lit(1).alias("kind"), "key"), allowMissingColumns=True)
    stream = stream.repartition("part").sortWithinPartitions("part", "kind", "key", "block")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Keys come sorted, so consecutive ones mostly lie in the block that is already open."""
        ranges, part, starts, ends, places, opened, inside, entries = Ranges(index_folder), None, [], [], [], None, [], []
        for batch in batches:
            rows = []
            for number, kind, key, _, last, file, offset, length in batch.itertuples(index=False):
                if number != part:
                    part, starts, ends, places, opened = number, [], [], [], None
                if kind == 0:
                    starts.append(key)
                    ends.append(last)
                    places.append((file, int(offset), int(length)))
                    continue
                for i in range(bisect.bisect_left(ends, key), bisect.bisect_right(starts, key)):
                    if opened != i:
                        raw = zlib.decompress(ranges.read(*places[i])).decode()
                        opened, entries = i, [json.loads(line) for line in raw.split("\n")]
                        inside = [e[0] for e in entries]
                    rows += [e[2:] for e in entries[bisect.bisect_left(inside, key) : bisect.bisect_right(inside, key)]]
            yield pd.DataFrame(rows, columns=["archive", "offset", "length"])
        ranges.close()

    hits = stored(stream.mapInPandas(search, "archive string, offset long, length long"), "hits")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranges = Ranges(archive_folder)
        for batch in batches:
            rows, size = [], 0
            for archive, offset, length in batch.itertuples(index=False):
                rows.append(parse_record(ranges.read(archive, int(offset), int(length))))
                size += len(rows[-1]["payload"] or b"")
                if size >= 32 * 2**20:
                    yield _frame(rows, CAPTURE)
                    rows, size = [], 0
            yield _frame(rows, CAPTURE)
        ranges.close()

    # 16 MB stretches of an archive stay together: neither an archive nor a popular key is one task.
    stretch = F.floor(F.col("offset") / (16 * 2**20))
    dealt = hits.repartition(read_tasks(hits), "archive", stretch).sortWithinPartitions("archive", "offset")
    return dealt.mapInPandas(read, CAPTURE)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 1000, parts: int | None = None) -> DataFrame:
    """Write ``pages`` as WARC archives with a capture index, then find and read every page's capture again.

    Payload is the html in UTF-8, null as empty. Of records with equal payloads of ``least_bytes`` or more the one
    with the largest page id is a response, the others are revisits of it; rows that repeat that id are responses
    too, and a null id is smaller than any other. Smaller payloads are always responses. A null URL has an empty
    key and no target header. Rows that are equal are written and read once each. Columns other than the three
    are not read; an empty table gives no rows.
    """
    spark = pages.sparkSession
    archives, index = fresh_path(spark, "warc"), fresh_path(spark, "cdx")
    entries = write_archives(pages, archives, id_col, url_col, html_col, least_bytes)
    width = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // 1_000_000))
    directory = build_index(entries, index, width)
    return lookup(spark, pages, directory, index, archives, url_col)
