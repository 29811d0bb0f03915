"""WARC files with payload deduplication, and a two-level capture index over them.

Records are one gzip member each.  The index sorts captures by (reversed-host URL key,
page_id) into shards; a shard holds compressed blocks of captures and, at its end, a sparse
directory with the first key of each block.  A lookup finds the shard and then the block by
binary search, reads that one block, searches it, and range-reads only the records it wants.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, shared_folder, stored
from .store import Ranges, new_file

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK_LINES = 1000
TAIL = "<8sQQ"  # magic, directory offset, directory length
MAGIC = b"CAPTIDX1"
MEMBERS = "shard int, url string, page_id long, file string, offset long, length long"
RECORD = (
    "url string, page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then the rest; no scheme, user, port, leading
    www or fragment; in visible ASCII.  A null or unreadable URL sorts by its escaped text."""
    text = quote((url or "").strip(), safe="%/:?#[]@!$&'()*+,;=~-._")
    try:
        parts = urlsplit(text)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return ")" + text
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + rest


def payload_groups(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Pages with their payload (null: empty) and ``first_id``, the smallest page_id of the
    same payload; null where the payload is below ``least_bytes``.

    Payloads are grouped by digest with a map-side reduced count, and only digests of two
    pages or more are joined back, so a hot payload meets one row.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    several = stored(
        rows.where(F.length("payload") >= least_bytes).groupBy("sha1").agg(
            F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")
        ).where("n > 1").drop("n"), "payloads",
    )
    return rows.join(several, "sha1", "left")


def record(page_id: int | None, url: str | None, payload: bytes, first_id: int | None) -> bytes:
    """One WARC record; a revisit holds the HTTP header without the payload."""
    revisit = first_id is not None and page_id != first_id
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = quote((url or "").strip(), safe="%/:?#[]@!$&'()*+,;=~-._") or "urn:x-none"
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{first_id}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """(url, page_id, payload_bytes, payload_digest, record_type, refers_to, payload).

    Raises where a response's payload does not have the digest its header states.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError("payload differs from its digest")
    url = fields["WARC-Target-URI"]
    return (
        None if url == "urn:x-none" else url, _page(fields["WARC-Record-ID"]), size, digest, kind,
        _page(fields.get("WARC-Refers-To")), payload,
    )


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def write_archives(grouped: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write one archive per partition; return the stored list of its gzip members."""

    def run(batches):
        from pyspark import TaskContext

        shard, first = TaskContext.get().partitionId(), next(batches, None)
        if first is None:
            return
        with new_file(folder, f"pages-{shard:06d}.warc.gz") as (out, address):
            at = 0
            for batch in (b for some in ([first], batches) for b in some):
                for k in range(0, batch.num_rows, 1000):
                    part = batch.slice(k, 1000).to_pydict()
                    members = []
                    for args in zip(part["page_id"], part["url"], part["payload"], part["first_id"], strict=True):
                        press = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = press.compress(record(*args)) + press.flush()
                        out.write(member)
                        members.append((shard, args[1], args[0], address, at, len(member)))
                        at += len(member)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*members, strict=True), _MEMBER_TYPES, strict=True)],
                        names=[x.split()[0] for x in MEMBERS.split(", ")],
                    )

    return stored(
        grouped.select("page_id", "url", "payload", "first_id").mapInArrow(run, MEMBERS), "warc-members"
    )


_MEMBER_TYPES = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


def _rank(page_id: int | None) -> tuple[bool, int]:
    return page_id is not None, page_id or 0


def keyed(df: DataFrame) -> DataFrame:
    """url, page_id and the URL's sort key."""

    def make():
        return lambda c: (
            (url_key(u), u, p) for u, p in zip(c["url"].to_pylist(), c["page_id"].to_pylist(), strict=True)
        )

    return map_rows(df.select("url", "page_id"), make, "key string, url string, page_id long")


def build_index(members: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures by key into shards of compressed blocks; return the stored list of
    shards: shard, file, first_key, first_id, captures."""

    def keys():
        return lambda c: (
            (url_key(u), p, f, o, n) for u, p, f, o, n in zip(
                *(c[x].to_pylist() for x in ("url", "page_id", "file", "offset", "length")), strict=True
            )
        )

    captures = map_rows(
        members, keys, "key string, page_id long, file string, offset long, length long"
    )
    parts = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        from pyspark import TaskContext

        shard, first = TaskContext.get().partitionId(), next(batches, None)
        if first is None:
            return
        with new_file(folder, f"captures-{shard:06d}") as (out, address):
            directory, at, held, total = [], 0, [], 0

            def flush():
                nonlocal at
                data = zlib.compress(json.dumps(held).encode())
                directory.append([held[0][0], held[0][1], at, len(data)])
                out.write(data)
                at += len(data)

            for batch in (b for some in ([first], batches) for b in some):
                for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                    held.append(row)
                    if len(held) == block_lines:
                        flush()
                        total += len(held)
                        held = []
            if held:
                flush()
                total += len(held)
            data = zlib.compress(json.dumps(directory).encode())
            out.write(data + struct.pack(TAIL, MAGIC, at, len(data)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(
                (shard, address, *directory[0][:2], total),
                (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True,
            )], names=["shard", "file", "first_key", "first_id", "captures"],
        )

    ordered = captures.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    schema = "shard int, file string, first_key string, first_id long, captures long"
    return stored(ordered.mapInArrow(run, schema), "capture-shards")


class Index:
    """Lookups by binary search: shards, then the directory of a shard, then one block."""

    def __init__(self, shards: list[tuple], keep_blocks: int = 8) -> None:
        self.firsts = [(key, _rank(page)) for _, key, page in shards]
        self.addresses = [address for address, *_ in shards]
        self.files, self.keep = Ranges(), keep_blocks
        self.directories: dict[str, list] = {}
        self.blocks: dict[tuple, list] = {}

    def _directory(self, address: str) -> list:
        if address not in self.directories:
            magic, start, size = struct.unpack(TAIL, self.files.tail(address, struct.calcsize(TAIL)))
            if magic != MAGIC:
                raise ValueError(f"{address}: not a capture index")
            rows = json.loads(zlib.decompress(self.files.read(address, start, size)))
            if len(self.directories) >= self.keep:
                self.directories.pop(next(iter(self.directories)))
            self.directories[address] = [((k, _rank(p)), at, n) for k, p, at, n in rows]
        return self.directories[address]

    def _block(self, address: str, at: int, size: int) -> list:
        if (address, at) not in self.blocks:
            if len(self.blocks) >= self.keep:
                self.blocks.pop(next(iter(self.blocks)))
            rows = json.loads(zlib.decompress(self.files.read(address, at, size)))
            self.blocks[address, at] = [((k, _rank(p)), f, o, n) for k, p, f, o, n in rows]
        return self.blocks[address, at]

    def captures(self, low: tuple, high: tuple):
        """(file, offset, length) of all captures with low <= (key, rank) <= high."""
        for s in range(max(0, bisect_left(self.firsts, low) - 1), bisect_right(self.firsts, high)):
            directory = self._directory(self.addresses[s])
            starts = [d[0] for d in directory]
            for b in range(max(0, bisect_left(starts, low) - 1), bisect_right(starts, high)):
                block = self._block(self.addresses[s], *directory[b][1:])
                keys = [row[0] for row in block]
                for row in block[bisect_left(keys, low):bisect_right(keys, high)]:
                    yield row[1:]

    def records(self, low: tuple, high: tuple):
        for address, offset, length in self.captures(low, high):
            yield parse_record(zlib.decompress(self.files.read(address, offset, length), 31))


def look_up(wanted: DataFrame, shards: DataFrame, null_is_any: bool = True) -> DataFrame:
    """The records of the captures of each row of ``wanted``: url and page_id.

    Rows are made distinct by (key, page_id) and sorted, so neighbours read the same blocks;
    every row finds its records through the index.  With a null page_id all captures of the
    URL come back, or, with ``null_is_any=False``, those that have none themselves.  The list of shards, one row per index file, is sent to the tasks.
    """
    spark = wanted.sparkSession
    # a file per partition of the sort: as many rows as there are index files
    rows = [tuple(r) for r in shards.orderBy("shard").select("file", "first_key", "first_id").collect()]
    known = spark.sparkContext.broadcast(rows)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    distinct = keyed(wanted).select("key", "page_id").distinct()
    ordered = distinct.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")

    def make():
        index = Index(known.value)

        def work(columns):
            for key, page in zip(columns["key"].to_pylist(), columns["page_id"].to_pylist(), strict=True):
                low = (key, _rank(page))
                high = low if page is not None or not null_is_any else (key, (True, 1 << 63))
                yield from index.records(low, high)

        return work

    return map_rows(ordered, make, RECORD, batch_rows=500)


def write_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Write the archives and their index; (gzip members, index shards).

    A null html is the empty payload; a null or unreadable URL is kept under its escaped
    text; rows that repeat a page_id are records of their own, all of them responses when they hold
    the smallest id of a payload.  An empty table writes nothing.
    """
    spark = pages.sparkSession
    grouped = payload_groups(pages, id_col, url_col, html_col, least_bytes)
    members = write_archives(grouped, shared_folder(spark, "warc"))
    return members, build_index(members, shared_folder(spark, "captures"))
