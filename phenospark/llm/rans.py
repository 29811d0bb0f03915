"""Token ids in static range-asymmetric-numeral-system files.

One frequency table, counted over all documents, serves every file.  A file holds blocks of
``BLOCK`` ids; a block is coded on its own by ``LANES`` interleaved coders, whose states it
carries, so a reader can start at any block.  At the end of the file stand the block
directory (the checkpoints: offset, size and checksums of each block) and the document
directory, then a fixed-size tail.

Coder state: 64 bits, at least 2**31, refilled by 32-bit words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder, stored
from .store import Ranges, new_file, running_totals
from .tokens import END_ID, encode_documents, narrowest

MAGIC = b"RANSIDS1"
BITS = 18
LANES = 256
BLOCK = 65536
GROUP = 16  # blocks coded side by side
LOWEST = np.uint64(1 << 31)
TAIL = struct.Struct("<8sQQQII")  # magic, directory offset, blocks, documents, checksums
BLOCKS = np.dtype([("offset", "<u8"), ("bytes", "<u4"), ("ids", "<u4"), ("crc", "<u4"), ("raw_crc", "<u4")])
DOCUMENTS = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("ids", "<u8")])
WORK_IDS = 1 << 20  # ids that one unit of decoding covers
FILE_IDS = 1 << 22  # ids of a file, about; a unit reads its file's directory, so that stays small


class Table:
    """Frequencies that sum to ``2**bits``, at least 1 for every id that occurs."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, bits: int = BITS) -> None:
        order = np.argsort(ids)
        self.ids = np.asarray(ids, "u4")[order]
        counts = np.asarray(counts, "f8")[order]
        while len(self.ids) * 2 > 1 << bits:
            bits += 1
        self.bits, total = bits, 1 << bits
        freq = np.maximum(1, np.floor(counts / max(1.0, counts.sum()) * total)).astype("i8")
        spare = total - int(freq.sum())
        if len(freq) and spare > 0:
            freq[np.argmax(freq)] += spare
        while spare < 0:  # take from the frequent ids, never below 1
            cut = np.minimum((freq - 1) // 2, np.ceil(-spare * freq / freq.sum()).astype("i8"))
            cut = np.where(np.cumsum(cut) <= -spare, cut, np.maximum(0, -spare - np.cumsum(cut) + cut))
            freq -= cut
            spare += int(cut.sum())
        self.freq = freq.astype("u8")
        self.first = (np.cumsum(freq) - freq).astype("u8")
        self.slots = np.repeat(np.arange(len(freq), dtype="u4"), freq)
        self.rank = np.zeros(int(self.ids[-1]) + 1 if len(self.ids) else 1, "u4")
        self.rank[self.ids] = np.arange(len(self.ids), dtype="u4")

    def crc(self) -> int:
        return zlib.crc32(self.ids.tobytes() + self.freq.tobytes())

    def encode(self, ids: np.ndarray, lanes: int = LANES) -> list[bytes]:
        """Blocks of equal length, one row of ``ids`` each, coded side by side."""
        blocks, n = ids.shape
        rows = -(-n // lanes)
        symbols = np.zeros((blocks, rows * lanes), "u4")
        symbols[:, :n] = self.rank[ids]
        symbols = symbols.reshape(blocks, rows, lanes)
        state = np.full((blocks, lanes), LOWEST, "u8")
        words = np.empty((blocks, rows, lanes), "u4")
        out = np.zeros((blocks, rows, lanes), bool)
        bits, limit, half = np.uint64(self.bits), np.uint64(63 - self.bits), np.uint64(32)
        for r in range(rows - 1, -1, -1):
            s = symbols[:, r]
            freq = self.freq[s]
            full = state >= (freq << limit)
            out[:, r] = full
            words[:, r] = state.astype("u4")
            state = np.where(full, state >> half, state)
            times = state // freq
            state = (times << bits) + (state - times * freq) + self.first[s]
        return [
            state[b].astype("<u8").tobytes() + words[b][out[b]].astype("<u4").tobytes()
            for b in range(blocks)
        ]

    def decode(self, data: list[bytes], n: int, lanes: int = LANES) -> np.ndarray:
        """The ids of blocks of ``n`` ids each."""
        blocks, rows = len(data), -(-n // lanes)
        state = np.stack([np.frombuffer(d, "<u8", lanes) for d in data])
        streams = [np.frombuffer(d, "<u4", offset=8 * lanes) for d in data]
        sizes = np.array([len(x) for x in streams], "i8")
        words = np.concatenate([*streams, np.zeros(1, "u4")]).astype("u8")
        at = np.cumsum(sizes) - sizes
        result = np.empty((blocks, rows, lanes), "u4")
        bits, mask, half = np.uint64(self.bits), np.uint64((1 << self.bits) - 1), np.uint64(32)
        for r in range(rows):
            low = state & mask
            s = self.slots[low]
            result[:, r] = s
            state = self.freq[s] * (state >> bits) + low - self.first[s]
            need = state < LOWEST
            nth = np.cumsum(need, axis=1)
            take = np.where(need, at[:, None] + nth - 1, len(words) - 1)
            state = np.where(need, (state << half) | words[take], state)
            at = at + nth[:, -1]
        return self.ids[result.reshape(blocks, rows * lanes)[:, :n]]


def count_ids(encoded: DataFrame, kind: str = "<u4") -> tuple[Table, int]:
    """The frequency table over all documents, and how many ids they have; as many rows as different
    ids occur reach the driver."""

    def run(batches):
        total = np.zeros(0, "i8")
        for batch in batches:
            for piece in batch.column("ids").to_pylist():
                part = np.bincount(np.frombuffer(piece, kind))
                if len(part) > len(total):
                    total = np.concatenate([total, np.zeros(len(part) - len(total), "i8")])
                total[:len(part)] += part
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    rows = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")
    ).collect()
    table = Table(np.array([r["id"] for r in rows], "u4"), np.array([r["n"] for r in rows], "f8"))
    return table, sum(r["n"] for r in rows)


class Writer:
    """One file: takes documents in order, writes blocks as they fill."""

    def __init__(self, out, table: Table, block: int = BLOCK, kind: str = "<u4") -> None:
        self.out, self.table, self.block, self.kind = out, table, block, kind
        self.at, self.held, self.waiting = 0, [], 0
        self.blocks, self.documents, self.full = [], [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _code(self, ids: np.ndarray) -> None:
        for row, data in zip(ids, self.table.encode(ids), strict=True):
            raw = zlib.crc32(row.astype("<u4").tobytes())
            self.blocks.append((self.at, len(data), len(row), zlib.crc32(data), raw))
            self._put(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // np.dtype(self.kind).itemsize
        self.documents.append((doc_id or 0, doc_id is not None, n))
        if len(self.documents) == 4096:  # 17 bytes a document, not a tuple
            self.full.append(np.array(self.documents, DOCUMENTS))
            self.documents = []
        self.held.append(ids)
        self.waiting += n
        if self.waiting >= GROUP * self.block:
            self._flush()

    def _flush(self) -> None:
        ids = np.frombuffer(b"".join(self.held), self.kind)
        whole = len(ids) // self.block * self.block
        for k in range(0, whole, GROUP * self.block):
            self._code(ids[k:min(whole, k + GROUP * self.block)].reshape(-1, self.block))
        self.held, self.waiting = [ids[whole:].tobytes()], len(ids) - whole

    def close(self) -> int:
        self._flush()
        if self.waiting:
            self._code(np.frombuffer(self.held[0], self.kind)[None])
        blocks = np.array(self.blocks, BLOCKS).tobytes()
        listed = np.concatenate([*self.full, np.array(self.documents, DOCUMENTS)])
        documents, start = listed.tobytes(), self.at
        self._put(blocks + documents)
        self._put(TAIL.pack(
            MAGIC, start, len(self.blocks), len(listed), zlib.crc32(blocks + documents), self.table.crc(),
        ))
        return int(listed["ids"].sum())


def write_files(
    encoded: DataFrame, table: Table, folder: str, total: int, kind: str = "<u4", file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write encoded documents in ascending doc_id order (null first; rows that repeat an id
    in the order they were encoded) and return the stored manifest: shard, file, n_ids.

    ``total`` ids make as many files as hold about ``file_ids`` each.
    """
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(table)  # bounded by the vocabulary
    order = ["doc_id", "part", "start"]

    def run(batches):
        from pyspark import TaskContext

        shard, first = TaskContext.get().partitionId(), next(batches, None)
        if first is None:
            return
        with new_file(folder, f"ids-{shard:06d}") as (out, address):
            writer = Writer(out, shared.value, kind=kind)
            for batch in (b for some in ([first], batches) for b in some):
                for doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids")), strict=True):
                    writer.add(doc_id, ids)
            n = writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([address]), pa.array([n], pa.int64())],
            names=["shard", "file", "n_ids"],
        )

    parts = max(1, -(-total // file_ids))
    ordered = encoded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    manifest = ordered.select("doc_id", "ids").mapInArrow(run, "shard int, file string, n_ids long")
    return stored(manifest, "rans-files")


def directory(files: Ranges, address: str, table: Table) -> tuple[np.ndarray, np.ndarray]:
    """The block and document directories of a file; raises where a checksum differs."""
    magic, start, blocks, documents, crc, table_crc = TAIL.unpack(files.tail(address, TAIL.size))
    if magic != MAGIC or table_crc != table.crc():
        raise ValueError(f"{address}: not a file of this table")
    size = blocks * BLOCKS.itemsize
    data = files.read(address, start, size + documents * DOCUMENTS.itemsize)
    if zlib.crc32(data) != crc:
        raise ValueError(f"{address}: damaged directory")
    return np.frombuffer(data[:size], BLOCKS), np.frombuffer(data[size:], DOCUMENTS)


def read_blocks(files: Ranges, address: str, blocks: np.ndarray, table: Table) -> np.ndarray:
    """The ids of neighbouring blocks, with their checksums verified."""
    found = []
    for k in range(0, len(blocks), GROUP):
        part = blocks[k:k + GROUP]
        base = int(part["offset"][0])
        data = files.read(address, base, int(part["offset"][-1]) + int(part["bytes"][-1]) - base)
        pieces = [data[int(b["offset"]) - base:][:int(b["bytes"])] for b in part]
        if any(zlib.crc32(p) != b["crc"] for p, b in zip(pieces, part, strict=True)):
            raise ValueError(f"{address}: damaged block")
        same = [part["ids"] == n for n in np.unique(part["ids"])[::-1]]  # only the last is short
        for mask in same:
            rows = table.decode([p for p, m in zip(pieces, mask, strict=True) if m], int(part["ids"][mask][0]))
            for row, crc in zip(rows, part["raw_crc"][mask], strict=True):
                if zlib.crc32(row.astype("<u4").tobytes()) != crc:
                    raise ValueError(f"{address}: ids differ from what was written")
            found.append(rows.reshape(-1))
    return np.concatenate(found) if found else np.zeros(0, "u4")


def decode_range(
    files: Ranges, address: str, table: Table, low: int, high: int,
) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the file, ids) of the documents that start at ids low to high - 1."""
    blocks, documents = directory(files, address, table)
    ends = np.cumsum(documents["ids"].astype("i8"))
    starts = ends - documents["ids"].astype("i8")
    a, b = np.searchsorted(starts, [low, high])
    if a == b:
        return
    block_ends = np.cumsum(blocks["ids"].astype("i8"))
    p, q = np.searchsorted(block_ends, [starts[a], ends[b - 1] - 1], side="right")
    ids = read_blocks(files, address, blocks[p:q + 1], table)
    base = int(block_ends[p]) - int(blocks["ids"][p])
    for k in range(a, b):
        doc_id = int(documents["doc_id"][k]) if documents["known"][k] else None
        yield doc_id, int(starts[k]), ids[starts[k] - base:ends[k] - base]


def read_files(manifest: DataFrame, table: Table, work_ids: int = WORK_IDS) -> DataFrame:
    """Decode in parallel, ``work_ids`` ids a unit: doc_id, start, n_tokens, ids.

    ``start`` counts the ids of all documents before, over all files.
    """
    spark = manifest.sparkSession
    before = spark.sparkContext.broadcast((table, running_totals(manifest, "n_ids", "shard")))
    last = F.floor((F.col("n_ids") - 1) / work_ids)
    units = manifest.where("n_ids > 0").select(
        "file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("unit")
    )
    units = units.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "unit")

    def run(batches):
        files = Ranges()
        table, totals = before.value
        for batch in batches:
            for address, unit in zip(*(batch.column(c).to_pylist() for c in ("file", "unit")), strict=True):
                rows = list(decode_range(files, address, table, unit * work_ids, (unit + 1) * work_ids))
                if rows:
                    ids, starts, values = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids, pa.int64()),
                        pa.array([s + totals[address] for s in starts], pa.int64()),
                        pa.array([len(v) for v in values], pa.int64()),
                        pa.array([v.astype("<u4").tobytes() for v in values], pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids"])

    return units.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID,
) -> DataFrame:
    """Encode documents, write the files, and read them back.

    A null text is the empty one, whose only id is the end id; rows that repeat an id, and
    rows without one, are documents of their own.  An empty table writes no file.
    """
    kind = narrowest(tokenizer)
    encoded = encode_documents(df, tokenizer, id_col, text_col, end_id, kind)
    table, total = count_ids(encoded, kind)
    manifest = write_files(encoded, table, shared_folder(df.sparkSession, "rans"), total, kind)
    return read_files(manifest, table)
