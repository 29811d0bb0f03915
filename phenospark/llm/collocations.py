"""Phrase collocations per language, counted in counting quotient filters.

A word's id is a 64-bit hash, verified to differ between all words of a language.  The ids of an n-gram
are packed into one wide integer and permuted by a keyed Feistel network, which can be undone.  The
top bits of the permuted integer are the shard and the quotient, the rest is the remainder, kept in
full; so a filter loses nothing, and reading it back gives the ids.  Tasks count into filters, filters
of a shard are sorted alike and are merged.

What to count is narrowed first by a sketch of fixed size: cells of n-gram hashes are counted
over all documents, and an n-gram in a cell below the least count cannot reach it.  The sketch never
drops one that does; on very large inputs it drops fewer of the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import LOWER, byte_class, byte_slices, bytes_of, words_of
from .common import stored

LEAST = 30
LONGEST = 4
TOP = 2000
CELL_BITS = 26  # cells of the sketch, a byte each in a task, a bit each in the broadcast
BLOCK_BITS = 17  # cells of a block of the sketch that is summed on its own
ENTRIES = 1_500_000  # n-grams that a task holds before it hands over filters
SCORE = 2_000_000  # fixed values: the scale of the score, and the share that a longer phrase needs
SWALLOW = (100, 80)

BREAK = ~byte_class(b".,;:!?\n\x0b\x0c\r")
WORD = byte_class(b" \t.,;:!?\n\x0b\x0c\r")
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_ROUND = [np.uint64(0x9E3779B97F4A7C15 * step % (1 << 64)) for step in range(1, 2 * LONGEST + 20)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def permute(ids: np.ndarray) -> np.ndarray:
    """Rows of k 64-bit numbers to rows of k such numbers, one to one."""
    x = ids.astype("u8").copy()
    k = x.shape[1]
    for step in range(2 * k + 1):
        x[:, step % k] ^= _mix(x[:, (step + 1) % k] + _ROUND[step])
    return x


def restore(keys: np.ndarray) -> np.ndarray:
    x = keys.copy()
    k = x.shape[1]
    for step in reversed(range(2 * k + 1)):
        x[:, step % k] ^= _mix(x[:, (step + 1) % k] + _ROUND[step])
    return x


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of permuted keys in ascending order, each once, with the sum of its counts."""
    order = np.argsort(keys[:, 0], kind="stable")
    keys, counts = keys[order], counts[order]
    tie = keys[1:, 0] == keys[:-1, 0]
    if (tie & (keys[1:] != keys[:-1]).any(axis=1)).any():  # equal first numbers, different others
        order = np.lexsort(keys.T[::-1])
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))[:len(keys)]
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


@dataclass
class Filter:
    """Sorted n-grams of one shard with their counts.

    As bytes: a bit per quotient, whether it occurs; a bit per entry, whether it ends its quotient's
    run; the remainders, whole bytes of the first number and the other numbers in full; a byte per
    count, 255 where a longer one follows at the end.
    """

    keys: np.ndarray  # permuted, ascending, n x k
    counts: np.ndarray

    def to_bytes(self, shard_bits: int) -> bytes:
        n, k = self.keys.shape
        bits = max(1, int(n).bit_length())
        top = self.keys[:, 0] << np.uint64(shard_bits) if shard_bits else self.keys[:, 0]
        quotient = (top >> np.uint64(64 - bits)).astype("i8")
        occupied = np.zeros(1 << bits, bool)
        occupied[quotient] = True
        run_end = np.append(quotient[1:] != quotient[:-1], True)
        width = (64 - shard_bits - bits + 7) // 8
        low = self.keys[:, 0].astype("<u8").view("u1").reshape(n, 8)[:, :width]
        small = np.minimum(self.counts, 255).astype("u1")
        large = self.counts[small == 255].astype("<u8")
        return b"".join([
            np.array([n, k, bits, width], "<u4").tobytes(), np.packbits(occupied).tobytes(),
            np.packbits(run_end).tobytes(), low.tobytes(), self.keys[:, 1:].astype("<u8").tobytes(),
            small.tobytes(), large.tobytes(),
        ])

    @classmethod
    def of_bytes(cls, data: bytes, shard: int, shard_bits: int) -> Filter:
        n, k, bits, width = (int(v) for v in np.frombuffer(data, "<u4", 4))
        at = 16

        def take(kind, count):
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        occupied = np.unpackbits(take("u1", ((1 << bits) + 7) // 8), count=1 << bits).astype(bool)
        run_end = np.unpackbits(take("u1", (n + 7) // 8), count=n).astype(bool)
        low = np.zeros((n, 8), "u1")
        low[:, :width] = take("u1", n * width).reshape(n, width)
        rest = take("<u8", n * (k - 1)).reshape(n, k - 1)
        counts = take("u1", n).astype("i8")
        counts[counts == 255] = take("<u8", int((counts == 255).sum())).astype("i8")
        quotient = np.flatnonzero(occupied)[np.cumsum(run_end) - run_end].astype("u8")
        prefix = (np.uint64(shard) << np.uint64(bits)) | quotient
        known = shard_bits + bits
        mask = np.uint64((1 << (64 - known)) - 1)
        first = (prefix << np.uint64(64 - known)) | (low.reshape(-1).view("<u8") & mask)
        return cls(np.concatenate([first[:, None], rest.astype("u8")], axis=1), counts)

    @classmethod
    def merged(cls, filters: list[Filter]) -> Filter:
        return cls(*summed(np.concatenate([f.keys for f in filters]), np.concatenate([f.counts for f in filters])))


@dataclass
class Tokens:
    """The words of a slice of texts: id, language and piece of each."""

    ids: np.ndarray
    langs: np.ndarray  # number of the language
    names: list[str]
    pieces: np.ndarray
    codes: np.ndarray
    distinct: pa.Array

    def grams(self, k: int) -> np.ndarray:
        """Where a run of k words begins that stays in its piece."""
        n = len(self.ids) - k + 1
        return np.flatnonzero(self.pieces[:n] == self.pieces[k - 1:]) if n > 0 else np.zeros(0, "i8")

    def gram_hash(self, at: np.ndarray, k: int) -> np.ndarray:
        key = _mix(np.array([_lang_seed(n) for n in self.names], "u8"))[self.langs[at]] + np.uint64(k)
        for j in range(k):
            key = _mix(key * _GOLD + self.ids[at + j])
        return key


def _lang_seed(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass"))


def tokens_of(batch: pa.RecordBatch, seed: int) -> Tokens:
    data, at = bytes_of(batch.column("text"))
    words = words_of(LOWER[data], at, WORD[data])
    broken = np.cumsum(np.append(BREAK[data], False), dtype="i8")
    pieces = broken[words.starts] + words.rows  # grows at every break and with every text
    names = batch.column("lang").dictionary_encode()
    ids = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words.distinct.to_pylist()), "u8", len(words.distinct))
    langs = names.indices.to_numpy().astype("i8")
    return Tokens(
        ids[words.codes], langs[words.rows], names.dictionary.to_pylist(), pieces, words.codes, words.distinct
    )


def _slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Tokens]:
    for batch in batches:
        for some in byte_slices(batch):
            yield tokens_of(some, seed)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """lang, id, word, f: every word, stored.  Counts are reduced in the task before they meet."""

    def run(batches):
        for t in _slices(batches, seed):
            width = max(1, len(t.distinct))
            pair, f = np.unique(t.langs * width + t.codes, return_counts=True)
            lang, code = pair // width, pair % width
            words = t.distinct.take(pa.array(code))
            ids = [xxhash.xxh3_64_intdigest(w, seed) for w in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array(t.names, pa.string()).take(pa.array(lang)), pa.array(np.array(ids, "u8").view("i8")),
                words.cast(pa.large_string()).cast(pa.string()), pa.array(f.astype("i8")),
            ], names=["lang", "id", "word", "f"])

    rows = docs.mapInArrow(run, "lang string, id long, word string, f long")
    return stored(rows.groupBy("lang", "id", "word").agg(F.sum("f").alias("f")), "words")


def distinct_ids(docs: DataFrame) -> tuple[int, DataFrame]:
    """A seed under which no two words of a language share an id, and the word counts with it."""
    seed = 0
    while True:
        words = word_counts(docs, seed)
        if words.groupBy("lang", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return seed, words
        seed += 1


def frequent_cells(docs: DataFrame, seed: int, least: int, longest: int, bits: int = CELL_BITS) -> np.ndarray:
    """A bit for each cell, whether the n-grams in it add up to ``least``.

    Bytes stop at 255, or at the least count if that is higher, which no cell below it reaches.
    """
    block = min(BLOCK_BITS, bits)
    kind = "u1" if least <= 255 else "u4"
    top = max(least, 255) if kind == "u1" else np.iinfo("i4").max

    def count(batches):
        cells = np.zeros(1 << bits, kind)
        for t in _slices(batches, seed):
            for k in range(2, longest + 1):
                found = (t.gram_hash(t.grams(k), k) >> np.uint64(64 - bits)).astype("u4")
                found.sort()
                first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))[:len(found)]
                cell, n = found[first], np.diff(np.append(first, len(found)))
                cells[cell] = np.minimum(cells[cell] + n, top)
        for b, part in enumerate(cells.reshape(-1, 1 << block)):
            if part.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([b], pa.int32()), pa.array([pa.compress(part.tobytes(), "zstd", asbytes=True)], pa.binary())
                ], names=["block", "cells"])

    def add(batches):
        at, total = None, None

        def row():
            packed = np.packbits(total >= least).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([packed], pa.binary())], names=["block", "cells"])

        size = (1 << block) * np.dtype(kind).itemsize
        for batch in batches:
            for b, data in zip(*(batch.column(c).to_pylist() for c in ("block", "cells")), strict=True):
                if b != at:
                    if at is not None:
                        yield row()
                    at, total = b, np.zeros(1 << block, "i8")
                total += np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True), kind)
        if at is not None:
            yield row()

    schema = "block int, cells binary"
    parts = docs.mapInArrow(count, schema).repartition("block").sortWithinPartitions("block")
    bitmap = np.zeros((1 << bits - block, (1 << block) // 8), "u1")
    for r in parts.mapInArrow(add, schema).collect():  # a bit a cell: fixed size
        bitmap[r["block"]] = np.frombuffer(r["cells"], "u1")
    return bitmap.reshape(-1)


def phrase_counts(
    docs: DataFrame, seed: int, cells: np.ndarray, least: int, longest: int, bits: int = CELL_BITS,
    entries: int = ENTRIES,
) -> DataFrame:
    """lang, ids, f: n-grams of 2 to ``longest`` words that occur ``least`` times or more, stored."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(cells)  # a bit a cell: fixed size
    shard_bits = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()

    def count(batches):
        bitmap, held, size = shared.value, {}, 0
        for t in _slices(batches, seed):
            for k in range(2, longest + 1):
                at = t.grams(k)
                cell = t.gram_hash(at, k) >> np.uint64(64 - bits)
                at = at[(bitmap[cell >> np.uint64(3)] >> (np.uint64(7) - (cell & np.uint64(7))).astype("u1") & 1).astype(bool)]
                for number, name in enumerate(t.names):
                    own = at[t.langs[at] == number]
                    if len(own):
                        keys = permute(np.stack([t.ids[own + j] for j in range(k)], axis=1))
                        found = Filter(*summed(keys, np.ones(len(keys), "i8")))
                        held.setdefault((name, k), []).append(found)
                        size += len(found.counts)
            if size > entries:
                held = {key: [Filter.merged(some)] for key, some in held.items()}
                size = sum(len(some[0].counts) for some in held.values())
                if size > entries // 2:
                    yield from _shards(held, shard_bits)
                    held, size = {}, 0
        yield from _shards(held, shard_bits)

    def merge(batches):
        key, held, size = None, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "words", "shard", "filter"))
            for lang, words, shard, data in zip(*columns, strict=True):
                if key != (lang, words, shard):
                    if held:
                        yield _counted(key[0], Filter.merged(held), least)
                    key, held, size = (lang, words, shard), [], 0
                held.append(Filter.of_bytes(data, shard, shard_bits))
                size += len(held[-1].counts)
                if size > entries:
                    held = [Filter.merged(held)]
                    size = len(held[0].counts) // 2  # so that merging again waits for as many more
        if held:
            yield _counted(key[0], Filter.merged(held), least)

    keys = ["lang", "words", "shard"]
    parts = docs.mapInArrow(count, "lang string, words int, shard int, filter binary")
    met = parts.repartition(*keys).sortWithinPartitions(*keys)
    return stored(met.mapInArrow(merge, "lang string, ids array<long>, f long"), "phrases")


def _shards(held: dict, shard_bits: int) -> Iterator[pa.RecordBatch]:
    for (name, k), some in held.items():
        whole = Filter.merged(some)
        shard = (whole.keys[:, 0] >> np.uint64(64 - shard_bits)).astype("i8")
        numbers, first = np.unique(shard, return_index=True)
        ends = np.append(first[1:], len(shard))
        data = [
            Filter(whole.keys[a:b], whole.counts[a:b]).to_bytes(shard_bits) for a, b in zip(first, ends, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([
            pa.array([name] * len(data), pa.string()), pa.array([k] * len(data), pa.int32()),
            pa.array(numbers.astype("i4")), pa.array(data, pa.binary()),
        ], names=["lang", "words", "shard", "filter"])


def _counted(lang: str, whole: Filter, least: int) -> pa.RecordBatch:
    keep = whole.counts >= least
    ids, f = restore(whole.keys[keep]), whole.counts[keep]
    k = ids.shape[1]
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(len(f) + 1) * k, pa.int32()), pa.array(np.ascontiguousarray(ids).view("i8").ravel())
    )
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(f), pa.string()), lists, pa.array(f)], names=["lang", "ids", "f"]
    )


def _wide(column: str) -> Column:
    """Exact beyond 64 bits."""
    return F.col(column).cast("decimal(20,0)")


def collocations(
    df: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST,
    top: int = TOP, cell_bits: int = CELL_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language.

    A-Z are lower-cased, pieces end at punctuation and line ends, words at spaces and tabs.  A null language
    is ``und``; a null or empty text has no words, and a language without any has no rows.  Copies
    count as often as they occur.  Every n-gram is counted exactly.
    """
    docs = df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    seed, words = distinct_ids(docs)
    cells = frequent_cells(docs, seed, least, longest, cell_bits)
    phrases = phrase_counts(docs, seed, cells, least, longest, cell_bits)
    return rank_phrases(words, phrases, least, top)


def rank_phrases(words: DataFrame, phrases: DataFrame, least: int, top: int) -> DataFrame:
    """The scores, the drop rule and the ranks, from exact counts."""
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = words.where(F.col("f") >= least)
    grams = phrases.unionByName(known.select("lang", F.array("id").alias("ids"), "f"))
    cuts = phrases.select(
        "lang", "ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("cut")
    ).withColumn("left", F.slice("ids", F.lit(1), F.col("cut"))).withColumn(
        "right", F.slice("ids", F.col("cut") + 1, F.size("ids") - F.col("cut"))
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(
            grams.select("lang", F.col("ids").alias(side), F.col("f").alias(name)), ["lang", side]
        )
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCORE}) div (cast(l as decimal(20,0)) + r)")
    best = cuts.groupBy("lang", "ids", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))
    inner = phrases.where(F.size("ids") > 2).withColumn(
        "size", F.explode(F.sequence(F.lit(2), F.size("ids") - 1))
    ).withColumn("start", F.explode(F.sequence(F.lit(1), F.size("ids") - F.col("size") + 1))).groupBy(
        "lang", F.slice("ids", F.col("start"), F.col("size")).alias("ids")
    ).agg(F.max("f").alias("longer"))
    swallowed = F.lit(SWALLOW[0]) * _wide("longer") >= F.lit(SWALLOW[1]) * _wide("a")
    kept = best.join(inner, ["lang", "ids"], "left").where(F.col("longer").isNull() | ~swallowed).select(
        "lang", "ids", "a", "b.l", "b.r", "b.score"
    )
    # ties stay whole until the phrases are known; the window cuts map-side
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = kept.withColumn("place", F.rank().over(order)).where(F.col("place") <= top)
    spelt = first.select("*", F.posexplode("ids").alias("pos", "id")).join(
        known.select("lang", "id", "word"), ["lang", "id"]
    ).groupBy("lang", "ids", "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda w: w["word"]), " ").alias("phrase")
    )
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return spelt.withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top).join(
        sizes, "lang"
    ).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
