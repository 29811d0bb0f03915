"""Ranked lexical search over a length-stratified index.

A document's length enters its score only through an integer normaliser, so documents of equal
normaliser form a stratum.  The index keeps postings by term and, inside a term, by term frequency:
all documents of such a group get the same impact, which is worked out once.  A stratum is cut
into segments of bounded size.  The greatest frequency of each query term bounds what a segment can
give; segments are visited in order of their bounds, and one whose bound is below the k-th
best score found so far cannot add to the result.  Nothing is approximated.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import LOWER, byte_slices, bytes_of, runs, words_of
from .common import stored, texts

K = 10
SEGMENT_TERMS = 1_000_000  # terms, with repeats, of a segment
SEGMENT_ROWS = 4096  # and documents
BLOCK_ITEMS = 512  # queries that one pass over the index answers
BLOCK_BYTES = 16_000_000
CELLS = 2_000_000  # scores and bounds held at a time
SLICE = 3_000_000  # bytes of text, or of an index's terms, that a task works on at a time
NO_ID = -(1 << 63)  # stands for a null id inside tasks; ranks first among equal scores
SEGMENT = "m long, docs array<long>, terms binary, groups binary, tfs binary, sizes binary, places binary"

# The scoring rule.
WEIGHT, SCALE, TF_UNIT, SLOPE, MEAN, SHARE = 1000, 1_000_000_000, 1000, 8, 100, 75

TERM = np.zeros(256, bool)
TERM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
TERM[128:] = True
_TO_TERMS = bytes(int(LOWER[b]) if TERM[b] else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_TERMS).split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype("i8")
    return SCALE * tf // (TF_UNIT * tf + SLOPE * m)


def term_counts(text: Column) -> Column:
    """How many terms a text has, with repeats."""

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        counts = []
        for some in byte_slices(pa.RecordBatch.from_arrays([column], names=["text"]), size=SLICE):
            data, at = bytes_of(some.column("text"))
            counts.append(np.diff(np.searchsorted(runs(TERM[data], at)[0], at)))
        return pa.array(np.concatenate(counts) if counts else np.zeros(0, "i8"), pa.int64())

    # else the optimiser copies the function to each place that reads its result
    return count.asNondeterministic()(F.coalesce(text.cast("string"), F.lit("")))


@dataclass
class Index:
    """Stored segments, and the number of documents with a term."""

    segments: DataFrame
    documents: int


def build_index(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    segment_terms: int = SEGMENT_TERMS, segment_rows: int = SEGMENT_ROWS,
) -> Index:
    """Index every row of ``df``.

    Null, empty and termless texts are left out, as they never score.  Rows that repeat an id are documents of
    their own, a null id is kept as null.  Two reads: lengths are counted, then whole texts meet by
    stratum and segment.  The strata are broadcast: with N documents there are at most
    sqrt(150 N) + 1, as distinct normalisers need distinct lengths whose sum is bounded.  A
    stratum that holds many documents is cut by a hash, so no task gathers it.
    """
    docs = texts(df, id_col, text_col).withColumn("n", term_counts(F.col("text"))).where("n > 0")
    lengths = stored(docs.groupBy("n").agg(F.count(F.lit(1)).alias("docs")), "lengths")
    row = lengths.agg(F.sum("docs"), F.sum(F.col("docs") * F.col("n"))).first()
    count, total = int(row[0] or 0), int(row[1] or 0)
    m = F.expr(f"{MEAN - SHARE} + (cast(n as decimal(38,0)) * {SHARE * count}) div {max(1, total)}")
    cuts = F.greatest(
        F.ceil(F.sum(F.col("docs") * F.col("n")) / segment_terms), F.ceil(F.sum("docs") / segment_rows)
    ).cast("long")
    strata = stored(lengths.select("docs", "n", m.alias("m")).groupBy("m").agg(cuts.alias("cuts")), "strata")
    placed = docs.withColumn("m", m).join(F.broadcast(strata), "m").select(
        "m", F.pmod(F.xxhash64("doc_id", "text"), F.col("cuts")).alias("cut"), "doc_id", "text"
    )
    keys = ["m", "cut"]
    segments = placed.repartition(*keys).sortWithinPartitions(*keys, "doc_id").mapInArrow(_segments, SEGMENT)
    return Index(stored(segments, "segments"), count)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from rows in order of (m, cut); one that spans slices becomes several."""
    for batch in batches:
        for some in byte_slices(batch, size=SLICE):
            data, at = bytes_of(some.column("text"))
            words = words_of(LOWER[data], at, TERM[data])
            m, cut = (some.column(c).to_numpy() for c in ("m", "cut"))
            new = np.concatenate([[True], (m[1:] != m[:-1]) | (cut[1:] != cut[:-1])])
            segment = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            width = len(words.distinct)
            pairs, tf = np.unique(words.rows * width + words.codes, return_counts=True)
            row, code = pairs // width, pairs % width
            order = np.lexsort((tf, code, segment[row]))  # stable, so rows stay in order
            row, code, tf = row[order], code[order], tf[order]
            seg = segment[row]
            term = np.flatnonzero(np.concatenate([[True], (seg[1:] != seg[:-1]) | (code[1:] != code[:-1])]))
            same = np.zeros(len(seg), bool)
            same[term] = True
            group = np.flatnonzero(same | np.concatenate([[True], tf[1:] != tf[:-1]]))
            ends = np.append(group[1:], len(seg))
            per_term = np.diff(np.append(np.searchsorted(group, term), len(group)))
            bounds = np.arange(len(first) + 1)
            by_term, by_group, by_post = (
                np.searchsorted(x, bounds) for x in (seg[term], seg[group], seg)
            )

            def blobs(values, cuts, kind):
                values = values.astype(kind)
                return pa.array([values[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())

            lists = pa.LargeListArray.from_arrays(pa.array(by_term), words.distinct.take(pa.array(code[term])))
            joined = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
            rows_at = np.append(first, some.num_rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(m[first], pa.int64()),
                pa.ListArray.from_arrays(pa.array(rows_at, pa.int32()), some.column("doc_id")),
                joined.cast(pa.binary()), blobs(per_term, by_term, "<u4"), blobs(tf[group], by_group, "<u4"),
                blobs(ends - group, by_group, "<u4"), blobs(row - first[seg], by_post, "<u4"),
            ], names=["m", "docs", "terms", "groups", "tfs", "sizes", "places"])


class Found:
    """The query terms in a batch of segments: per match the segment, the term's number, its groups
    and postings, all as positions in arrays that span the batch."""

    def __init__(self, batch: pa.RecordBatch, wanted: pa.Array) -> None:
        def spanned(name):
            data, at = bytes_of(batch.column(name))
            return np.frombuffer(data.tobytes(), "<u4").astype("i8"), at // 4

        lists = pc.split_pattern(batch.column("terms"), b" ")
        number = pc.index_in(lists.flatten(), value_set=wanted)
        hit = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
        self.term = number.take(pa.array(hit)).to_numpy().astype("i8")
        term_at = lists.offsets.to_numpy().astype("i8")
        self.segment = np.searchsorted(term_at - term_at[0], hit, side="right") - 1
        groups, _ = spanned("groups")
        self.sizes, _ = spanned("sizes")
        group_end, posting_end = np.cumsum(groups), np.cumsum(self.sizes)
        self.group_end = group_end[hit]
        self.group_start = self.group_end - groups[hit]
        self.posting_end = posting_end[self.group_end - 1]
        self.posting_start = posting_end[self.group_start] - self.sizes[self.group_start]


def document_counts(segments: DataFrame, wanted: list[bytes]) -> dict[int, int]:
    """How many documents hold each wanted term; at most a row a term reaches the driver."""
    shared = segments.sparkSession.sparkContext.broadcast(wanted)  # bounded by the block of queries

    def run(batches):
        names = pa.array(shared.value, pa.binary())
        total = np.zeros(len(names), "i8")
        for batch in batches:
            for some in byte_slices(batch, "terms", SLICE):
                found = Found(some, names)
                np.add.at(total, found.term, found.posting_end - found.posting_start)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "df"])

    rows = segments.select("terms", "groups", "sizes").mapInArrow(run, "term long, df long")
    return {r["term"]: r["df"] for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}


class Best:
    """The k best documents of each query so far, and the score that a further one has to reach."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.rows = k, [(np.zeros(0, "i8"), np.zeros(0, "i8"))] * queries
        self.least = np.ones(queries, "i8")

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.least[query]
        old = self.rows[query]
        scores, ids = np.concatenate([old[0], scores[keep]]), np.concatenate([old[1], ids[keep]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.rows[query] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[query] = scores[order[-1]]


def _visit(batch: pa.RecordBatch, wanted: pa.Array, by_term: tuple, best: Best) -> None:
    """Score the queries on a batch of segments, in descending order of the segments' bounds.

    ``by_term``: for each term where its queries begin, the queries, and their weights.
    """
    start, query, weight = by_term
    found, m = Found(batch, wanted), batch.column("m").to_numpy()
    docs = batch.column("docs")
    ids, id_at = pc.fill_null(docs.flatten(), NO_ID).to_numpy(), docs.offsets.to_numpy().astype("i8")
    id_at = id_at - id_at[0]
    tfs = np.frombuffer(bytes_of(batch.column("tfs"))[0].tobytes(), "<u4")
    places = np.frombuffer(bytes_of(batch.column("places"))[0].tobytes(), "<u4")
    highest = impacts(tfs[found.group_end - 1], m[found.segment])  # groups ascend by frequency
    width = len(best.least)
    times = start[found.term + 1] - start[found.term]
    match = np.repeat(np.arange(len(times)), times)
    pair = start[found.term][match] + np.arange(len(match)) - np.repeat(np.cumsum(times) - times, times)
    bounds = np.zeros((len(m), width), "i8")
    np.add.at(bounds, (found.segment[match], query[pair]), weight[pair] * highest[match])
    match_at = np.searchsorted(found.segment, np.arange(len(m) + 1))
    for s in np.argsort(-bounds.max(axis=1), kind="stable"):
        live = bounds[s] >= best.least
        if not live.any():
            continue
        n = int(id_at[s + 1] - id_at[s])
        active = np.flatnonzero(live)
        for part in range(0, len(active), max(1, CELLS // n)):
            some = active[part:part + max(1, CELLS // n)]
            line = np.full(width, -1)
            line[some] = np.arange(len(some))
            scores = np.zeros((len(some), n), "i8")
            for k in range(match_at[s], match_at[s + 1]):
                a, b = start[found.term[k]], start[found.term[k] + 1]
                lines = line[query[a:b]]
                taken = lines >= 0
                if not taken.any():
                    continue
                g, h = found.group_start[k], found.group_end[k]
                impact = np.repeat(impacts(tfs[g:h], m[s]), found.sizes[g:h])
                where = places[found.posting_start[k]:found.posting_end[k]]
                scores[lines[taken][:, None], where] += weight[a:b][taken][:, None] * impact
            top = scores.max(axis=1)
            for j in np.flatnonzero(top >= best.least[some]):
                best.add(int(some[j]), scores[j], ids[id_at[s]:id_at[s + 1]])


def _answers(segments: DataFrame, count: int, queries: list[Counter], k: int) -> DataFrame:
    """(query, doc_id, score): at most k rows a query and task."""
    wanted = sorted({t for q in queries for t in q})
    seen = document_counts(segments, wanted)
    weights = [
        math.floor(WEIGHT * math.log((2 * count + 2) / (2 * seen[t] + 1))) if t in seen else 0
        for t in range(len(wanted))
    ]
    number = {t: n for n, t in enumerate(wanted)}
    pairs = sorted((number[t], q, n * weights[number[t]]) for q, c in enumerate(queries) for t, n in c.items())
    pairs = np.array([p for p in pairs if p[2] > 0], "i8").reshape(-1, 3)
    by_term = np.searchsorted(pairs[:, 0], np.arange(len(wanted) + 1)), pairs[:, 1].copy(), pairs[:, 2].copy()
    shared = segments.sparkSession.sparkContext.broadcast((wanted, by_term))  # bounded by the block
    width = len(queries)

    def run(batches):
        wanted, by_term = shared.value
        names, best = pa.array(wanted, pa.binary()), Best(width, k)
        for batch in batches:
            for some in byte_slices(batch, "terms", SLICE):
                step = max(1, CELLS // max(1, width))
                for a in range(0, some.num_rows, step):
                    _visit(some.slice(a, step), names, by_term, best)
        query = np.repeat(np.arange(width), [len(r[0]) for r in best.rows])
        scores, ids = (np.concatenate([r[i] for r in best.rows]) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], names=["query", "doc_id", "score"]
        )

    return segments.mapInArrow(run, "query long, doc_id long, score long")


def search(
    index: Index, items: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text",
    block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents with a score above 0.

    Equal scores rank by ascending doc_id, null first.  An item without terms has no rows;
    items that repeat id and text are one, different texts under one id are ranked each on
    its own.  Items are taken in blocks by hash; their mean size is at most half of ``block_items`` items and
    ``block_bytes`` of text, unless one block holds all.  Every block passes over the whole index.
    """
    known = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    known = stored(known.where(F.col("text").isNotNull()), "items")
    size = known.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    share = max(size[0] / block_items, (size[1] or 0) / block_bytes)
    blocks = 1 if share <= 1 else math.ceil(2 * share)
    spark = known.sparkSession
    kind = known.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        here = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        rows = [(r["item_id"], Counter(terms_of(r["text"]))) for r in known.where(here).collect()]
        rows = [r for r in rows if r[1]]
        if not rows:
            continue
        numbers = spark.createDataFrame([(n, r[0]) for n, r in enumerate(rows)], f"query long, item_id {kind}")
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
        top = _answers(index.segments, index.documents, [r[1] for r in rows], k).withColumn("rank", rank)
        found = found.unionByName(
            top.where(F.col("rank") <= k).join(F.broadcast(numbers), "query").select("item_id", "rank", "doc_id", "score")
        )
    return found
