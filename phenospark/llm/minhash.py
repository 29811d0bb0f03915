"""Near-duplicate documents by one-permutation MinHash with optimal densification.

Each set is hashed once; its values fall into bins, the least value of a bin counts, and an
empty bin takes the value of a bin that a fixed random sequence of its own names.  Bands of
bins give bucket keys.  A bucket proposes star-shaped pairs, every member with one centre,
and full sets confirm them.  Where a bucket still spans several components, the members of
different ones are compared inside tasks, which give a spanning forest; so the number of
pairs stays near that of the members and no link between components is lost.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts
from .components import components

WORDS = 5
PERCENT = 80
BANDS = 32
ROWS = 5
CHUNK = 1024  # members, and shingles, of a bucket that one side of a unit may hold
CHUNK_SHINGLES = 2_000_000
KNOWN_WORDS = 120_000  # of at most 32 bytes, some 25 MB a worker
DRAWS = 256


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 32 and len(self) < KNOWN_WORDS:
            self[word] = value
        return value


class Shingles:
    """Sets of word shingles as sorted 64-bit hashes.

    A-Z are lower-cased and words are what the six ASCII white space characters part.  Fewer
    words than a shingle has make one shingle of all; without words the set is empty.
    """

    def __init__(self, words: int = WORDS) -> None:
        self.size, self.known = words, _Words()

    def __call__(self, text: str) -> np.ndarray:
        found = text.encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.zeros(0, "u8")
        if len(self.known) >= KNOWN_WORDS:
            self.known = _Words()
        h = np.fromiter(map(self.known.__getitem__, found), "u8", len(found))
        size = min(self.size, len(h))
        out = np.full(len(h) - size + 1, size, "u8")
        for k in range(size):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - size + 1 + k])
        return np.unique(out)


@lru_cache(maxsize=4)
def shingler(words: int) -> Shingles:
    """One per Python worker, so that tasks share the words it knows."""
    return Shingles(words)


@lru_cache(maxsize=4)
def donors(bins: int) -> np.ndarray:
    """For each bin the bins to ask when it is empty: random draws, then all in random order."""
    rng = np.random.default_rng(20_170)
    draws = rng.integers(0, bins, (bins, DRAWS))
    return np.hstack([draws, np.stack([rng.permutation(bins) for _ in range(bins)])])


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One value per bin of a set that is not empty."""
    h = mix(hashes ^ np.uint64(0xA0761D6478BD642F))
    where = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype("i8")
    values = np.full(bins, np.iinfo("u8").max, "u8")
    np.minimum.at(values, where, mix(h))
    full = np.zeros(bins, bool)
    full[where] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        ask = donors(bins)[empty]
        values[empty] = values[ask[np.arange(len(empty)), full[ask].argmax(axis=1)]]
    return values


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    rows = values.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype="u8")
    for column in rows.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def sketches(df: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Per document: doc_id, n_shingles, fingerprint of the set (two halves), band keys."""

    def run(batches):
        shingles = shingler(words)
        for batch in batches:
            sizes, high, low, keys = [], [], [], []
            for text in batch.column("text"):  # one at a time: a worker shares its executor's memory
                hashes = shingles(text.as_py())
                digest = xxhash.xxh3_128_intdigest(hashes.tobytes())
                sizes.append(len(hashes))
                high.append((digest >> 64) - (1 << 63))
                low.append((digest & ((1 << 64) - 1)) - (1 << 63))
                keys.append(
                    band_keys(signature(hashes, bands * rows), bands).view("i8") if len(hashes) else []
                )
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()),
                pa.array(low, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
            ], names=["doc_id", "n_shingles", "high", "low", "bands"])

    return df.mapInArrow(run, "doc_id long, n_shingles long, high long, low long, bands array<long>")


def confirm(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs (node, centre) whose full sets have 100 * intersection >=
    percent * union, as edges (a, b).

    Texts meet the ids they are wanted for; the sets are made there and only those of the
    pairs travel on, to the centre.
    """
    wanted = stored(pairs.groupBy("node").agg(F.collect_set("centre").alias("centres")), "wanted")
    centres = stored(pairs.select("centre").distinct(), "centres")

    def member_sets(batches):
        shingles = shingler(words)
        for batch in batches:
            texts_, nodes, lists = (batch.column(c).to_pylist() for c in ("text", "node", "centres"))
            held, size = [], 0
            for text, node, some in zip(texts_, nodes, lists, strict=True):
                data = shingles(text).tobytes()
                for centre in some:
                    held.append((node, centre, data))
                    size += len(data)
                    if size > 16_000_000:
                        yield _rows(held)
                        held, size = [], 0
            if held:
                yield _rows(held)

    def _rows(held):
        node, centre, data = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(node, pa.int64()), pa.array(centre, pa.int64()), pa.array(data, pa.binary())],
            names=["node", "centre", "members"],
        )

    def centre_sets(batches):
        shingles = shingler(words)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column("centre"),
                pa.array([shingles(t.as_py()).tobytes() for t in batch.column("text")], pa.binary()),
            ], names=["centre", "set"])

    def linked(batches):
        for batch in batches:
            mask = []
            for x, y in zip(batch.column("members"), batch.column("set"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), "u8"), np.frombuffer(y.as_buffer(), "u8")
                both = len(a) + len(b) - len(np.union1d(a, b))
                mask.append(100 * both >= percent * (len(a) + len(b) - both))
            keep = pa.array(mask, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").filter(keep), batch.column("centre").filter(keep)], names=["a", "b"]
            )

    left = docs.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id").select(
        F.col("doc_id").alias("node"), "text", "centres"
    ).mapInArrow(member_sets, "node long, centre long, members binary")
    right = docs.join(centres.withColumnRenamed("centre", "doc_id"), "doc_id").select(
        F.col("doc_id").alias("centre"), "text"
    ).mapInArrow(centre_sets, "centre long, set binary")
    return left.join(right, "centre").select("node", "centre", "members", "set").mapInArrow(
        linked, "a long, b long"
    ).distinct()


def _alike(percent: int):
    """Sizes that the threshold allows: the smaller set is at least that share of the larger."""
    return 100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their sets.  A null
    or wordless text has an empty set and is linked with nothing, and so is a row without an
    id, whose component is null.  Rows that repeat an id are one document; should their
    texts differ, each text's links count.  Equal sets are one node, so copies cost nothing.
    With the default bands a pair exactly at 80 % has no bucket in common once in 300,000
    times; every pair that has one is compared or joined through others.  Lower thresholds
    need fewer ``rows`` or more ``bands``.
    """
    docs = texts(df, id_col, text_col)
    sketch = stored(sketches(docs, words, bands, rows), "sketches")
    classes = stored(
        sketch.where("n_shingles > 0 and doc_id is not null").groupBy("high", "low").agg(
            F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
        ), "classes",
    )
    keys = classes.select("node", "n", F.explode("bands").alias("key"))
    buckets = stored(
        keys.groupBy("key").agg(F.min(F.struct("node", "n")).alias("centre"), F.count(F.lit(1)).alias("size"))
        .where("size > 1").select("key", F.col("centre.node").alias("centre"), F.col("centre.n").alias("centre_n")),
        "buckets",
    )
    members = stored(keys.join(buckets.select("key"), "key"), "members")
    pairs = stored(
        members.join(buckets, "key").where(F.col("node") != F.col("centre")).where(_alike(percent))
        .select("node", "centre").distinct(), "pairs",
    )
    edges = stored(confirm(docs, pairs, words, percent), "confirmed")
    rest = stored(
        compare_rest(docs, classes, members, components(edges), words, percent), "confirmed"
    )
    labels = components(edges.unionByName(rest))
    by_set = classes.select("high", "low", "node").join(labels, "node", "left").select(
        "high", "low", F.coalesce("component", "node").alias("component_id")
    )
    return _with_components(sketch, stored(by_set, "set-components"))


def compare_rest(
    docs: DataFrame, classes: DataFrame, members: DataFrame, labels: DataFrame, words: int, percent: int,
) -> DataFrame:
    """Edges that the stars missed: in buckets that still span several components, all pairs of
    different components, each in one of the buckets that its members share.

    The largest component of a bucket is not compared with itself.  The others are cut
    into chunks, and so is the largest; each pair of chunks with one of the others in it is
    a task's unit.  Units give a spanning forest of the links found, not pairs.  Buckets with
    the same members count once.
    """
    known = stored(
        members.join(labels, "node", "left").select(
            "key", "node", "n", F.coalesce("component", "node").alias("component")
        ), "bucket-components",
    )
    groups = known.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who"),
    )
    mixed = groups.groupBy("key").agg(
        F.count(F.lit(1)).alias("groups"), F.max(F.struct("size", "n", "component")).alias("most"),
        F.sum("size").alias("size"), F.sum("n").alias("n"), F.sum("who").alias("who"),
    ).where("groups > 1")

    def chunks(size, n):
        return F.greatest(F.lit(1), F.ceil(size / CHUNK), F.ceil(n / CHUNK_SHINGLES)).cast("int")

    one_each = stored(
        mixed.groupBy("size", "n", "who").agg(F.min(F.struct("key", "most")).alias("b")).select(
            "b.key", F.col("b.most.component").alias("largest"),
            chunks(F.col("size") - F.col("b.most.size"), F.col("n") - F.col("b.most.n")).alias("others"),
            chunks(F.col("b.most.size"), F.col("b.most.n")).alias("mains"),
        ), "mixed-buckets",
    )
    placed = known.join(one_each, "key").select(
        "node", F.struct(
            "key", "component", "others", "mains", (F.col("component") == F.col("largest")).alias("main")
        ).alias("place"),
    )
    wanted = stored(placed.groupBy("node").agg(F.collect_list("place").alias("places")), "wanted")
    with_bands = wanted.join(classes.select("node", "bands"), "node")
    schema = (
        "key long, low int, high int, first boolean, node long, component long, bands binary, members binary"
    )

    def spread(batches):
        shingles = shingler(words)
        for batch in batches:
            held, size = [], 0
            for text, node, bands, places in zip(
                *(batch.column(c).to_pylist() for c in ("text", "node", "bands", "places")), strict=True
            ):
                data, keys = shingles(text).tobytes(), np.array(bands, "i8").tobytes()
                for place in places:
                    for low, high, first in units_of(node, place):
                        held.append((place["key"], low, high, first, node, place["component"], keys, data))
                        size += len(data) + len(keys)
                        if size > 16_000_000:
                            yield _unit_rows(held)
                            held, size = [], 0
            if held:
                yield _unit_rows(held)

    rows = docs.join(with_bands.withColumnRenamed("node", "doc_id"), "doc_id").select(
        F.col("doc_id").alias("node"), "text", "bands", "places"
    ).mapInArrow(spread, schema)
    unit = ["key", "low", "high"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["first", "node", "component", "bands", "members"]

    def compare(batches):
        key, held, found = None, [], []
        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in (*unit, *columns)]
            for a, b, c, *row in zip(*lists, strict=True):
                if (a, b, c) != key:
                    found += compare_unit(held, percent, key)
                    key, held = (a, b, c), []
                held.append(row)
            if found:
                yield _edges(found)
                found = []
        found = compare_unit(held, percent, key)
        if found:
            yield _edges(found)

    return rows.repartition(parts, *unit).sortWithinPartitions(*unit).mapInArrow(
        compare, "a long, b long"
    ).distinct()


def units_of(node: int, place: dict):
    """(low, high, first) of the units a bucket's member takes part in.

    Chunks of the other components are numbered from 0 and meet each other once; those of
    the largest follow them and meet only the others.
    """
    others, mains = place["others"], place["mains"]
    own = int(mix(np.array([node], "i8").view("u8"))[0] % np.uint64(mains if place["main"] else others))
    if place["main"]:
        return [(k, others + own, False) for k in range(others)]
    return [(min(own, k), max(own, k), own <= k) for k in range(others)] + [
        (own, others + k, True) for k in range(mains)
    ]


def compare_unit(rows: list, percent: int, key: tuple | None) -> list[tuple[int, int]]:
    """A spanning forest of the links between members of different components in one unit.

    ``rows``: [first side, node, component, bands, set].  A pair is compared in the bucket of
    its least common key only; of buckets with the same members the least key was kept.
    """
    if len(rows) < 2:
        return []
    bands = np.stack([np.frombuffer(r[3], "i8") for r in rows])
    sets = [np.frombuffer(r[4], "u8") for r in rows]
    sizes = np.array([len(s) for s in sets], "i8")
    component = np.array([r[2] for r in rows], "i8")
    node = np.array([r[1] for r in rows], "i8")
    left = np.flatnonzero([r[0] for r in rows])
    right = left if key[1] == key[2] else np.flatnonzero([not r[0] for r in rows])
    if not len(left) or not len(right):
        return []
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marks = np.zeros(int(codes.max(initial=0)) + 1, bool)
    found = []
    for i in left:
        others = right[(component[right] != component[i]) & (right != i)]
        others = others[
            100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i])
        ]
        if key[1] == key[2]:
            others = others[others > i]
        if len(others):
            common = bands[others] == bands[i]
            own = np.where(common, bands[i], np.iinfo("i8").max).min(axis=1) == key[0]
            others = others[own]
        if not len(others):
            continue
        marks[codes[starts[i]:ends[i]]] = True
        at = np.concatenate([np.arange(starts[j], ends[j]) for j in others])
        cuts = np.cumsum(sizes[others]) - sizes[others]
        both = np.add.reduceat(marks[codes[at]].astype("i8"), cuts)
        marks[codes[starts[i]:ends[i]]] = False
        good = others[100 * both >= percent * (sizes[others] + sizes[i] - both)]
        if len(good):  # a link to each component is enough
            _, one = np.unique(component[good], return_index=True)
            found += [(int(node[i]), int(node[j])) for j in good[one]]
    return found


def _unit_rows(held: list) -> pa.RecordBatch:
    types = [
        pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)],
        names=["key", "low", "high", "first", "node", "component", "bands", "members"],
    )


def _edges(found: list) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _with_components(sketch: DataFrame, by_set: DataFrame) -> DataFrame:
    joined = sketch.join(by_set, ["high", "low"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df``, with their columns as they are, of documents that are kept: the
    smallest id of each component, and rows without an id or words."""
    gone = near_duplicates(df, id_col, text_col, **options).where(~F.col("kept")).select("doc_id").distinct()
    body = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).withColumn(
        "doc_id", F.col(f"row.`{id_col}`").cast("long")
    )
    return body.join(stored(gone, "gone"), "doc_id", "left_anti").select(
        *[F.col(f"row.`{c}`").alias(c) for c in df.columns]
    )
