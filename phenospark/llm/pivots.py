"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest reference points in order.  Inverted lists, one per
label and reference point, hold the vectors that have the point among their first ``near``.
Two vectors are candidates when they share at least ``shared`` points; candidates are
verified by cosine in double precision.  A pair is worked on in the list of its smallest
shared point only.  Lists are cut into chunks and pairs of chunks go to different tasks, and a
task gives counts and a spanning forest instead of pairs, so a hot list neither meets in one
task nor turns into pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

PIVOTS = 256
NEAR = 8
SHARED = 2
CHUNK = 1024
LINK = 0.98


def unit_rows(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which rows have one: no null, no null or
    non-finite component, not zero, not empty."""
    out, good = [], []
    for row in rows:
        v = np.array([np.nan if x is None else x for x in row or ()], "f8")
        top = np.abs(v).max() if len(v) else 0.0
        ok = len(v) > 0 and bool(np.isfinite(v).all()) and top > 0
        if ok:
            v = v / top  # squares of very large or small components stay in range
            v = v / np.linalg.norm(v)
        out.append(v)
        good.append(ok)
    return out, np.array(good, bool)


def reference_points(vectors: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """At most ``pivots`` vectors of the table, by hash of the id, as unit rows per length."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vector").collect()
    by_size: dict[int, list] = {}
    for row in rows:
        v = np.array(row["vector"])
        by_size.setdefault(len(v), []).append(v)
    return {n: np.stack(v) for n, v in by_size.items()}


def nearest_points(vectors: np.ndarray, points: np.ndarray, near: int) -> np.ndarray:
    """Numbers of the nearest reference points, nearest first."""
    return np.argsort(-(vectors @ points.T), axis=1, kind="stable")[:, :near]


def masks(prefix: np.ndarray, pivots: int) -> np.ndarray:
    """The points of each prefix as bits."""
    words = -(-pivots // 64)
    out = np.zeros((len(prefix), words), "u8")
    rows = np.arange(len(prefix))
    for column in prefix.T:
        out[rows, column // 64] |= np.uint64(1) << (column % 64).astype("u8")
    return out


def tile(x, mx, y, my, pivot: int, shared: int, link: float) -> np.ndarray:
    """Which pairs of two chunks are linked and belong to this pivot's list."""
    count = np.zeros((len(mx), len(my)), "u1")
    earlier = np.zeros((len(mx), len(my)), bool)
    for word in range(mx.shape[1]):
        both = mx[:, word][:, None] & my[:, word][None]
        count += np.bitwise_count(both)
        if word < pivot // 64:
            earlier |= both != 0
        elif word == pivot // 64:
            earlier |= (both & np.uint64((1 << pivot % 64) - 1)) != 0
    i, j = np.nonzero((count >= shared) & ~earlier)
    linked = np.zeros(count.shape, bool)
    for k in range(0, len(i), 1 << 18):
        a, b = i[k:k + (1 << 18)], j[k:k + (1 << 18)]
        linked[a, b] = np.einsum("ij,ij->i", x[a], y[b]) >= link
    return linked


def forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest id that each vector (left, then right) reaches inside the tile."""
    low, high = left.copy(), right.copy()
    big = np.iinfo("i8").max
    while True:
        near = np.minimum(low, np.where(linked, high[None], big).min(axis=1, initial=big))
        far = np.minimum(high, np.where(linked, near[:, None], big).min(axis=0, initial=big))
        if (near == low).all() and (far == high).all():
            return np.concatenate([low, high])
        low, high = near, far


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    link: float = LINK, pivots: int = PIVOTS, near: int = NEAR, shared: int = SHARED,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per id: vec_id, n_links, component_id, kept.

    Vectors are compared where labels are equal and not null and lengths agree; a vector that is null,
    empty or zero, or holds a null or non-finite component, links with nothing, nor does one
    with a null id.  Rows that repeat an id are one vector, the first by value.  Reference
    points are a bounded sample of the table (``pivots``); every vector is indexed.
    """
    spark = df.sparkSession
    all_rows = stored(
        df.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.struct(
                F.col(vector_col).cast("array<double>").alias("vector"),
                F.col(label_col).cast("string").alias("label"),
            ).alias("row"),
        ).groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.vector", "row.label"),
        "vectors",
    )

    def units(batches):
        for batch in batches:
            vectors, good = unit_rows(batch.column("vector").to_pylist())
            mask = pa.array(good)
            kept = [v for v, ok in zip(vectors, good, strict=True) if ok]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").filter(mask), pa.array(kept, pa.list_(pa.float64())),
                batch.column("label").filter(mask),
            ], names=["vec_id", "vector", "label"])

    usable = all_rows.where("vec_id is not null and label is not null and vector is not null")
    vectors = stored(
        usable.mapInArrow(units, "vec_id long, vector array<double>, label string"), "units"
    )
    points = spark.sparkContext.broadcast(reference_points(vectors, pivots))
    sizes = F.count(F.lit(1)).alias("n")

    def describe(batches):
        for batch in batches:
            rows = batch.column("vector").to_pylist()
            lists = []
            for row in rows:
                known = points.value.get(len(row))
                if known is None:  # a length that the sample missed: one list for all
                    lists.append([0] * shared)
                else:
                    lists.append(nearest_points(np.array(row)[None], known, near)[0].tolist())
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), pa.array([len(r) for r in rows], pa.int32()),
                batch.column("vector"), pa.array(lists, pa.list_(pa.int32())),
            ], names=["vec_id", "label", "size", "vector", "prefix"])

    described = stored(vectors.mapInArrow(
        describe, "vec_id long, label string, size int, vector array<double>, prefix array<int>"
    ), "described")
    postings = described.withColumn("pivot", F.explode(F.array_distinct("prefix")))
    key = ["label", "size", "pivot"]
    chunks = stored(postings.groupBy(*key).agg(sizes).select(
        *key, F.ceil(F.col("n") / chunk).cast("int").alias("chunks")
    ).where("n > 1"), "lists")
    own = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")
    spread = postings.join(chunks, key).withColumn("own", own).select(
        *key, "vec_id", "vector", "prefix", "own",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"),
    ).withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    width = pivots

    def work(key: tuple, table: pa.Table) -> pa.Table:  # two chunks of one list
        pivot, low, high = key[2].as_py(), key[3].as_py(), key[4].as_py()
        ids = table.column("vec_id").to_numpy()
        x = np.stack(table.column("vector").to_numpy()).astype("f8")
        prefix = np.stack(table.column("prefix").to_numpy())
        bits = masks(prefix, width)
        need = min(shared, int(np.bitwise_count(bits).sum(axis=1).min()))
        side = table.column("own").to_numpy() == low
        a = np.flatnonzero(side)
        b = a if low == high else np.flatnonzero(~side)
        linked = tile(x[a], bits[a], x[b], bits[b], pivot, need, link)
        if low == high:
            np.fill_diagonal(linked, False)
            n, root, who = linked.sum(axis=1), forest(linked, ids[a], ids[a])[:len(a)], ids[a]
        else:
            n = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
            root, who = forest(linked, ids[a], ids[b]), np.concatenate([ids[a], ids[b]])
        some = n > 0
        return pa.Table.from_arrays(
            [pa.array(who[some]), pa.array(n[some].astype("i8")), pa.array(root[some])],
            names=["vec_id", "n", "root"],
        )

    found = stored(
        spread.groupBy(*key, "low", "high").applyInArrow(work, "vec_id long, n long, root long"), "links"
    )
    links = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    groups = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    return all_rows.select("vec_id").join(links, "vec_id", "left").join(
        groups.withColumnRenamed("node", "vec_id"), "vec_id", "left"
    ).select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
