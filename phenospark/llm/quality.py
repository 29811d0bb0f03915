"""Quality rules: fixed counts, and gradient-boosted trees over document statistics.

The trees are grown on histograms of all labelled rows.  Where these are more than one task holds, a
level takes one pass over their stored bins, in which every task adds up its rows.  Slopes are then added
as integers, so the trees do not depend on how the rows are cut or in which order sums arrive.  On chosen statistics the score
may only fall (or rise): a split that would break this is not taken, and both sides of a
constrained split keep to their side of the middle between them further down.  The fitted
trees are flattened into node arrays, which score a whole column of documents in as many
steps as the trees are deep.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.metrics import score_steps
from .bytewords import byte_class, byte_slices, bytes_of, row_sums, words_of
from .common import stored, texts
from .textmodel import on_sample

FOLDS = 3
ROWS_A_TASK = 65_536  # labelled rows, while the trees grow
TASKS_AT_ONCE = 8  # more tasks than this add up their sums by node before the driver sees them
KEPT_TREES = 10  # trees grown before the scores of the labelled rows are stored again
UNIT = 2.0 ** 30  # slopes and curvatures are added as integers in units of 1 / UNIT
CODE_BITS = 40  # values that differ in the lower bits only share a cell of the quantiles
TREES, DEPTH, BINS, RATE, PENALTY, LEAST_ROWS = 80, 4, 64, 0.15, 1.0, 10
MOST_LOST = 0.005  # of the documents labelled good, out of fold
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5  # fixed values of the base rules

WORD = byte_class(b" \t\n\x0b\x0c\r")
SYMBOL = ~byte_class(b"#*$%&|<>")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeat_words", "capitals", "digits", "full_stops",
    "commas", "exclaims", "bars", "wide_letters", "lines", "closed_lines", "distinct_words", "top_word",
    "longest_word", "white_space",
)
# the probability of good quality may only fall as these rise
FALLING = {"symbols": -1, "dup_lines": -1, "repeat_words": -1}


def repeated_words(codes: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Per row, the words that lie in a window of five words that the row holds twice or more."""
    n = len(codes) - WINDOW + 1
    at = np.flatnonzero(rows[:n] == rows[WINDOW - 1:]) if n > 0 else np.zeros(0, "i8")
    if not len(at):
        return np.zeros(count, "i8")
    parts = [rows[at], *(codes[at + k] for k in range(WINDOW))]
    key = np.zeros(len(at), "u8")
    for p in parts:
        key = (key ^ p.astype("u8")) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    equal = np.logical_and.reduce([p[order][1:] == p[order][:-1] for p in parts])
    if (same != equal).any():  # two windows share a key: compare them as they are
        order = np.lexsort(parts)
        equal = np.logical_and.reduce([p[order][1:] == p[order][:-1] for p in parts])
    twice = np.zeros(len(at), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    step = np.zeros(len(codes) + 1, "i8")
    step[at[twice]] += 1
    step[at[twice] + WINDOW] -= 1
    return np.bincount(rows[np.cumsum(step[:-1]) > 0], minlength=count)


def distinct_pairs(rows: np.ndarray, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The row of each different (row, code), and how often it occurs."""
    found, times = np.unique(rows * max(1, width) + codes, return_counts=True)
    return found // max(1, width), times


def largest(rows: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros(count, "i8")
    np.maximum.at(out, rows, values)
    return out


def measure(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The base counts and the features, a row per text."""
    data, at = bytes_of(column)
    count = len(at) - 1
    inside, leads = WORD[data], (data & 0xC0) != 0x80
    words = words_of(data, at, inside)
    n_words = np.bincount(words.rows, minlength=count)
    chars = row_sums(leads, at)
    word_chars, symbols = row_sums(leads & inside, at), row_sums(SYMBOL[data], at)
    lines = words_of(data, at, data != 10)
    worded = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    n_lines = np.bincount(lines.rows[worded], minlength=count)
    line_rows, _ = distinct_pairs(lines.rows[worded], lines.codes[worded], len(lines.distinct))
    dup_lines = n_lines - np.bincount(line_rows, minlength=count)
    repeats = repeated_words(words.codes, words.rows, count)
    pair_rows, times = distinct_pairs(words.rows, words.codes, len(words.distinct))
    closed = np.isin(data[lines.ends - 1], list(b".!?")) & worded

    def share(x, of):
        return x / np.maximum(1, of)

    def those(characters):
        return share(row_sums(~byte_class(characters)[data], at), chars)

    features = np.stack([
        np.log1p(n_words), share(word_chars, n_words), share(symbols, n_words), share(dup_lines, n_lines),
        share(repeats, n_words), those(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), those(b"0123456789"), those(b"."),
        those(b","), those(b"!?"), share(row_sums(data == ord("|"), at), n_words),
        share(row_sums(data >= 0xC0, at), chars), share(n_lines, n_words),
        share(np.bincount(lines.rows[closed], minlength=count), n_lines),
        share(np.bincount(pair_rows, minlength=count), n_words), share(largest(pair_rows, times, count), n_words),
        np.log1p(largest(words.rows, words.ends - words.starts, count)), share(chars - word_chars, chars),
    ], axis=1)
    return np.stack([n_words, word_chars, symbols, dup_lines, repeats], axis=1), features


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per row of ``df``: doc_id, the base counts, ``features``, and ``fold_key``,
    which equal texts share.  Whole texts; a null text has no words."""
    schema = "doc_id long, fold_key long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"

    def run(batches):
        for batch in batches:
            for some in byte_slices(batch):
                counts, features = measure(some.column("text"))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(features) + 1) * len(FEATURES), pa.int32()), pa.array(features.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("fold_key"), *map(pa.array, counts.T.astype("i8").copy()), lists],
                    names=["doc_id", "fold_key", *COUNTS, "features"],
                )

    keyed = texts(df, id_col, text_col).withColumn("fold_key", F.xxhash64("text"))
    return stored(keyed.mapInArrow(run, schema), "statistics")


@dataclass
class Trees:
    """Node arrays of all trees; a leaf points to itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int = DEPTH

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node that each row reaches in each tree; a value above the threshold goes right."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        line = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[line, self.feature[node]] > self.threshold[node], self.right[node], self.left[node])
        return node

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds of rows of features."""
        return self.base + self.value[self.leaves(x)].sum(axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scores(x), -500, 500)))

    def flat(self) -> np.ndarray:
        columns = (self.feature, self.threshold, self.left, self.right, self.value)
        return np.concatenate([
            [self.base, self.depth, len(self.roots), len(self.feature)], self.roots,
            *[np.asarray(c, float) for c in columns],
        ])

    @classmethod
    def of(cls, flat: np.ndarray) -> Trees:
        base, depth, trees, nodes = flat[0], *(int(v) for v in flat[1:4])
        roots, rest = flat[4:4 + trees].astype("i8"), flat[4 + trees:4 + trees + 5 * nodes].reshape(5, nodes)
        return cls(
            float(base), roots, rest[0].astype("i8"), rest[1], rest[2].astype("i8"), rest[3].astype("i8"), rest[4], depth
        )


class Growth:
    """The trees of one model while they grow, a level at a time, from sums over its rows.

    ``direction`` is 1, -1 or 0 for each feature: how the score may move as the feature rises.  With
    exact sums features that split alike tie, and each tree starts its search at another one (``turns``).
    """

    def __init__(
        self, edges: Sequence[np.ndarray], mean: float, direction: np.ndarray, depth: int = DEPTH, bins: int = BINS,
        rate: float = RATE, penalty: float = PENALTY, least_rows: int = LEAST_ROWS, turns: bool = False,
    ) -> None:
        self.edges, self.direction, self.depth, self.bins = edges, direction, depth, bins
        self.rate, self.penalty, self.least_rows, self.turns = rate, penalty, least_rows, turns
        share = min(max(mean, 1e-6), 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        self.out: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value", "bin")}
        self.roots: list[int] = []
        self.nodes: list[int] = []  # those of the last level, which may still split
        self.limits: list[tuple[float, float]] = []

    def add_node(self) -> int:
        at = len(self.out["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", 0.0), ("bin", np.inf)):
            self.out[k].append(v)
        return at

    def start_tree(self) -> None:
        self.roots.append(self.add_node())
        self.nodes, self.limits = [self.roots[-1]], [(-np.inf, np.inf)]

    def weight(self, g, h, low, high):
        return np.clip(-g / (h + self.penalty), low, high)

    def weigh(self, sums: np.ndarray) -> np.ndarray:
        """The weights of the nodes of the last level, from the sums that ``split`` takes."""
        total_g, total_h = sums[:2, :, 0].sum(axis=2)
        weight = self.weight(total_g, total_h, *np.array(self.limits).T)
        for node, w in zip(self.nodes, weight, strict=True):
            self.out["value"][node] = float(self.rate * w)
        return weight

    def split(self, sums: np.ndarray) -> None:
        """Split the nodes of the last level by their sums: (slope, curvature, rows) x node x feature x bin."""

        def gain_of(g, h, w):
            return -(g * w + 0.5 * (h + self.penalty) * w * w)

        weight = self.weigh(sums)
        total_g, total_h = sums[:2, :, 0].sum(axis=2)
        low, high = np.array(self.limits).T
        gl, hl, cl = np.cumsum(sums, axis=3)
        gr, hr, cr = gl[..., -1:] - gl, hl[..., -1:] - hl, cl[..., -1:] - cl
        wl = self.weight(gl, hl, low[:, None, None], high[:, None, None])
        wr = self.weight(gr, hr, low[:, None, None], high[:, None, None])
        gain = gain_of(gl, hl, wl) + gain_of(gr, hr, wr) - gain_of(total_g, total_h, weight)[:, None, None]
        allowed = (cl >= self.least_rows) & (cr >= self.least_rows) & (self.direction[None, :, None] * (wr - wl) >= 0)
        turn = (len(self.roots) - 1) % len(self.edges) if self.turns else 0
        gain = np.roll(np.where(allowed, gain, -np.inf), -turn, axis=1).reshape(len(self.nodes), -1)
        pick = gain.argmax(axis=1)
        new_nodes, new_limits = [], []
        for i, node in enumerate(self.nodes):
            if gain[i, pick[i]] <= 1e-6:
                continue
            f, b = divmod(int(pick[i]), self.bins)
            f = (f + turn) % len(self.edges)
            (lo, hi), middle = self.limits[i], float(wl[i, f, b] + wr[i, f, b]) / 2
            children = self.add_node(), self.add_node()
            for k, v in (("feature", f), ("threshold", float(self.edges[f][b])), ("bin", b),
                         ("left", children[0]), ("right", children[1])):
                self.out[k][node] = v
            left, right = [lo, hi], [lo, hi]
            if self.direction[f] > 0:
                left[1], right[0] = middle, middle
            elif self.direction[f] < 0:
                left[0], right[1] = middle, middle
            for child, g, h, side in ((children[0], gl, hl, left), (children[1], gr, hr, right)):
                self.out["value"][child] = float(self.rate * self.weight(g[i, f, b], h[i, f, b], *side))
            new_nodes += children
            new_limits += [tuple(left), tuple(right)]
        self.nodes, self.limits = new_nodes, new_limits

    def binned(self, first: int = 0) -> Trees:
        """The trees from number ``first`` on, for rows of bins."""
        at = self.roots[first] if first < len(self.roots) else len(self.out["value"])
        part = {k: np.array(v[at:]) for k, v in self.out.items()}
        return Trees(
            0.0, np.array(self.roots[first:], "i8") - at, part["feature"], part["bin"], part["left"] - at,
            part["right"] - at, part["value"], self.depth,
        )

    def live(self, first: int = 0) -> np.ndarray:
        """The place of each node of ``binned(first)`` among those of the last level, else -1."""
        at = self.roots[first]
        places = np.full(len(self.out["value"]) - at, -1)
        places[np.array(self.nodes, "i8") - at] = np.arange(len(self.nodes))
        return places

    def trees(self) -> Trees:
        columns = (np.array(self.out[k]) for k in ("feature", "threshold", "left", "right", "value"))
        return Trees(self.base, np.array(self.roots), *columns, self.depth)


def bins_of(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)


def add_trees(score: np.ndarray, trees: Trees, leaves: np.ndarray) -> np.ndarray:
    """One tree after the other, so that a score is the same wherever it was stored in between."""
    for reached in leaves.T:
        score = score + trees.value[reached]
    return score


def level_sums(
    binned: np.ndarray, y: np.ndarray, score: np.ndarray, trees: Trees, live: np.ndarray, bins: int,
    whole: bool = False,
) -> np.ndarray:
    """Slope, curvature and rows by node of the last level, feature and bin.  ``score`` lacks ``trees``,
    the last of which is growing.  With ``whole`` each row's slope and curvature are integers, in units of
    1 / UNIT, which doubles add without error below 2^53."""
    n, width = binned.shape
    leaves = trees.leaves(binned)
    place, count = live[leaves[:, -1]], int(live.max()) + 1
    p = 1 / (1 + np.exp(-add_trees(score, trees, leaves[:, :-1])))
    slopes = p - y, np.maximum(p * (1 - p), 1e-9), np.ones(n)
    if whole:
        slopes = np.rint(slopes[0] * UNIT), np.rint(slopes[1] * UNIT), slopes[2]
    on = place >= 0
    cell = ((place[on, None] * width + np.arange(width)) * bins + binned[on]).ravel()
    return np.stack([
        np.bincount(cell, np.repeat(v[on], width), count * width * bins) for v in slopes
    ]).reshape(3, count, width, bins)


def fit_trees(
    x: np.ndarray, y: np.ndarray, direction: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
    rate: float = RATE, penalty: float = PENALTY, least_rows: int = LEAST_ROWS,
) -> Trees:
    """Boost the logistic loss on rows at hand."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    growth, binned = Growth(edges, float(y.mean()), direction, depth, bins, rate, penalty, least_rows), bins_of(x, edges)
    score = np.full(len(x), growth.base)
    for t in range(trees):
        growth.start_tree()
        for level in range(depth + 1):
            if growth.nodes:
                sums = level_sums(binned, y, score, growth.binned(t), growth.live(t), bins)
                growth.split(sums) if level < depth else growth.weigh(sums)
        last = growth.binned(t)
        score = add_trees(score, last, last.leaves(binned))
    return growth.trees()


def threshold_of(p: np.ndarray, good: np.ndarray, most_lost: float = MOST_LOST) -> float:
    """The probability of good quality below which a text goes: where most are judged as labelled,
    lowered until no more than ``most_lost`` of the good ones are lost; 0 without bad ones."""
    if good.all() or not good.any():
        return 0.0
    order = np.argsort(p, kind="stable")
    ranked, value = good[order], p[order]
    wrong = np.concatenate([[0], np.cumsum(ranked)]) + (~ranked).sum() - np.concatenate([[0], np.cumsum(~ranked)])
    edge = np.concatenate([[True], value[1:] != value[:-1], [True]])
    lost = np.concatenate([[0], np.cumsum(ranked)]) <= most_lost * good.sum()
    k = int(np.where(edge & lost, wrong, len(p) + 1).argmin())
    if k == 0:
        return 0.0
    return float((value[k - 1] + (value[k] if k < len(p) else 1.0)) / 2)


def threshold_over(rows: DataFrame, most_lost: float = MOST_LOST) -> float:
    """``threshold_of`` on a table of label and score."""
    steps = score_steps(rows)
    if not steps.positives or not steps.negatives:
        return 0.0
    lost = F.lit(steps.positives) - F.col("tp")
    best = steps.rows.where(lost <= most_lost * steps.positives).orderBy(lost + F.col("fp"), "threshold").first()
    below = steps.rows.where(F.col("threshold") < best["threshold"]).agg(F.max("threshold")).first()[0]
    return 0.0 if below is None else (below + best["threshold"]) / 2


def feature_rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))


def quantile_edges(labelled: DataFrame, n: int, bins: int = BINS) -> list[np.ndarray]:
    """Per feature, the values that cut its ``n`` rows into ``bins`` parts, each a value that occurs.

    All rows are counted, in cells of values equal but for their last ``CODE_BITS`` bits (one part in
    4,096); an edge is the highest value of its cell.  The cells, whose number does not grow with the
    rows, are added up in order, a feature a task.
    """

    def run(batches):
        for batch in batches:
            for f, values in enumerate(np.sort(feature_rows(batch) + 0.0, axis=0).T):
                bits = values.copy().view("i8")
                code = (bits ^ ((bits >> 63) & np.iinfo("i8").max)) >> CODE_BITS
                last = np.flatnonzero(np.append(code[1:] != code[:-1], True)) if len(code) else np.zeros(0, "i8")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(last), f, "i4")), pa.array(code[last]),
                    pa.array(np.diff(last, prepend=-1)), pa.array(values[last]),
                ], names=["feature", "code", "rows", "value"])

    cells = labelled.select("features").mapInArrow(run, "feature int, code long, rows long, value double").groupBy(
        "feature", "code"
    ).agg(F.sum("rows").alias("rows"), F.max("value").alias("value"))
    until = F.sum("rows").over(Window.partitionBy("feature").orderBy("code"))
    ranks = F.array(*[F.lit(k * (n - 1) // bins).cast("long") for k in range(1, bins)])
    wanted = F.exists(ranks, lambda r: (r >= F.col("until") - F.col("rows")) & (r < F.col("until")))
    found = cells.withColumn("until", until).where(wanted).select("feature", "value").collect()
    return [np.unique([r["value"] for r in found if r["feature"] == f]) for f in range(len(FEATURES))]


BINNED = "good boolean, fold int, bins binary, scores array<double>"


def binned_rows(batch: pa.RecordBatch, models: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels, folds and the stored scores of every model."""
    n = batch.num_rows
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), "u1").reshape(n, len(FEATURES))
    good = batch.column("good").to_numpy(zero_copy_only=False).astype(float)
    scores = batch.column("scores").flatten().to_numpy().reshape(n, models)
    return bins, good, batch.column("fold").to_numpy(), scores


def with_bins(labelled: DataFrame, edges: list[np.ndarray], base: list[float], tasks: int) -> DataFrame:
    """The labelled rows as ``BINNED``, stored in ``tasks`` parts."""

    def run(batches):
        for batch in batches:
            bins = bins_of(feature_rows(batch), edges).astype("u1")
            yield pa.RecordBatch.from_arrays([
                pa.array(batch.column("good").to_numpy() == 1), batch.column("fold"),
                pa.array([r.tobytes() for r in bins], pa.binary()),
                pa.array([base] * len(bins), pa.list_(pa.float64())),
            ], names=["good", "fold", "bins", "scores"])

    return stored(labelled.repartition(tasks).mapInArrow(run, BINNED), "binned")


def with_scores(rows: DataFrame, parts: list[Trees]) -> DataFrame:
    """The rows with the scores after ``parts``, stored."""

    def run(batches):
        for batch in batches:
            bins, _, _, scores = binned_rows(batch, len(parts))
            new = np.stack([
                add_trees(s, t, t.leaves(bins)) for s, t in zip(scores.T, parts, strict=True)], axis=1)
            yield batch.set_column(3, "scores", pa.array(list(new), pa.list_(pa.float64())))

    return stored(rows.mapInArrow(run, BINNED), "binned")


def table_sums(
    rows: DataFrame, models: Sequence[int], growths: Sequence[Growth], first: int, tasks: int,
) -> list[np.ndarray | None]:
    """``level_sums`` of every model over all of its rows, in one pass; None for a model without nodes to split.

    Model ``m`` is that without the rows of fold ``m``; -1 has all.  A task adds up its rows.  Where tasks are
    many, their sums meet by model and node.
    """
    work = [
        (m, k, g.binned(first), g.live(first)) for k, (m, g) in enumerate(zip(models, growths, strict=True)) if g.nodes
    ]
    count, shape = len(models), (3, len(FEATURES), BINS)
    schema = "model int, node int, sums binary"

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            bins, good, fold, scores = binned_rows(batch, count)
            for m, k, trees, live in work:
                on = fold != m
                if on.any():
                    found = level_sums(bins[on], good[on], scores[on, k], trees, live, BINS, True).astype("i8")
                    sums[k] = sums[k] + found if k in sums else found
        cells = [(k, node, s[:, node].tobytes()) for k, s in sums.items() for node in range(s.shape[1])]
        if cells:
            columns = zip(*cells, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()), strict=True)],
                names=["model", "node", "sums"],
            )

    def add_up(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_py(), "i8") for s in table.column("sums"))
        return table.slice(0, 1).set_column(2, "sums", pa.array([total.tobytes()], pa.binary()))

    parts = rows.mapInArrow(run, schema)
    if tasks > TASKS_AT_ONCE:
        parts = parts.groupBy("model", "node").applyInArrow(add_up, schema)
    out: list[np.ndarray | None] = [
        np.zeros((3, len(g.nodes), *shape[1:]), "i8") if g.nodes else None for g in growths
    ]
    for r in parts.collect():
        out[r["model"]][:, r["node"]] += np.frombuffer(r["sums"], "i8").reshape(shape)
    unit = np.array([UNIT, UNIT, 1.0])[:, None, None, None]
    return [None if sums is None else sums / unit for sums in out]


def grow_on_table(
    rows: DataFrame, models: Sequence[int], growths: Sequence[Growth], trees: int, tasks: int,
) -> tuple[DataFrame, int]:
    """Grow all trees of all models, a pass over the rows a level; the rows with the scores last stored, and
    the first tree that these lack."""
    first = 0
    for t in range(trees):
        if t - first == KEPT_TREES:
            rows, first = with_scores(rows, [g.binned(first) for g in growths]), t
        for g in growths:
            g.start_tree()
        for _ in range(DEPTH):
            if any(g.nodes for g in growths):
                for g, sums in zip(growths, table_sums(rows, models, growths, first, tasks), strict=True):
                    if sums is not None:
                        g.split(sums)
    return rows, first


def fit_at_once(labelled: DataFrame, direction: np.ndarray, folds: int, trees: int) -> tuple[Trees, float]:
    """The fit of labelled rows that make up one task."""

    def work(columns):
        x, y, fold = np.array(columns["features"], float), np.array(columns["good"]) == 1, np.array(columns["fold"])
        order = np.lexsort((y, fold, *x.T))  # sums do not depend on how the rows arrive
        x, y, fold = x[order], y[order], fold[order]
        unseen = np.full(len(y), y.mean())
        for f in range(folds):
            held = fold == f
            if held.any() and not held.all():
                unseen[held] = fit_trees(x[~held], y[~held].astype(float), direction, trees).probabilities(x[held])
        return np.concatenate([[threshold_of(unseen, y)], fit_trees(x, y.astype(float), direction, trees).flat()])

    flat = on_sample(labelled, work)
    return Trees.of(flat[1:]), float(flat[0])


def fit(
    measured: DataFrame, labels: DataFrame, falling: Mapping[str, int] = FALLING, folds: int = FOLDS,
    trees: int = TREES, rows_a_task: int = ROWS_A_TASK,
) -> tuple[Trees | None, float]:
    """Trees for the probability of good quality and the least one that stays.

    Fitted on all labelled documents: a pass a level over their bins, or, where no more than ``rows_a_task``
    of them make up one task, all inside it.  Both grow the same trees but for ties and the last
    digits of sums and edges.  Label rows with a null are left out; of several for one id, or several texts under one, the least counts.  The threshold
    comes from predictions out of fold.  Without labelled rows there are no trees.
    """
    known = labels.dropna(subset=["doc_id", "quality"]).groupBy(
        F.col("doc_id").cast("long").alias("labelled_id")
    ).agg(F.min(F.col("quality").cast("int")).alias("good"))
    labelled = stored(measured.join(known, F.col("doc_id") == F.col("labelled_id")).groupBy("labelled_id").agg(
        F.min(F.struct("good", "fold_key", "features")).alias("s")
    ).select("s.good", F.pmod("s.fold_key", F.lit(folds)).cast("int").alias("fold"), "s.features"), "labelled")
    counted = labelled.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.sum((F.col("good") == 1).cast("long")).alias("good")
    ).collect()
    n, good = sum(r["rows"] for r in counted), sum(r["good"] for r in counted)
    if not n:
        return None, 0.0
    direction, tasks = np.array([falling.get(f, 0) for f in FEATURES]), -(-n // rows_a_task)
    if tasks == 1:
        return fit_at_once(labelled, direction, folds, trees)
    sizes = {r["fold"]: (n - r["rows"], good - r["good"]) for r in counted if r["rows"] < n} | {-1: (n, good)}
    models = sorted(sizes)
    edges = quantile_edges(labelled, n)
    growths = [Growth(edges, sizes[m][1] / sizes[m][0], direction, turns=True) for m in models]
    rows = with_bins(labelled, edges, [g.base for g in growths], tasks)
    rows, first = grow_on_table(rows, models, growths, trees, tasks)
    parts = [g.binned(first) for g in growths]

    def unseen(batches):
        for batch in batches:
            bins, marks, fold, scores = binned_rows(batch, len(models))
            p = np.full(len(bins), good / n)
            for k, m in enumerate(models):
                held = fold == m
                score = add_trees(scores[held, k], parts[k], parts[k].leaves(bins[held]))
                p[held] = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
            yield pa.RecordBatch.from_arrays([pa.array(marks.astype("i4")), pa.array(p)], names=["label", "score"])

    return growths[0].trees(), threshold_over(rows.mapInArrow(unseen, "label int, score double"))


def apply_rules(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int,
) -> DataFrame:
    """One row per row of ``df``: doc_id, the base counts, base_failed, kept, p_good.

    ``labels`` has doc_id and quality (1 good, 0 bad).  A null, empty or wordless text fails the base
    rules.  Null and repeated ids stay as they are; an empty table gives an empty one.
    """
    measured = statistics(df, id_col, text_col)
    trees, least = fit(measured, labels, **options)
    shared = df.sparkSession.sparkContext.broadcast(trees)  # bounded by trees x nodes

    def run(batches):
        model = shared.value
        for batch in batches:
            x = feature_rows(batch)
            p = model.probabilities(x) if model and len(x) else np.ones(len(x))
            kept = [batch.column(c) for c in ("doc_id", *COUNTS)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p, pa.float64())], names=["doc_id", *COUNTS, "p_good"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", p_good double"
    scored = measured.select("doc_id", *COUNTS, "features").mapInArrow(run, schema)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("p_good") >= least)).alias("kept"), "p_good"
    )
