"""Ranked search, phrase collocations and quality rules against brute force on small tables."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from phenospark.llm import bytewords, collocations, quality, ranking

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
rnd = random.Random(5)
SYLLABLES = ["ka", "to", "Mi", "é", "ß9", "x"]


def words(n, kinds=40):
    return [SYLLABLES[k % 6] + SYLLABLES[k // 6 % 6] + str(k % 3) for k in (min(int(rnd.expovariate(0.15)), kinds) for _ in range(n))]


@pytest.fixture(scope="module")
def corpus():
    rows = [(1, None), (2, ""), (3, " ,.\n"), (None, "ka to ka"), (4, "ka-to KA"), (4, "ka-to KA"), (5, "ka to ka"),
            (6, "日本 ka"), (7, " ".join(words(5000)))]
    rows += [(k, " ".join(words(rnd.randint(1, 60)))) for k in range(10, 150)]
    rows += [(k, "miß9 ka to x") for k in range(200, 260)]
    return rows


def frame(spark, rows, extra="lang string, kept int, m long, cut long, n long, rank int"):
    return spark.createDataFrame(
        [(i, t, "en" if i is None or i % 3 else None, 1, 2, 3, 4, 5) for i, t in rows], f"doc_id long, text string, {extra}"
    )


def brute_ranking(rows, items, k=10):
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWERED)))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    count, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in docs:
            m = 25 + 75 * n * count // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in TERM.findall((text or "").translate(LOWERED)) if t in c
            )
            if score > 0:
                found.append((-score, -1 if i is None else i, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "KA to, unheard"), (2, None), (3, "..."), (4, "日本 x x x 0"), (5, " ".join(words(300))), (None, "miß9")]


@pytest.mark.parametrize("options", [{}, {"segment_terms": 40, "segment_rows": 3}])
@pytest.mark.parametrize("block", [{}, {"block_items": 1}])
def test_search_equals_brute_force(spark, corpus, options, block):
    index = ranking.build_index(frame(spark, corpus), **options)
    items = spark.createDataFrame(ITEMS + ITEMS[:1], "item_id int, text string")
    got = ranking.search(index, items, **block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_ranking(corpus, ITEMS)


def test_search_of_nothing(spark, corpus):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert ranking.search(ranking.build_index(frame(spark, [])), items).count() == 0
    assert ranking.search(ranking.build_index(frame(spark, corpus[:3])), items).count() == 0
    assert ranking.search(ranking.build_index(frame(spark, corpus)), items.limit(0)).count() == 0


def test_segments_whose_bound_is_too_low_are_not_scored():
    rows = [(k, "rare " * 5 + "filler " * 5) for k in range(20)] + [(k, "filler " * 10) for k in range(20, 60)]
    ids, texts = zip(*rows, strict=True)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([50] * 60), pa.array([0] * 20 + [1] * 40), pa.array(ids), pa.array(texts)], names=["m", "cut", "doc_id", "text"]
    )
    segments = next(ranking._segments(iter([batch])))
    assert segments.num_rows == 2
    best, seen = ranking.Best(1, 10), []
    add = best.add
    best.add = lambda q, s, i: (seen.append(len(i)), add(q, s, i))
    by_term = np.array([0, 1, 2]), np.array([0, 0]), np.array([1, 100])
    ranking._visit(segments, pa.array([b"filler", b"rare"]), by_term, best)
    assert seen == [20] and best.rows[0][1].tolist() == list(range(10))


# --- phrases --------------------------------------------------------------------------


def brute_phrases(rows, least, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWERED)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        some = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in some.items():
            s, _, left, right = min(
                (2_000_000 * a // (counts[g[:j]] + counts[g[j:]]), j, counts[g[:j]], counts[g[j:]]) for j in range(1, len(g))
            )
            if not any(
                len(h) > len(g) and 100 * b >= 80 * a and any(h[i:i + len(g)] == g for i in range(len(h))) for h, b in some.items()
            ):
                rows.append((-s, -a, " ".join(g).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("least, top, bits", [(3, 2000, 20), (3, 4, 4), (30, 2000, 18), (300, 5, 12)])
def test_phrases_equal_brute_force(spark, least, top, bits):
    rows = [("en", None), ("en", ""), ("fr", " \t "), (None, "a b c. a b"), ("und", "a b\x0bc a b"), ("en", "x " * 700),
            ("en", "wide space wide space\x1cb")]
    for k in range(400):
        lang = rnd.choice(["en", "de", None])
        text = [rnd.choice(["New York City", "of the", "the", "A", "b", "é", "in spite of it", "york", ",", ".", "\t", "x"])
                for _ in range(rnd.randint(0, 12))]
        rows.append((lang, " ".join(text)))
    df = spark.createDataFrame([(1, l, t, 3, "x") for l, t in rows], "n int, lang string, text string, f int, ids string")
    got = collocations.collocations(df, least=least, top=top, cell_bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, top)


def test_phrases_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty, cell_bits=8).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 6 * 10**15
    w = spark.createDataFrame([("en", 1, "a", big), ("en", 2, "b", big + 1)], "lang string, id long, word string, f long")
    p = spark.createDataFrame([("en", [1, 2], big)], "lang string, ids array<long>, f long")
    row = collocations.rank_phrases(w, p, 30, 10).first()
    assert row["score"] == 2_000_000 * big // (2 * big + 1) and row["n"] == 2 * big + 1


@pytest.mark.parametrize("k", [2, 3, 4])
def test_filters_are_lossless(k):
    rng = np.random.default_rng(k)
    ids = rng.integers(0, 1 << 63, (500, k)).astype("u8")
    ids[::7] = ids[0]
    assert (collocations.restore(collocations.permute(ids)) == ids).all()
    want = Counter(map(tuple, ids.tolist()))
    want[tuple(ids[1].tolist())] += 400
    whole = collocations.Filter(*collocations.summed(collocations.permute(ids), np.ones(500, "i8")))
    more = collocations.Filter(collocations.permute(ids[1:2]), np.array([400]))
    whole = collocations.Filter.merged([whole, more])
    for bits in (1, 4):
        shard = (whole.keys[:, 0] >> np.uint64(64 - bits)).astype("i8")
        got = {}
        for s in np.unique(shard):
            part = collocations.Filter(whole.keys[shard == s], whole.counts[shard == s])
            back = collocations.Filter.of_bytes(part.to_bytes(bits), int(s), bits)
            got |= dict(zip(map(tuple, collocations.restore(back.keys).tolist()), back.counts.tolist(), strict=True))
        assert got == want


def test_word_ids_that_collide_are_dealt_anew(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "a b")], "lang string, text string")
    real, tried = collocations.word_counts, []

    def once_equal(docs, seed):
        tried.append(seed)
        words = real(docs, seed)
        return words.withColumn("id", words["id"] * 0) if seed == 0 else words

    monkeypatch.setattr(collocations, "word_counts", once_equal)
    seed, words_ = collocations.distinct_ids(docs)
    assert seed == 1 and tried == [0, 1] and words_.select("id").distinct().count() == 2


# --- quality --------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeated = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


TEXTS = [None, "", " \t\n", "one", "a b c d e a b c d e", "é ü x\x85y\x1cz", "l1\nl1\n\n\n l1\n\t\nl1\r\nl1\r",
         "a " * 3000, "# * $ % & | < >", "日本 語\n日本 語", " ".join(words(400)) * 2, "x" * 100_000]
TEXTS += ["".join(rnd.choice("ab \n\t\x0b#é") for _ in range(rnd.randint(0, 80))) for _ in range(300)]


def test_counts_equal_brute_force(spark):
    rows = [(k if k % 5 else None, t) for k, t in enumerate(TEXTS)]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    extra = "lang string, kept int, features long, fold_key long, n_words long, p_good int"
    got = quality.apply_rules(frame(spark, rows, extra), labels)
    got = sorted((tuple(r)[:8] for r in got.collect()), key=str)
    want = []
    for i, t in rows:
        c = brute_counts(t)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want.append((i, *c, failed, not failed))  # without labels the trees keep all
    assert got == sorted(want, key=str)


def test_windows_that_share_a_key_are_told_apart(monkeypatch):
    codes, rows = np.array([1, 2, 3, 4, 5, 6] * 2), np.zeros(12, "i8")
    want = quality.repeated_words(codes, rows, 1)
    monkeypatch.setattr(np, "uint64", lambda x: np.asarray(0, "u8"))  # all keys are 0
    assert quality.repeated_words(codes, rows, 1) == want == [12]


def made_up(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4)).round(2)
    logit = 3 * x[:, 0] - 4 * x[:, 1] + np.sin(9 * x[:, 2]) + 0.3
    return x, (rng.random(n) < 1 / (1 + np.exp(-3 * logit))).astype(float)


def test_trees_learn_and_keep_to_their_directions():
    x, y = made_up(3000, 1)
    direction = np.array([1, -1, 0, -1])
    trees = quality.fit_trees(x, y, direction)
    unseen, target = made_up(2000, 2)
    assert ((trees.probabilities(unseen) > 0.5) == target).mean() > 0.85
    for f, d in enumerate(direction):
        if d:
            moved = np.repeat(unseen[:50], 101, axis=0)
            moved[:, f] = np.tile(np.linspace(0, 1, 101), 50)
            steps = np.diff(trees.scores(moved).reshape(50, 101), axis=1)
            assert (d * steps >= -1e-9).all() and (f == 3 or (d * steps > 0).any())
    free = quality.fit_trees(x, y, np.zeros(4, int))
    moved = np.repeat(unseen[:50], 101, axis=0)
    moved[:, 0] = np.tile(np.linspace(0, 1, 101), 50)
    assert (np.diff(free.scores(moved).reshape(50, 101), axis=1) < 0).any()  # the constraint is what does it


def test_flat_nodes_equal_walking_each_tree():
    x, y = made_up(800, 3)
    trees = quality.Trees.of(quality.fit_trees(x, y, np.array([0, -1, 0, 0]), trees=12).flat())

    def walk(row, node):
        while trees.left[node] != node:
            node = trees.right[node] if row[trees.feature[node]] > trees.threshold[node] else trees.left[node]
        return trees.value[node]

    want = [trees.base + sum(walk(r, n) for n in trees.roots) for r in x[:200]]
    assert np.allclose(trees.scores(x[:200]), want)


def test_first_split_is_the_best_one():
    x, y = made_up(300, 4)
    trees = quality.fit_trees(x, y, np.zeros(4, int), trees=1, depth=1, bins=400, least_rows=1)
    g, h = y.mean() - y, np.full(300, y.mean() * (1 - y.mean()))

    def gain(mask):
        return sum(g[m].sum() ** 2 / (h[m].sum() + quality.PENALTY) for m in (mask, ~mask))

    best = max(gain(x[:, f] > t) for f in range(4) for t in np.unique(x[:, f])[:-1])
    assert np.isclose(gain(x[:, trees.feature[0]] > trees.threshold[0]), best)


def test_threshold_loses_few_good_ones():
    rng = np.random.default_rng(1)
    good = rng.random(4000) < 0.8
    p = np.where(good, rng.beta(5, 2, 4000), rng.beta(2, 5, 4000)).round(2)
    least = quality.threshold_of(p, good, 0.01)
    assert 0 < (good & (p < least)).sum() <= 0.01 * good.sum() and (~good & (p < least)).sum() > 100
    assert quality.threshold_of(p, np.ones(4000, bool)) == 0.0 == quality.threshold_of(p, np.zeros(4000, bool))


def test_rules_on_held_out_documents(spark):
    rng = random.Random(9)

    def text(good):
        w = [f"word{rng.randrange(500)}" for _ in range(rng.randint(20, 80))]
        return ". ".join(w) if good else " | ".join(w)

    rows = [(k, text(k % 4 > 0)) for k in range(600)]
    labels = spark.createDataFrame(
        [(k, int(k % 4 > 0), None) for k in range(400)] + [(None, 1, 1), (3, None, 1), (5000, 0, 1)],
        "doc_id int, quality int, features int",
    )
    got = quality.apply_rules(frame(spark, rows), labels).collect()
    assert all(r["kept"] == (r["doc_id"] % 4 > 0) for r in got) and len(got) == 600


def test_all_labelled_rows_grow_the_trees_and_set_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(quality, "KEPT_TREES", 2)  # scores are stored twice
    n, width = 8400, len(quality.FEATURES)
    some, y = made_up(n, 5)
    x = np.zeros((n, width))
    x[:, :4] = some.round(1)  # few values: the edges of a part of the rows are those of all
    fold = np.arange(n) % 3
    measured = spark.createDataFrame(
        [(k, int(fold[k]), x[k].tolist()) for k in range(n)], "doc_id long, fold_key long, features array<double>")
    marks = spark.createDataFrame([(k, int(y[k])) for k in range(n)], "doc_id long, quality int")
    direction = np.array([-1 if f == quality.FEATURES[1] else 0 for f in quality.FEATURES])
    grow = [quality.fit_trees(x[on], y[on], direction, trees=5) for on in (fold != 0, fold != 1, fold != 2, fold > -1)]
    unseen = np.choose(fold, [t.probabilities(x) for t in grow[:3]])
    for options in ({}, {"rows_a_task": 600}):  # 14 tasks, whose sums meet by node
        trees, least = quality.fit(measured, marks, {quality.FEATURES[1]: -1}, trees=5, **options)
        assert np.allclose(trees.flat(), grow[3].flat(), atol=1e-6)
        assert least == pytest.approx(quality.threshold_of(unseen, y == 1), abs=1e-6) and least > 0


def test_edges_of_values_alike_are_values_that_occur(spark):
    x = np.random.default_rng(6).random((3000, len(quality.FEATURES))) - 0.5
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>")
    for found, column in zip(quality.quantile_edges(rows, len(x)), x.T, strict=True):
        want = np.quantile(column, np.linspace(0, 1, quality.BINS + 1)[1:-1], method="lower")
        assert np.isin(found, column).all() and np.allclose(found, want, rtol=1 / 2048, atol=0)


def test_bytes_of_sliced_columns():
    column = pa.array(["ab", "", "é c", "d"]).slice(1, 2)
    data, at = bytewords.bytes_of(column)
    assert data.tobytes() == "é c".encode() and at.tolist() == [0, 0, 4]
    found = bytewords.words_of(data, at, quality.WORD[data])
    assert found.distinct.to_pylist() == ["é".encode(), b"c"] and found.rows.tolist() == [1, 1]
    assert bytewords.bytes_of(pa.array([], pa.string()))[1].tolist() == [0]
