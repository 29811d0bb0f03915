"""Costs, counts, memory, removal and clashing names: the cases that earlier tests left open."""

import hashlib
import math
import os
import random
import re
import time

import numpy as np
import pytest

import corpus_pipeline
from phenospark.llm import lines, minhash, mixing, secrets, toxicity, warc
from phenospark.llm.queries import queries
from phenospark.llm.tokens import LONGEST_KEPT, WordEncoder

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def words():
    return secrets.dictionary(PATH)


def dearest(value, words):
    """The least cost over all segmentations, each tried."""
    walks = secrets.Walks(value)

    def rest(i, tried):
        if i == len(value):
            return 0.0
        switch = secrets.SWITCH if i else 0.0
        found = [(0.0 if tried else switch) + secrets.single(value[i]) + rest(i + 1, True)]
        found += [switch + c + rest(j, False) for j, c in secrets.segments(value, i, words, walks)]
        return min(found)

    return rest(0, False) + (0.0 if value else 0.0)


def test_least_cost_equals_exhaustive_search(words):
    rnd = random.Random(4)
    parts = ["love", "p4ss", "12", "qwe", "aa", "abab", "1999", "Z", "$", "cd", "é", "11", "as"]
    for _ in range(150):
        value = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4)))[:9]
        want = dearest(value, words)
        assert math.isclose(secrets.guess_cost(value, words), want, abs_tol=1e-9), value
        for limit in (3.0, 6.0, 10.0):
            got = secrets.guess_cost(value, words, limit)
            assert math.isclose(got, want, abs_tol=1e-9) if want < limit - 1e-9 else got >= limit - 1e-9


@pytest.mark.parametrize("value, unit, end", [("aaaaa", 1, 5), ("ababa", 2, 4), ("abcabcabd", 3, 6), ("xy", 1, 1), ("a" * 1000 + "b", 1, 1000),
                                              ("ab" * 777 + "a", 2, 1554)])
def test_repeats_go_as_far_as_they_go(value, unit, end):
    assert secrets.repeat_end(value, 0, unit) == end


def test_walks_do_not_depend_on_where_one_asked_before():
    value = "qwertyuasdfgh12345678lkjhgfabcdefgfedc"
    once = secrets.Walks(value)
    for i in range(len(value)):
        assert sorted(once.segments(i)) == sorted(secrets.Walks(value).segments(i)), i


@pytest.mark.parametrize("part", ["a", "as", "x9$K", "abcdefghij", "password", "0123456789", "qwertyuiop"])
def test_very_long_values_take_little_time(words, part):
    value = part * (1_000_000 // len(part))
    start = time.perf_counter()
    secrets.find(f"token={value}", words)
    assert time.perf_counter() - start < 3
    # a unit costs what its characters or its word cost, and the number of repeats
    cheap = bool(secrets.guess_cost(value, words, 10.0) < 10)
    assert cheap == (part in ("a", "as", "password"))


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not there")
def test_secret_query_equals_brute_force(spark, words):
    got = {r["doc_id"]: r for r in queries()["op6_secret_spans"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    seen = [0, 0, 0]
    for doc_id, text in docs:
        text = text or ""
        found = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text, re.A | re.I) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, text) if len(m[0]) >= 18]
        found += [(m.start(), 2, m.end()) for m in re.finditer(secrets.HEX, text) if len(m[0]) >= 16]
        more = [(m.start(1), 3, m.end(1)) for m in secrets.CONTEXT.finditer(text) if secrets.guess_cost(m[1], words) >= 10]
        def joined(spans):
            return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))

        row, counts = got[doc_id], [sum(k == n for _, k, _ in found) for n in range(3)]
        seen = [a + b for a, b in zip(seen, counts, strict=True)]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == counts
        assert row["base_sha256"] == hashlib.sha256(joined(found).encode()).hexdigest()
        assert row["spans"] == joined(found + more)
    assert sum(seen) > 0


def test_the_encoder_forgets_by_bytes_and_keeps_no_long_word():
    encoder = WordEncoder(PATH, cache_bytes=100_000)
    texts = [" ".join(f"w{k}x{i}" for i in range(300)) + " " + "z" * 5000 for k in range(20)]
    for text in texts:
        ids, sizes = encoder.encode([text])
        assert ids.astype("<u4").tobytes() == encoder.plain(text)
        assert encoder.held <= 100_000 and max(map(len, encoder.words)) <= LONGEST_KEPT
    shingles = minhash.Shingles(3)
    shingles("q" * 1000 + " a b")
    assert max(map(len, shingles.known)) <= 32


def test_removal_tells_texts_under_one_id_apart(spark):
    rows = [(1, "the same line here\nfirst"), (2, "a text of its own\nthe same line here"), (2, "nothing in this one repeats at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = lines.repeated_units(df, least_line_words=1)
    left = sorted((r.doc_id, r.text) for r in lines.remove_units(df, gone).collect())
    assert left == [(1, rows[0][1]), (2, "a text of its own\n"), (2, rows[2][1])]


def test_a_page_without_id_comes_back_once(spark):
    rows = [(1, "http://a/x", "<p>one"), (None, "http://a/x", "<p>two"), (3, "http://b/", "<p>two"), (None, "http://c/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    _, shards = warc.write_pages(pages)
    assert warc.look_up(pages, shards, null_is_any=False).count() == 4
    assert warc.look_up(pages.where("page_id is null"), shards).count() == 3


NAMES = "row string, p int, times int, id int, key int, text_key int, mix_id int, mix_copy int, gone_id int, copies int"


def named(spark, rows):
    extra = tuple(range(9))
    return spark.createDataFrame([(i, t, "r", *extra) for i, t in rows], f"doc_id long, text string, {NAMES}, `a.b` int".replace(
        ", `a.b` int", ""
    )).withColumn("a.b", minhash.F.lit(7))


def test_clashing_names_stay(spark):
    rnd = random.Random(2)
    rows = [(k, " ".join(f"w{rnd.randrange(400)}" for _ in range(40))) for k in range(40)]
    rows += [(100, rows[0][1] + " more"), (None, "no id"), (101, None), (102, "")]
    df = named(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, int(k % 5 == 0)) for k in range(40)], "doc_id long, quality int, toxic int")
    near = minhash.drop_near_duplicates(df)
    assert near.schema == df.schema and near.count() == 43
    mixed = mixing.repeat_documents(df, mixing.label_domains(labels), {"fine": 0.7, "poor": 0.3})
    assert mixed.schema == df.schema and mixed.count() >= 44
    assert {r["a.b"] for r in mixed.collect()} == {7}
    clean = toxicity.drop_toxic(df, toxicity.quality_labels(labels))
    assert clean.schema == df.schema and clean.where("doc_id is null or text is null").count() == 2


def plain_rates(p, n, target, lowest, steps=40_000):
    """Projected gradient with a small fixed step on every document's own rate."""
    a = p * n[:, None] / n.sum()
    gram = np.linalg.pinv(a.T @ (p * 1.0))
    r = np.full(len(n), max(1.0, lowest))
    for _ in range(steps):
        r = np.maximum(lowest, r - 0.2 * p @ gram @ (a.T @ r - target))
    return r, a.T @ r


@pytest.mark.parametrize("weights, lowest, met", [((0.5, 0.3, 0.2), 0.0, True), ((0.85, 0.14, 0.01), 0.0, None)])
def test_rates_equal_a_plain_solver(spark, weights, lowest, met):
    rng = np.random.default_rng(7)
    p = rng.dirichlet([2.0, 0.6, 0.4], 300)
    n = rng.integers(1, 200, 300)
    rows = spark.createDataFrame([(int(k), [float(v) for v in x]) for k, x in zip(n, p, strict=True)], "tokens long, p array<double>")
    w = np.array(weights)
    rate, reached, target = mixing.fit_rates(rows, w, lowest)
    got = np.array([r[0] for r in rows.select(rate).collect()])
    want, plain = plain_rates(p, n.astype(float), w, lowest, 4000)
    assert got.min() >= lowest and np.allclose(got @ (p * n[:, None]), reached)
    gram = np.linalg.pinv((p * n[:, None] / n.sum()).T @ p)

    def distance(x):
        return (x - w) @ gram @ (x - w)

    assert distance(reached / n.sum()) <= distance(plain) + 1e-6
    if met is not None:
        assert (np.abs(reached - target).max() <= 1e-6 * n.sum()) == met


def test_shares_are_met_when_documents_may_only_be_added(spark):
    rng = np.random.default_rng(8)
    p = rng.dirichlet([2.0, 0.5], 400)
    rows = spark.createDataFrame([(int(k), [float(v) for v in x]) for k, x in zip(rng.integers(1, 90, 400), p, strict=True)],
                                 "tokens long, p array<double>")
    rate, reached, target = mixing.fit_rates(rows, np.array([0.5, 0.5]), 1.0, grow=True)
    assert min(r[0] for r in rows.select(rate).collect()) >= 1.0
    assert np.allclose(reached / reached.sum(), 0.5, atol=1e-6)


def test_pipeline_on_odd_tables(spark, tmp_path):
    rnd = random.Random(3)
    text = [" ".join(f"w{rnd.randrange(300)}" for _ in range(60)) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(text)] + [(70, text[0]), (71, text[1] + " z"), (72, None), (73, ""), (None, "no id")]
    rows += [(k, "vile vile words " + t) for k, t in zip(range(80, 100), text[::-1], strict=False)]
    named(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k >= 80)) for k in range(100)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in pieces}
    assert 70 in ids and 0 not in ids and 1 in ids and 71 not in ids  # largest of copies, smallest of near ones
    assert not ids & set(range(80, 100)) and None in ids and {72, 73} & ids == {73}
    assert sum(r["length"] for r in pieces if r["doc_id"] == 5) % next(r["doc_tokens"] for r in pieces if r["doc_id"] == 5) == 0
    empty = tmp_path / "empty"
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


@pytest.mark.parametrize("cache", [300, 20_000, 400_000])
def test_words_forgotten_between_batches_give_the_same_ids(cache):
    rng = random.Random(cache)
    encoder = WordEncoder(PATH, cache_bytes=cache)
    for _ in range(12):
        texts = [
            " ".join(rng.choice(["titi", "w%d" % rng.randrange(5000), "Word%s," % chr(97 + rng.randrange(26)),
                                 "İ.", "क़!", "", "(a)", "naïve;", "本İ-"])
                     for _ in range(rng.randrange(200)))
            for _ in range(40)
        ]
        ids, sizes = encoder.encode(texts)
        ends = sizes.cumsum().tolist()
        for text, a, b in zip(texts, [0, *ends], ends):
            assert ids[a:b].astype("<u4").tobytes() == encoder.plain(text)
        assert encoder.held <= cache and len(set(encoder.words)) == len(encoder.words)


def test_a_filling_encoder_keeps_no_word_met_once():
    rng = random.Random(4)
    encoder = WordEncoder(PATH, cache_bytes=40_000)
    for _ in range(6):
        some = ["".join(rng.choices("bcdfghjkz", k=9)) for _ in range(320)]
        texts = [" ".join(some), " ".join(some[:20])]
        full = encoder.held > 10_000
        ids, sizes = encoder.encode(texts)
        assert ids[:sizes[0]].astype("<u4").tobytes() == encoder.plain(texts[0])
        assert ids[sizes[0]:].astype("<u4").tobytes() == encoder.plain(texts[1])
    assert full and set(some[:20]) <= set(encoder.words) and not set(some[20:]) & set(encoder.words)


def test_a_word_is_kept_once_whatever_marks_follow_it():
    rng = random.Random(6)
    letters = ["".join(rng.choices("bcdéfgß", k=9)) for _ in range(200)]
    texts = [" ".join(w + mark for w in letters for mark in ("", ".", ",", "?!", ")")), "Éa É́. (b) x's, " + letters[0]]
    encoder = WordEncoder(PATH)
    for _ in range(2):
        ids, sizes = encoder.encode(texts)
        assert ids[:sizes[0]].astype("<u4").tobytes() == encoder.plain(texts[0])
        assert ids[sizes[0]:].astype("<u4").tobytes() == encoder.plain(texts[1])
        assert set(letters) <= set(encoder.words) and len(encoder.words) < 220
