"""The operators on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from phenospark.llm import exact_dedup, lines, minhash, mixing, packing, pivots, rans, secrets, toxicity, warc
from phenospark.llm.queries import queries

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, kept int, digest string, n int, row string, part int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", 3) for i, t in rows], DOCS)


rnd = random.Random(11)
VOCABULARY = [f"word{k}" for k in range(300)]
LONG = " ".join(rnd.choice(VOCABULARY) for _ in range(9000))


def prose(n):
    return " ".join(rnd.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    found = [(1, None), (2, ""), (3, "Same Text"), (4, "same text"), (5, "É same"), (6, "é same"), (7, LONG),
             (8, LONG + " end"), (None, "no id"), (9, "a b"), (10, "A b"), (11, " \n\t "), (12, "Same text")]
    for k in range(20, 60, 4):
        base = prose(60).split()
        for j in range(4):
            words = list(base)
            for _ in range(j * 2):
                words[rnd.randrange(len(words))] = rnd.choice(VOCABULARY)
            found.append((k + j, " ".join(words)))
    found.append((3, "Same Text"))
    return found


def lowered(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_exact_groups(spark, rows, counters):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    got = exact_dedup.duplicate_groups(documents(spark, rows), counters=counters).collect()
    want = []
    for i, t in rows:
        ids = [x for x in groups[lowered(t)] if x is not None]
        keep = max(ids, default=None)
        want.append((i, keep, len(groups[lowered(t)]), i == keep, hashlib.sha256(lowered(t).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_exact_stage_keeps_columns_and_one_row_a_text(spark, rows):
    df = documents(spark, rows)
    got = exact_dedup.drop_duplicates(df, counters=2)
    assert got.columns == df.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == len({lowered(t) for _, t in rows}) and (12, "Same text") in kept and (2, "") in kept


def brute_near(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = lowered(t).encode().split()
        if i is not None:
            sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("words", "percent", "bands"), [
    (3, 85, {}), (5, 80, {}), (3, 60, {"bands": 80, "rows": 2}),  # lower thresholds need shorter bands
])
def test_near_duplicates_equal_brute_force(spark, rows, words, percent, bands):
    got = minhash.near_duplicates(documents(spark, rows), words=words, percent=percent, **bands).collect()
    want = brute_near(rows, words, percent)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_bucket_rest_is_compared_in_chunks(spark, rows, monkeypatch):
    """Where the star finds nothing, the chunked comparison alone finds every link."""
    monkeypatch.setattr(minhash, "CHUNK", 2)
    monkeypatch.setattr(minhash, "confirm", lambda docs, pairs, *_: docs.sparkSession.createDataFrame([], "a long, b long"))
    some = [r for r in rows if r[0] is not None and r[0] >= 20]
    got = minhash.near_duplicates(documents(spark, some), words=3, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_near(some, 3, 85)


def vectors():
    rng = np.random.default_rng(4)
    found = []
    for k in range(12):
        base = rng.normal(size=16)
        found += [(10 * k + j, (base + 0.1 * j * rng.normal(size=16)).tolist(), k % 3) for j in range(4)]
    found += [(200, None, 1), (201, [], 1), (202, [0.0] * 16, 1), (203, [None] + [1.0] * 15, 1), (204, [float("nan")] * 16, 1),
              (205, [float("inf")] * 16, 1), (206, found[0][1], None), (207, found[0][1], 2), (208, [1.0, 2.0], 0),
              (209, [2.0, 4.0], 0), (210, [3e200] * 16, 0), (211, [3e-200] * 16, 0), (None, found[0][1], 0), found[0]]
    return found


@pytest.mark.parametrize("options", [{}, {"chunk": 3}, {"pivots": 1}])
def test_pivot_index_equals_brute_force(spark, options):
    rows = vectors()
    df = spark.createDataFrame([(*r, 5, "z") for r in rows], "vec_id long, embedding array<double>, label int, pivot int, chunks string")
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v) / np.abs(v).max()
            usable[i] = (label, u / np.linalg.norm(u))
    near = {i: [j for j, (m, y) in usable.items() if j != i and m == k and len(x) == len(y) and x @ y >= 0.98]
            for i, (k, x) in usable.items()}
    got = pivots.near_duplicates(df, **options).collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        seen, todo = {r.vec_id}, [r.vec_id]
        while todo:
            new = set(near.get(todo.pop(), ())) - seen
            seen |= new
            todo += new
        assert r.n_links == len(near.get(r.vec_id, ()))
        assert r.component_id == (None if r.vec_id is None else min(seen)) and r.kept == (r.component_id == r.vec_id)


def ids_of(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_rans_files_round_trip(spark, rows, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK", 512)
    back = rans.round_trip(documents(spark, rows), PATH).collect()
    ordered = sorted(back, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [None, *sorted(i for i, _ in rows if i is not None)]
    at = 0
    for r in ordered:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    assert sorted(crc(ids_of(t)) for _, t in rows) == sorted(zlib.crc32(r.ids) for r in back)


def test_damage_is_found(spark, rows, tmp_path):
    table = rans.Table(np.array([2, 5]), np.array([3.0, 1.0]))
    with open(tmp_path / "f", "wb") as out:
        writer = rans.Writer(out, table, block=4)
        writer.add(1, np.array([5, 2, 2], "<u4").tobytes())
        writer.add(None, np.array([2] * 9, "<u4").tobytes())
        assert writer.close() == 12
    path = str(tmp_path / "f")
    found = list(rans.decode_range(rans.Ranges(), path, table, 0, 12))
    assert [(d, s, v.tolist()) for d, s, v in found] == [(1, 0, [5, 2, 2]), (None, 3, [2] * 9)]
    data = bytearray((tmp_path / "f").read_bytes())
    data[20] ^= 1
    (tmp_path / "f").write_bytes(data)
    with pytest.raises(ValueError):
        list(rans.decode_range(rans.Ranges(), path, table, 0, 12))


@pytest.mark.parametrize("window", [16, 4096])
def test_packing(spark, rows, window):
    pieces = packing.pack(documents(spark, rows), PATH, window=window).collect()
    stream = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    total = sum(len(ids_of(t)) for _, t in rows)
    at = 0
    for r in stream:
        assert r.sequence_id * window + r.offset == at and r.offset + r.length <= window and r.length > 0
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        at += r.length
    assert at == total
    docs, held = [], []
    for r in stream:
        held += np.frombuffer(r.ids, "<u4").tolist()
        if r.start + r.length == r.doc_tokens:
            docs.append((r.doc_id, tuple(held)))
            held = []
    assert sorted(docs, key=str) == sorted(((i, tuple(ids_of(t))) for i, t in rows), key=str)


def test_warc_index(spark):
    pages = [(1, "http://a.com/x", "same"), (2, "http://a.com/x", "same"), (3, None, None), (4, "", ""), (5, "bad url\n", "é" * 9000),
             (6, "http://b.org/", "same"), (7, "http://a.com/y?q", "own"), (None, "http://n.org/", "none")]
    pages += [(100 + k, f"http://h{k % 7}.net/{k}", f"page {k % 30}") for k in range(90)]
    df = spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, key string")
    _, shards = warc.write_pages(df)
    got = warc.look_up(df, shards).collect()
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    assert len(got) == len(pages)
    for i, _, h in pages:
        r = next(x for x in got if x.page_id == i)
        own = first.get(h or "", i) == i
        assert r.payload_bytes == len((h or "").encode()) and r.record_type == ("response" if own else "revisit")
        assert r.refers_to == (None if own else first[h or ""])
    one = spark.createDataFrame([("http://A.com/x", None), ("http://missing/", None)], "url string, page_id long")
    assert sorted(r.page_id for r in warc.look_up(one, shards).collect()) == [1, 2]


def test_repeated_units(spark):
    line = "this line has more than six words in it"
    rows = [(5, f"{line}\nown words stand here alone in five"), (2, f"x\n{line.upper()}  "), (9, line), (None, None), (7, ""), (8, "short\nshort"),
            (10, f"Before it. {line.capitalize()}. After it ends the text of ten.")]
    df = documents(spark, rows)
    gone = lines.repeated_units(df)
    got = {(r.doc_id, r.start, r.end, r.keep_doc_id) for r in gone.collect()}
    assert got == {(5, 0, len(line), 2), (9, 0, len(line), 2)}
    clean = {r.doc_id: (r.text, r.kept) for r in lines.remove_units(df, gone).collect()}
    assert clean[9] == ("", []) and clean[5][0].startswith("\nown") and clean[2][0] == rows[1][1] and clean[None][0] == ""


def test_short_lines_are_units_of_the_query(spark, tmp_path):
    rows = [(1, "All rights reserved.\nown text of one"), (2, "own text of two\nall  rights reserved."),
            (3, "Top\n \n没有空格的一行\nOk. Then."), (4, "没有空格的一行\n \ntop\nOk. But.")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.start, r.end, r.keep_doc_id, r.copies)
           for r in queries()["op9_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {(2, 16, 37, 1, 2), (4, 0, 7, 3, 2), (4, 10, 13, 3, 2)}


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def judged():
    found, marks = [], []
    for i in range(480):
        toxic, poor = i % 4 == 0, i % 3 == 0
        text = prose(30) + (" vileness" if toxic else "") + (" junky" if poor else "")
        found.append((i, text))
        if i < 400:
            marks.append((i, int(not poor), int(toxic)))
    return found + [(500, None), (501, "")], marks + [(None, 1, 0), (3, None, 1), (0, 0, 1), (999, 1, 1)]


def test_toxicity_on_documents_without_labels(spark, judged):
    rows, marks = judged
    df = documents(spark, rows)
    got = {r.doc_id: r for r in toxicity.score_documents(df, toxicity.quality_labels(labels(spark, marks))).collect()}
    wrong = [i for i in range(400, 480) if got[i].toxic != (i % 4 == 0)]
    assert not wrong and not got[500].toxic and not got[501].toxic
    left = toxicity.drop_toxic(df, toxicity.quality_labels(labels(spark, marks)))
    assert left.columns == df.columns and left.count() == 362


def test_toxicity_without_labels_rejects_nothing(spark, judged):
    got = toxicity.score_documents(documents(spark, judged[0][:5]), toxicity.quality_labels(labels(spark, [])))
    assert [r.toxic for r in got.collect()] == [False] * 5


def test_mixing_meets_the_targets(spark, judged):
    rows, marks = judged
    domains = mixing.label_domains(labels(spark, marks))
    weights = {"fine": 0.3, "poor": 0.4, "toxic": 0.3}
    got = mixing.mix(documents(spark, rows), domains, weights).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 for r in got)
    total = sum(r.tokens for r in got)
    for name, share in weights.items():
        assert sum(r.rate * r.tokens * r[f"p_{name}"] for r in got) == pytest.approx(share * total, rel=0.01)
    grown = mixing.repeat_documents(documents(spark, rows), domains, {"fine": 0.5, "poor": 0.5})
    assert {r.doc_id for r in grown.collect()} == {i for i, _ in rows} and grown.count() >= len(rows)


def soft_rows(spark, sharpness, names):
    rng = np.random.default_rng(3)
    z = rng.normal(size=(3000, names))
    z[np.arange(3000), rng.choice(names, 3000, p=[0.6, 0.4] if names == 2 else [0.55, 0.35, 0.1])] += sharpness
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    tokens = rng.integers(1, 2000, 3000)
    return spark.createDataFrame([(int(n), [float(x) for x in r]) for n, r in zip(tokens, p, strict=True)], "tokens long, p array<double>")


@pytest.mark.parametrize("sharpness", [8.0, 3.0, 1.5])
@pytest.mark.parametrize("weights, lowest, grow", [([0.9, 0.1], 1.0, True), ([0.85, 0.14, 0.01], 0.0, False)])
def test_rates_meet_the_shares_while_documents_are_held(spark, sharpness, weights, lowest, grow):
    rows = soft_rows(spark, sharpness, len(weights)).cache()
    rate, reached, target = mixing.fit_rates(rows, np.array(weights), lowest, grow)
    got = rows.select("tokens", "p", rate.alias("rate")).collect()
    found = np.array([sum(r.rate * r.tokens * r.p[k] for r in got) for k in range(len(weights))])
    assert found == pytest.approx(reached) and reached == pytest.approx(target, abs=2e-6 * target.sum())
    assert found / found.sum() == pytest.approx(weights, abs=1e-5) and min(r.rate for r in got) >= lowest
    assert grow or found.sum() == pytest.approx(sum(r.tokens for r in got), rel=1e-5)


def test_shares_out_of_reach_give_the_nearest(spark):
    rows = spark.createDataFrame([(10, [0.6, 0.4]), (30, [0.3, 0.7])], "tokens long, p array<double>")
    rate, reached, target = mixing.fit_rates(rows, np.array([0.9, 0.1]))
    assert np.abs(reached - target).max() > 1
    rates = [r.rate for r in rows.select("p", rate.alias("rate")).orderBy("tokens").collect()]
    assert rates[1] == 0 and rates[0] > 1
    with pytest.raises(RuntimeError):
        mixing.fit_rates(soft_rows(spark, 1.5, 2), np.array([0.9, 0.1]), 1.0, True, most_steps=2)


@pytest.mark.parametrize("work", [
    lambda s, d: exact_dedup.duplicate_groups(d), lambda s, d: minhash.near_duplicates(d),
    lambda s, d: rans.round_trip(d, PATH), lambda s, d: packing.pack(d, PATH), lambda s, d: lines.repeated_units(d),
    lambda s, d: secrets.scan(d, PATH), lambda s, d: toxicity.score_documents(d, toxicity.quality_labels(labels(s, []))),
    lambda s, d: mixing.mix(d, mixing.label_domains(labels(s, [])), {"fine": 1.0}),
    lambda s, d: pivots.near_duplicates(s.createDataFrame([], "vec_id long, embedding array<float>, label int")),
    lambda s, d: warc.look_up(*(lambda p: (p, warc.write_pages(p)[1]))(s.createDataFrame([], "page_id long, url string, html string"))),
])
def test_empty_tables(spark, work):
    assert work(spark, documents(spark, [])).collect() == []
