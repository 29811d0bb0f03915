"""The parts that need no session: coders, encoders, hashes, costs."""

import random
import zlib

import numpy as np
import pytest

from phenospark.llm import lines, minhash, secrets, toxicity, warc
from phenospark.llm.exact_dedup import misra_gries
from phenospark.llm.rans import Table
from phenospark.llm.textmodel import Rows, fit_softmax, softmax

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_encoder_equals_the_tokenizer_on_whole_texts():
    from phenospark.llm.tokens import WordEncoder

    rnd, alphabet = random.Random(1), "aB'sé́ \n\t.,<|>9Σ ß\x1c日ªÅ̊K"
    texts = ["", " lead", "don't I'LL", "<|endoftext|>x", "İ ΣΑΣ ς", "a\x0bb\x85c", "word " * 3000]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40))) for _ in range(800)]
    encoder = WordEncoder(PATH, cache_bytes=50_000)
    for _ in range(2):
        ids, sizes = encoder.encode(texts)
        ends = np.cumsum(sizes)
        for text, end, size in zip(texts, ends, sizes, strict=True):
            assert ids[end - size:end].astype("<u4").tobytes() == encoder.plain(text)


@pytest.mark.parametrize("n", [1, 5, 255, 256, 257, 3000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, (3, n)), 40_000).astype("u4")
    seen, counts = np.unique(ids, return_counts=True)
    table = Table(seen, counts)
    assert int(table.freq.sum()) == 1 << table.bits and table.freq.min() >= 1
    assert (table.decode(table.encode(ids), n) == ids).all()


def test_table_with_more_ids_than_slots_grows():
    table = Table(np.arange(200_000), np.r_[1e9, np.ones(199_999)])
    assert int(table.freq.sum()) == 1 << table.bits and table.freq.min() >= 1


def test_misra_gries_keeps_every_heavy_hitter():
    from collections import Counter

    rnd = random.Random(3)
    items = ["hot"] * 300 + ["warm"] * 150 + [f"x{rnd.randrange(400)}" for _ in range(550)]
    rnd.shuffle(items)
    counts = Counter()
    for k in range(0, len(items), 37):
        misra_gries(counts, items[k:k + 37], 9)
    assert len(counts) <= 9 and {"hot", "warm"} <= set(counts)
    assert all(n <= items.count(x) for x, n in counts.items())


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(5)
    common, own = rng.integers(0, 1 << 63, 400).astype("u8"), rng.integers(0, 1 << 63, 100).astype("u8")
    a, b = np.unique(common), np.unique(np.concatenate([common, own]))
    same = np.mean([minhash.signature(a, 160) == minhash.signature(b, 160)])
    assert abs(same - len(a) / len(b)) < 0.12
    tiny = minhash.signature(np.array([7], "u8"), 160)
    assert len(np.unique(tiny)) == 1


def test_shingles():
    make = minhash.Shingles(3)
    assert len(make("")) == len(make(" \t\n")) == 0
    assert len(make("one two")) == 1 and (make("one two") == make("ONE\x0btwo")).all()
    assert len(make("a b c a b c")) == 3
    assert (make("É x y") != make("é x y")).all()  # only A-Z are lower-cased
    assert not np.intersect1d(make("a b"), make("a b c")).size


def base_spans(text):
    """The base patterns as they are stated, matches that are too short dropped."""
    import re

    out = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text, re.A | re.I) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(secrets.HEX, text) if len(m[0]) >= 16])


def test_base_spans_equal_the_stated_patterns():
    rnd = random.Random(2)
    parts = ["password", "API_KEY", "apikey", "token", "=", ": ", '"', "AKIA", "ABCDEFGH12345678", "deadbeef00112233",
             "short", " ", "é", "passſwd", "x" * 13, "'", "==", "secret=token=abcdefghijklm", "AKIAAKIA"]
    words = secrets.dictionary(PATH)
    for _ in range(1500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12)))
        assert [s for s in secrets.find(text, words) if s[1] < 3] == base_spans(text)


def test_guess_cost_orders_values():
    words = secrets.dictionary(PATH)
    cost = {v: secrets.guess_cost(v, words) for v in
            ("password", "qwertyuiop", "aaaaaaaaaa", "abcdefghij", "1999-12-31", "sunshine2012", "x9$Kq!vT2@zL")}
    assert all(c < 8 for v, c in cost.items() if v != "x9$Kq!vT2@zL") and cost["x9$Kq!vT2@zL"] > 12
    assert secrets.guess_cost("", words) == 0
    hits = secrets.find("password: x9$Kq!vT2@zL and password: sunshine", words)
    assert [k for _, k, _ in hits] == [3] and hits[0][0] == 10


def test_unit_spans_and_removal():
    text = "First sentence here. Second one!\n\n  Last line  "
    assert [text[a:b] for a, b in lines.spans(text)] == [
        "First sentence here. Second one!", "First sentence here.", "Second one!", "Last line  ",
    ]
    assert lines.spans("") == []
    assert lines.keep("abcdef", [{"start": 1, "end": 3}, {"start": 2, "end": 4}]) == ("aef", [[0, 1], [4, 6]])


def test_url_key_and_record():
    assert warc.url_key("HTTP://www.Blog.Example.com:80/a?b#c") == "com,example,blog)/a?b"
    assert warc.url_key(None) == warc.url_key("") and " " not in warc.url_key("http://a b/\n")
    payload = "é\r\n\r\n".encode() * 3
    for first, kind in ((None, "response"), (5, "response"), (2, "revisit")):
        url, page, size, _, got, refers, body = warc.parse_record(warc.record(5, "http://a/é", payload, first))
        assert (page, size, got, refers) == (5, len(payload), kind, 2 if kind == "revisit" else None)
        assert body == (b"" if kind == "revisit" else payload) and url == "http://a/%C3%A9"
    damaged = warc.record(5, None, payload, None).replace(b"\xc3\xa9", b"zz", 1)
    with pytest.raises(ValueError):
        warc.parse_record(damaged)


def test_softmax_regression_finds_the_telling_feature():
    rnd = np.random.default_rng(0)
    numbers = [[0, *np.flatnonzero(rnd.random(20) < 0.3) + 1] for _ in range(400)]
    y = np.array([3 in r for r in numbers], float)
    rows = Rows(numbers, 21, np.zeros((400, 0)))
    p = softmax(rows.times(fit_softmax(rows, np.stack([1 - y, y], axis=1))))[:, 1]
    assert ((p > 0.5) == y).all()


def test_threshold_of_no_positives_rejects_nothing():
    assert toxicity.best_threshold(np.array([0.2, 0.9]), np.zeros(2)) > 1
    assert toxicity.best_threshold(np.array([0.2, 0.9]), np.array([0, 1])) == pytest.approx(0.55)


def test_crc_of_ids_is_unsigned():
    assert zlib.crc32(np.array([2], "<u4").tobytes()) >= 0
