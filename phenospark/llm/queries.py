"""One query per operator, over its whole table, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, exact_dedup, lines, minhash, mixing, packing, pivots, quality, ranking, rans, secrets, toxicity, warc
from .common import read_table

TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


MIX = {"fine": 0.85, "poor": 0.14, "toxic": 0.01}


def op1_toxicity_chain(spark: SparkSession, d: str) -> DataFrame:
    labels = toxicity.quality_labels(read_table(spark, d, "labels"))
    return toxicity.score_documents(read_table(spark, d, "documents"), labels)


def op2_pivot_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return pivots.near_duplicates(read_table(spark, d, "embeddings"))


def op3_soft_mixing(spark: SparkSession, d: str) -> DataFrame:
    domains = mixing.label_domains(read_table(spark, d, "labels"))
    return mixing.mix(read_table(spark, d, "documents"), domains, MIX)


def op4_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.duplicate_groups(read_table(spark, d, "documents"))


def op5_rans_round_trip(spark: SparkSession, d: str) -> DataFrame:
    back = rans.round_trip(read_table(spark, d, "documents"), tokenizer_path())
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_secret_spans(spark: SparkSession, d: str) -> DataFrame:
    """Spans as kind:start:end, comma-joined; the base kinds counted and digested."""
    found = secrets.scan(read_table(spark, d, "documents"), tokenizer_path())
    names = F.array(*[F.lit(k) for k in secrets.KINDS])
    span = F.arrays_zip("starts", "kinds", "ends")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kinds"]), s["starts"].cast("string"), s["ends"].cast("string")
        )), ",")

    def count(kind):
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{secrets.KINDS[kind]}")

    counts = [count(kind) for kind in range(3)]
    base = joined(F.filter(span, lambda s: s["kinds"] < 3))
    return found.select(
        "doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(span).alias("spans")
    )


def op7_concatenate_and_cut(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read_table(spark, d, "documents"), tokenizer_path()).drop("ids")


def op8_warc_capture_index(spark: SparkSession, d: str) -> DataFrame:
    pages = read_table(spark, d, "pages")
    _, shards = warc.write_pages(pages)
    return warc.look_up(pages, shards, null_is_any=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return lines.repeated_units(read_table(spark, d, "documents"), least_line_words=1)


def op10_minhash(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, d, "documents"), words=3, percent=85)


def op11_stratified_search(spark: SparkSession, d: str) -> DataFrame:
    index = ranking.build_index(read_table(spark, d, "documents"))
    return ranking.search(index, read_table(spark, d, "benchmark"))


def op12_quotient_filters(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(read_table(spark, d, "documents"))


def op13_monotone_trees(spark: SparkSession, d: str) -> DataFrame:
    return quality.apply_rules(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity_chain, op2_pivot_near_dedup, op3_soft_mixing, op4_exact_dedup,
        op5_rans_round_trip, op6_secret_spans, op7_concatenate_and_cut,
        op8_warc_capture_index, op9_line_dedup, op10_minhash, op11_stratified_search,
        op12_quotient_filters, op13_monotone_trees,
    )}


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES = {
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM d JOIN g USING (text_sha256)""",
    "op2_pivot_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach(a, b) AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        )
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
               vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
        FROM embeddings
        LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1) USING (vec_id)
        LEFT JOIN (SELECT a AS vec_id, min(b) AS m FROM reach GROUP BY 1) USING (vec_id)""",
    "op8_warc_capture_index": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY 1),
        h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex,
                     page_id = first_id AS own, first_id FROM p JOIN f USING (html)),
        q AS (SELECT *, list_transform(range(8), lambda k: CAST('0x' || substr(hex, CAST(k * 5 + 1 AS INT), 5) AS BIGINT)) AS groups
              FROM h)
        SELECT page_id, payload_bytes,
               list_aggregate(flatten(list_transform(groups, lambda v: list_transform([15, 10, 5, 0], lambda s:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((v >> s) & 31) + 1 AS INT), 1)))),
                   'string_agg', '') AS payload_digest,
               CASE WHEN own THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN own THEN NULL ELSE first_id END AS refers_to
        FROM q""",
    "op11_stratified_search": f"""
        WITH t AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM documents),
        p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
        n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY 1),
        c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
        m AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // total) AS m FROM n, c),
        w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
              FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), c),
        q AS (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark),
        s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
              FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY 1, 2),
        r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank,
                     doc_id, score FROM s WHERE score > 0)
        SELECT * FROM r WHERE rank <= 10""",
    "op12_quotient_filters": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
              FROM w, range(1, 5) AS s(k) WHERE len(w) >= k),
        f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
        c AS (SELECT * FROM f WHERE k > 1 AND f >= 30),
        h AS (SELECT lang, g, f FROM f WHERE f >= 30),
        u AS (SELECT lang, g, k, f AS a, unnest(range(1, k)) AS j FROM c),
        v AS (SELECT *, g[1:j] AS g1, g[j + 1:k] AS g2 FROM u),
        t AS (SELECT v.lang, v.g, a, j, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * a) // (x.f + y.f) AS score
              FROM v JOIN h x ON x.lang = v.lang AND x.g = v.g1 JOIN h y ON y.lang = v.lang AND y.g = v.g2),
        b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
        z AS (SELECT lang, g, k, f, unnest(range(2, k)) AS m FROM c),
        i AS (SELECT lang, f, unnest(list_transform(range(1, k - m + 2), lambda i: g[i:i + m - 1])) AS g FROM z),
        o AS (SELECT lang, g, max(f) AS longer FROM i GROUP BY 1, 2),
        d AS (SELECT b.* FROM b LEFT JOIN o USING (lang, g)
              WHERE o.longer IS NULL OR CAST(100 AS HUGEINT) * o.longer < CAST(80 AS HUGEINT) * b.a),
        r AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score FROM d),
        q AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
                     n, score FROM r JOIN n USING (lang))
        SELECT * FROM q WHERE rank <= 2000""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
