"""The operators as registered queries over the given tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from pillbox.llm.collocations import collocations
from pillbox.llm.common import LOWER, UPPER, read
from pillbox.llm.bpe import bpe_encode, compile_vocabulary
from pillbox.llm.exact_dedup import exact_dedup
from pillbox.llm.langid import language_id
from pillbox.llm.licenses import BASE, NOTICES, license_scan
from pillbox.llm.lm import lm_score
from pillbox.llm.mixing import mix_sources
from pillbox.llm.periodic_runs import periodic_runs
from pillbox.llm.pieces import compile_model, encode
from pillbox.llm.quality import (
    CHAR_GUARD,
    CHAR_LIMIT,
    COMMON_WORDS,
    MAX_REPEAT_PERCENT,
    MIN_WORDS,
    WORD_GUARD,
    WORD_LIMIT,
    quality_rules,
)
from pillbox.llm.simhash import simhash_dedup
from pillbox.llm.suffix_dedup import remove_repeats
from pillbox.llm.warc import warc_round_trip
from pillbox.session import scratch_path

BPE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD_BPE = "/opt/tokenizers/word_bpe_49k.json"


def op1_mixing(spark, sf_dir):
    """Sources mixed to the square root of their sizes, as many rows as there are documents on average."""
    return mix_sources(read(spark, sf_dir, "documents"), alpha=0.5, epochs=1.0, seed=42)


def op2_sentencepiece(spark, sf_dir, model: str = SENTENCEPIECE_MODEL):
    """Every document's piece ids, and whether decoding them gives the text back."""
    done = encode(read(spark, sf_dir, "documents").select("doc_id", "text"), compile_model(model), same_col="same_text")
    return done.select("doc_id", "ids", F.size("ids").alias("n_pieces"), "same_text")


def op3_langid(spark, sf_dir):
    """The language of every document, learnt from two thirds of them."""
    return language_id(read(spark, sf_dir, "documents"))


def op4_simhash(spark, sf_dir):
    """SimHash near-dedup: 3-word shingles, at most 2 differing bits."""
    return simhash_dedup(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op5_suffix_dedup(spark, sf_dir):
    """Bytes of every document that 50-byte strings of smaller documents cover."""
    return remove_repeats(read(spark, sf_dir, "documents"))


def op6_warc(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    return warc_round_trip(read(spark, sf_dir, "pages"), scratch_path(spark, "llm-warc"))


def op7_licenses(spark, sf_dir):
    """Base phrases and licence notices of every document."""
    found = license_scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op8_quality(spark, sf_dir):
    """Quality counts and the verdict for every document."""
    judged = quality_rules(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.drop("text", "lang")


def op9_exact_dedup(spark, sf_dir):
    """Exact dedup: the row with the largest doc_id of equal texts stays."""
    return exact_dedup(read(spark, sf_dir, "documents")).drop("row_id")


def op10_lm_score(spark, sf_dir, vocabulary: str = BPE_RANKS):
    """Every document's probability by the attention model and by the unigram baseline."""
    return lm_score(read(spark, sf_dir, "documents"), vocabulary)


def op11_collocations(spark, sf_dir):
    """The 2000 best phrases of 2 to 4 words of each language."""
    return collocations(read(spark, sf_dir, "documents"), min_count=30, covered_percent=80, top=2000)


def made_periodic(doc_id, words: list[bytes]) -> list[bytes]:
    """The words that the contract gives a document: one in ten by the checksum of its id goes round from some word on; a null id changes nothing."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of words of every document, and the words without their repeats."""
    found = periodic_runs(read(spark, sf_dir, "documents"), rewrite=made_periodic)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", "n_runs", "best.*", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_bpe(spark, sf_dir, vocabulary: str = WORD_BPE):
    """Digests of every document's ids in the word-end BPE vocabulary, and of their decoding."""
    return bpe_encode(read(spark, sf_dir, "documents"), compile_vocabulary(vocabulary), ids=False, digests=True)


def _license_sql() -> str:
    """The licence scan in DuckDB SQL: every place of a key phrase, and the share of the template's words around it."""
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    rows = ", ".join(
        f"('{t.label}', {t in BASE}, {quoted(t.words)}, {quoted(t.key.split())}, {t.key_at}, {t.share})" for t in (*BASE, *NOTICES)
    )
    labels = lambda which: f"coalesce(array_to_string(list_sort(list_distinct(list(label){which})), ','), '')"
    return f"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ),
        templates(label, is_base, tw, k, key_at, least) AS (VALUES {rows}),
        starts AS (
            SELECT *, unnest(list_filter(range(1, len(w) - len(k) + 2), lambda p: w[p:p + len(k) - 1] = k)) - 1 - key_at AS s
            FROM words, templates WHERE list_has_all(w, k)
        ),
        found AS (
            SELECT doc_id, label, is_base, s, share
            FROM (SELECT *, len(list_filter(range(1, len(tw) + 1), lambda j: s + j >= 1 AND w[s + j] = tw[j])) / len(tw) AS share FROM starts)
            WHERE share >= least
        ),
        digest AS (
            SELECT doc_id, count(*) FILTER (is_base) AS n_base, min(s) FILTER (is_base) AS first_word, max(s) FILTER (is_base) AS last_word,
                   {labels(" FILTER (is_base)")} AS base_labels, {labels("")} AS labels, max(share) AS score
            FROM found GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
               coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
        FROM words LEFT JOIN digest USING (doc_id)
    """


def _quality_sql() -> str:
    """The quality rules in DuckDB SQL: counts by lists of words, references by sums, Jensen-Shannon distances of lists."""
    size = len(next(iter(COMMON_WORDS.values()))) + 1
    common = "SELECT * FROM (VALUES " + ", ".join(f"('{lang}', [{', '.join(repr(w) for w in ws)}])" for lang, ws in COMMON_WORDS.items()) + ") v(ref, ws)"

    def distance(counts: str, ref: str) -> str:
        p, q = f"{counts}[i] / list_sum({counts})", f"{ref}[i] / list_sum({ref})"
        part = lambda x, y: f"CASE WHEN {x} > 0 THEN ({x}) * log2(({x}) / ((({x}) + ({y})) / 2)) ELSE 0 END"
        terms = f"list_transform(range(1, len({counts}) + 1), lambda i: {part(p, q)} + {part(q, p)})"
        return f"CASE WHEN list_sum({counts}) > 0 THEN sqrt(greatest(0, list_sum({terms}) / 2)) ELSE 0 END"

    return f"""
        WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
        split AS (SELECT *, regexp_extract_all(t, '[^ \\t-\\r]+') AS w FROM texts),
        grams AS (SELECT *, CASE WHEN len(w) > 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [] END AS g FROM split),
        twice AS (SELECT *, list_filter(map_entries(histogram_of), lambda e: e.value > 1) AS many FROM (SELECT *, list_histogram(g) AS histogram_of FROM grams)),
        counts AS (
            SELECT doc_id, lang, t, w, len(w) AS n_words, length(t) - len(regexp_extract_all(t, '[ \\t-\\r]')) AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls,
                   CASE WHEN len(many) = 0 THEN 0 ELSE len(list_distinct(flatten(list_transform(
                       list_filter(range(1, len(g) + 1), lambda i: histogram_of[g[i]] > 1), lambda i: range(i, i + 5))))) END AS n_repeat_words
            FROM twice
        ),
        classes AS (
            SELECT *, [CAST(x AS DOUBLE) FOR x IN [u, d, n_symbols, m, b, greatest(0, word_chars - u - d - n_symbols - m - b)]] AS chars
            FROM (SELECT *, len(regexp_extract_all(t, '[A-Z]')) AS u, len(regexp_extract_all(t, '[0-9]')) AS d,
                         len(regexp_extract_all(t, '[!"''()+,\\-./:;=?@\\[\\\\\\]^_`{{}}~]')) AS m, strlen(t) - length(t) AS b FROM counts)
        ),
        common AS ({common}),
        words AS (
            SELECT doc_id, lang, ref, chars, list_append(own, n_words - list_sum(own)) AS bins
            FROM (SELECT c.doc_id, c.lang, c.n_words, c.chars, ref, [CAST(len(list_filter(w, lambda y: y = x)) AS DOUBLE) FOR x IN ws] AS own FROM classes c, common)
        ),
        refs AS (
            SELECT ref, [{", ".join(f"sum(chars[{i}])" for i in range(1, 7))}] AS char_ref, [{", ".join(f"sum(bins[{i}])" for i in range(1, size + 1))}] AS word_ref
            FROM words WHERE lang = ref GROUP BY ref
        ),
        near AS (
            SELECT doc_id, min({distance("chars", "char_ref")}) AS char_distance, min({distance("bins", "word_ref")}) AS word_distance
            FROM words JOIN refs USING (ref) WHERE list_sum(char_ref) > 0 AND list_sum(word_ref) > 0 GROUP BY doc_id
        )
        SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
               base_failed, coalesce(char_distance, 0) AS char_distance, coalesce(word_distance, 0) AS word_distance,
               NOT (base_failed OR (word_chars >= {CHAR_GUARD} AND coalesce(char_distance, 0) > {CHAR_LIMIT})
                    OR (n_words >= {WORD_GUARD} AND coalesce(word_distance, 0) > {WORD_LIMIT})) AS kept
        FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM classes) LEFT JOIN near USING (doc_id)
    """


def _collocation_sql() -> str:
    """Phrases in DuckDB SQL: all grams of up to four words counted, parts and longer phrases by joins."""
    return f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p
            FROM documents
        ),
        words AS (SELECT lang, regexp_extract_all(p, '[^ \\t]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
        grams AS (
            SELECT lang, phrase, count(*) AS f
            FROM (SELECT lang, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
                  FROM words, (VALUES (1), (2), (3), (4)) sizes(m) WHERE len(w) >= m)
            GROUP BY lang, phrase
        ),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE f >= 30 AND contains(phrase, ' ')),
        cuts AS (
            SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS score
            FROM (SELECT *, unnest(range(1, len(w))) AS k FROM candidates) c
            JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
            JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
        ),
        scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (
            SELECT lang, part, max(f) AS f
            FROM (SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS part
                  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM candidates, (VALUES (2), (3)) sizes(m) WHERE len(w) > m))
            GROUP BY lang, part
        ),
        ranked AS (
            SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(score AS BIGINT) AS score
            FROM scored s LEFT JOIN longer ON longer.lang = s.lang AND longer.part = s.phrase
            WHERE longer.f IS NULL OR CAST(100 AS HUGEINT) * longer.f < CAST(80 AS HUGEINT) * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_langid": op3_langid,
    "op4_simhash": op4_simhash,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_warc": op6_warc,
    "op7_licenses": op7_licenses,
    "op8_quality": op8_quality,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_lm_score": op10_lm_score,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_bpe": op13_bpe,
}

ORACLE = {
    "op1_mixing": """
        WITH counts AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
        rates AS (
            SELECT s, CAST(sum(n) OVER () AS DOUBLE) * (pow(CAST(n AS DOUBLE), 0.5) / sum(pow(CAST(n AS DOUBLE), 0.5)) OVER ()) / n AS rate FROM counts
        ),
        cdf AS (
            SELECT s, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY s ORDER BY k) AS c
            FROM rates, (SELECT unnest(range(0, 400)) AS k)
        ),
        drawn AS (
            SELECT *, (CAST('0x' || substr(md5('42|count|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '')), 1, 13) AS BIGINT) + 0.5)
                      / 4503599627370496 AS u
            FROM documents
        ),
        counted AS (SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.s = coalesce(d.source, '') AND cdf.c < d.u) AS times FROM drawn d),
        copies AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(0, times)) AS copy FROM counted)
        SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
               CAST('0x' || substr(md5('42|order|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || copy || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS shuffle_key
        FROM copies
    """,
    "op6_warc": """
        SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN shared THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN shared THEN first_id END AS refers_to
        FROM (SELECT *, strlen(html) >= 100 AND first_id < page_id AS shared
              FROM (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages))
    """,
    "op7_licenses": _license_sql(),
    "op8_quality": _quality_sql(),
    "op11_collocations": _collocation_sql(),
    "op9_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
    """,
}
