"""Quality rules: fixed counts, and divergence from language references.

Every document has two histograms: the classes of its word characters, and
the common words of each language against all other words.  Four languages
have fixed common words; those of any other ``lang`` are its ``MOST`` most
frequent words, counted over all its documents.  A language's
reference is the sum of the histograms over all its documents.  A document that is
long enough is rejected when its Jensen-Shannon distance (base 2, 0 to 1) to
the *nearest* reference is over the limit, for either histogram; the nearest,
so that a wrong ``lang`` rejects nobody.  A document whose language has no
reference (a null ``lang``, or one without any word) is not judged by distance.

DataFrame functions only.  A document's words stay inside its row, so long
texts and hot sources move no data, but for the word counts of languages
beyond the four, which combine map-side; the references are a row a language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pillbox.llm.common import let, others, quoted, unused

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

MOST = 10  # common words of a language found in the data

# Frequent words of the languages, the reference bins.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "ist", "nicht", "ein", "das"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "with"),
    "es": ("de", "la", "que", "el", "en", "los", "del", "las", "por", "con"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "que", "pour"),
}
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
CHAR_GUARD, CHAR_LIMIT = 200, 0.30  # word characters at least; distance at most
WORD_GUARD, WORD_LIMIT = 100, 0.25  # words at least; distance at most


def words_of(text: Column) -> Column:
    return let(F.btrim(text, F.lit(SPACE)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "[ \\t-\\r]+")))


def repeat_words(words: Column, n: Column, size: int = 5) -> Column:
    """Words inside windows of ``size`` words that the text holds twice or more.

    Windows are compared by a 64-bit hash.  Only a text with a repeat is
    sorted; then equal windows are neighbours, and the sorted starts of the
    repeated ones are swept once.
    """
    grams = F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size)))
    same = lambda s, x, k: F.coalesce((k > 0) & (F.get(s, k - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))

    def covered(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, k: same(s, x, k)), lambda x: x["i"])))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("c"), F.lit(-size).alias("last")),
            lambda a, p: F.struct((a["c"] + F.least(F.lit(size), p - a["last"])).alias("c"), p.alias("last")),
            lambda a: a["c"],
        )

    return F.when(n > size, let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g)))).otherwise(0)


def common_words(docs: DataFrame, text_col: str, lang_col: str) -> dict[str, tuple[str, ...]]:
    """Common words by language: ``COMMON_WORDS``, and the most frequent words of every other language of the table."""
    others = docs.where(F.col(lang_col).isNotNull() & ~F.col(lang_col).isin(list(COMMON_WORDS)))
    if not others.select(lang_col).take(1):  # reads no text
        return dict(COMMON_WORDS)
    words = others.select(F.col(lang_col).alias("lang"), F.explode(words_of(F.coalesce(F.col(text_col), F.lit("")))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))  # the window is limited map-side
    found: dict[str, tuple[str, ...]] = {}
    for r in counts.withColumn("rank", rank).where(F.col("rank") <= MOST).orderBy("lang", "rank").collect():  # MOST rows a language
        found[r["lang"]] = (*found.get(r["lang"], ()), r["word"])
    return COMMON_WORDS | found


def histograms(text: Column, words: Column, n: Column, of_lang: dict[str, tuple[str, ...]]) -> Column:
    """A struct: points, symbol (counts), chars (class counts) and words_<k> (common words of language k, then all others)."""
    common = sorted({w for ws in of_lang.values() for w in ws})
    counts = F.struct(
        (F.length(text) - F.regexp_count(text, F.lit("[ \\t-\\r]"))).alias("points"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("upper"),
        F.regexp_count(text, F.lit("[0-9]")).alias("digit"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("symbol"),
        F.regexp_count(text, F.lit("[!\"'()+,\\-./:;=?@\\[\\\\\\]^_`{}~]")).alias("mark"),
        # bytes beyond the code points stand for letters outside ASCII: one or more each
        (F.octet_length(text) - F.length(text)).alias("beyond"),
        F.filter(words, lambda w: w.isin(common)).alias("hits"),
    )

    def of(c: Column) -> Column:
        rest = c["points"] - c["upper"] - c["digit"] - c["symbol"] - c["mark"] - c["beyond"]
        own = [F.transform(F.array(*map(F.lit, ws)), lambda w: F.size(F.filter(c["hits"], lambda h: h == w))) for ws in of_lang.values()]
        with_rest = lambda a: F.transform(F.concat(a, F.array(n - F.aggregate(a, F.lit(0), lambda s, x: s + x))), lambda x: x.cast("double"))
        return F.struct(
            c["points"].alias("points"),
            c["symbol"].alias("symbol"),
            F.array(*[x.cast("double") for x in (c["upper"], c["digit"], c["symbol"], c["mark"], c["beyond"], F.greatest(rest, F.lit(0)))]).alias("chars"),
            *[let(a, with_rest).alias(f"words_{k}") for k, a in enumerate(own)],
        )

    return let(counts, of)


def references(docs: DataFrame, text_col: str, lang_col: str, of_lang: dict[str, tuple[str, ...]]) -> dict[str, tuple[list[float], list[float]]]:
    """Summed histograms by language, over all documents: at most one row for each language."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    hist = let(text, lambda t: let(words_of(t), lambda w: histograms(t, w, F.size(w), of_lang)))
    own = F.coalesce(*[F.when(F.col("lang") == lang, F.col(f"h.words_{k}")) for k, lang in enumerate(of_lang)])
    rows = docs.where(F.col(lang_col).isin(list(of_lang))).select(F.col(lang_col).alias("lang"), hist.alias("h")).select("lang", "h.chars", own.alias("words"))
    sums = [F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(6)]
    sums += [F.sum(F.get("words", F.lit(i))).alias(f"w{i}") for i in range(max(map(len, of_lang.values())) + 1)]
    found = {r["lang"]: ([r[f"c{i}"] for i in range(6)], [r[f"w{i}"] for i in range(len(of_lang[r["lang"]]) + 1)]) for r in rows.groupBy("lang").agg(*sums).collect()}
    return {lang: (c, w) for lang, (c, w) in sorted(found.items()) if sum(c) > 0 and sum(w) > 0}


def distance(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram to a reference; 0 for an empty histogram."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def of(sum_: Column) -> Column:
        terms = F.zip_with(
            counts, F.array(*[F.lit(x / sum(reference)) for x in reference]),
            lambda c, q: part(c / sum_, (c / sum_ + q) / 2) + part(q, (c / sum_ + q) / 2),
        )
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))

    return let(total, lambda s: F.when(s > 0, of(s)).otherwise(0.0))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The input columns plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance, kept.

    A null text counts as empty and fails the base rule, as does any text of
    fewer than ten words.  Below the length guards a distance is not judged.
    A document whose language has no reference is not judged by distance: the
    base rule alone decides.  Input columns with a name of a result
    column are replaced; repeated rows are judged alike; an empty table gives
    an empty result.
    """
    of_lang = common_words(docs, text_col, lang_col)
    refs = references(docs, text_col, lang_col, of_lang)
    place = {lang: k for k, lang in enumerate(of_lang)}
    nearest = lambda ds: F.array_min(F.array(*ds)) if ds else F.lit(0.0)

    def judged(t: Column, w: Column, n: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
        counts = F.struct(
            n.cast("long").alias("n_words"),
            histograms(t, w, n, of_lang).alias("h"),
            let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long")).alias("n_dup_lines"),
            repeat_words(w, n).cast("long").alias("n_repeat_words"),
        )
        distances = lambda c: F.struct(
            c["n_words"].alias("n_words"),
            c["h"]["points"].cast("long").alias("word_chars"),
            c["h"]["symbol"].cast("long").alias("n_symbols"),
            c["n_dup_lines"].alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            ((c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])).alias("base_failed"),
            nearest([distance(c["h"]["chars"], r) for r, _ in refs.values()]).alias("char_distance"),
            nearest([distance(c["h"][f"words_{place[lang]}"], r) for lang, (_, r) in refs.items()]).alias("word_distance"),
        )
        return let(counts, distances)

    text = F.coalesce(F.col(text_col), F.lit(""))
    verdict = let(text, lambda t: let(words_of(t), lambda w: judged(t, w, F.size(w))))
    q = unused(docs, "_q")
    out = docs.withColumn(q, verdict)
    far = ((F.col(f"{q}.word_chars") >= CHAR_GUARD) & (F.col(f"{q}.char_distance") > CHAR_LIMIT)) | ((F.col(f"{q}.n_words") >= WORD_GUARD) & (F.col(f"{q}.word_distance") > WORD_LIMIT))
    far &= F.coalesce(F.col(lang_col).isin(list(refs)), F.lit(False))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance")
    keep = [quoted(c) for c in others(docs, *counts, "kept")]
    return out.select(*keep, *[f"{q}.{c}" for c in counts], (~(F.col(f"{q}.base_failed") | far)).alias("kept"))
