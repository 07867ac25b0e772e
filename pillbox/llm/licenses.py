"""License scan on a positional index of rare template words.

Licence notices are templates: word sequences with a mandatory key phrase.
Over all documents the number of documents holding each key-phrase word is
counted, which gives its inverse document frequency.  Each template is then
posted under the two highest-IDF words of its key phrase, with their
positions.  A file's occurrences of posted words, shifted by these
positions, are the places where the template may start; the places of both
words are intersected, the key phrase is verified word for word, and the
share of template words that stand at their place is the score.

DataFrame functions only, inside the row: no text is shuffled.  The one
aggregate that reaches the driver has a row for each word of the templates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import ascii_lower, let, others, quoted, unused


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # consecutive words of the text, all of which must be found
    share: float = 1.0  # of the template's words, at least

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        k = self.key.split()
        return next(i for i in range(len(self.words)) if self.words[i : i + len(k)] == k)


# The base phrases.
BASE = (
    Template("mit", "under the mit license", "under the mit license"),
    Template("apache-2", "apache license version 2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc", "cc by nc"),
)
# Opening words of widely used notices, with the words that make each one binding.
NOTICES = (
    Template("apache-2", "licensed under the apache license version 2 0", "the apache license", 0.6),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms", 0.6),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4", 0.6),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa", 0.6),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2", 0.6),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3", 0.6),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license", 0.5),
    Template("mit", "released under the mit license", "mit license", 0.6),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge", 0.6),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license", 0.5),
)
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    plain = F.btrim(F.regexp_replace(ascii_lower(text), BREAKS, " "))
    return let(plain, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " ")))


def idf(docs: DataFrame, text: Column, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency over all documents; one row for each word of the templates."""
    vocab = F.array(*map(F.lit, vocabulary))
    rows = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(words_of(text), vocab))).alias("w")).groupBy("w").count().collect()
    seen = {r["w"]: r["count"] for r in rows}
    n = seen.get("", 0)  # every document has the empty word once
    return {w: math.log((n + 1) / (seen.get(w, 0) + 1)) for w in vocabulary}


def starts(t: Template, weight: dict[str, float], words: Column, hits: Column) -> Column:
    """Where ``t`` starts: places on which the postings of its rarest key words agree, with the key phrase verified."""
    key = t.key.split()
    rare = sorted(set(key), key=lambda w: (-weight[w], w))[:2]
    lists = []
    for w in rare:
        at = F.transform(F.filter(hits, lambda h: h["w"] == w), lambda h: h["i"])  # noqa: B023
        places = [t.key_at + i for i, x in enumerate(key) if x == w]
        lists.append(F.array_distinct(F.flatten(F.array(*[F.transform(at, lambda p: p - q) for q in places]))))  # noqa: B023
    both = lists[0] if len(lists) == 1 else F.array_intersect(*lists)
    phrase = F.array(*map(F.lit, key))
    return F.filter(both, lambda s: (s + t.key_at >= 0) & (F.slice(words, F.greatest(s + t.key_at, F.lit(0)) + 1, len(key)) == phrase))


def share(t: Template, words: Column, s: Column) -> Column:
    same = F.transform(F.array(*map(F.lit, t.words)), lambda w, j: F.when(F.get(words, s + j) == w, 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda a, x: a + x) / len(t.words)


def license_scan(docs: DataFrame, text_col: str = "text", base: tuple[Template, ...] = BASE, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """The input columns plus n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    ``places`` lists every (label, word, share) found, base phrases first.  A
    null or empty text has no words, empty labels, null places of words and
    score 0.  Input columns with a name of a result column are replaced;
    repeated rows are scanned alike; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    templates = (*base, *notices)
    weight = idf(docs, text, sorted({w for t in templates for w in t.key.split()}))
    posted = sorted({w for t in templates for w in sorted(set(t.key.split()), key=lambda w: (-weight[w], w))[:2]})
    none = F.array().cast("array<struct<label:string,word:bigint,share:double>>")
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")

    def found(t: Template, words: Column, hits: Column) -> Column:
        scored = F.transform(starts(t, weight, words, hits), lambda s: F.struct(F.lit(t.label).alias("label"), s.cast("long").alias("word"), share(t, words, s).alias("share")))
        return F.filter(scored, lambda x: x["share"] >= t.share)

    def places(words: Column, hits: Column) -> Column:
        of = lambda ts: F.when(F.size(hits) > 0, F.concat(*[found(t, words, hits) for t in ts]) if ts else none).otherwise(none)
        return F.struct(F.size(words).cast("long").alias("n_words"), of(base).alias("base"), of(notices).alias("more"))

    def digest(p: Column) -> Column:
        at = F.transform(p["base"], lambda x: x["word"])
        return let(F.concat(p["base"], p["more"]), lambda both: F.struct(
            p["n_words"].alias("n_words"),
            F.size(p["base"]).cast("long").alias("n_base"),
            F.array_min(at).alias("first_word"),
            F.array_max(at).alias("last_word"),
            joined(p["base"]).alias("base_labels"),
            joined(both).alias("labels"),
            F.coalesce(F.array_max(F.transform(both, lambda x: x["share"])), F.lit(0.0)).alias("score"),
            both.alias("places"),
        ))

    hits_of = lambda words: F.filter(F.transform(words, lambda w, i: F.when(w.isin(posted), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
    scan = let(words_of(text), lambda words: let(hits_of(words), lambda hits: let(places(words, hits), digest)))
    result = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")
    found_col = unused(docs, "_l")
    return docs.withColumn(found_col, scan).select(*map(quoted, others(docs, *result)), *[f"{found_col}.{c}" for c in result])
