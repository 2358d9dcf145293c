"""Licence scans with a positional index of rare template words. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANCHORS = 3                 # rarest words of a key phrase that are looked up


@dataclass(frozen=True)
class Template:
    """Words of a licence notice; those from ``key`` on, ``size`` of them, must stand word by word."""

    label: str
    words: tuple[str, ...]
    key: int
    size: int


def template(label: str, text: str, phrase: str) -> Template:
    words, wanted = tuple(text.split()), tuple(phrase.split())
    key = next(i for i in range(len(words)) if words[i:i + len(wanted)] == wanted)
    return Template(label, words, key, len(wanted))


# Phrases and labels of the base rule.
BASE = (
    template("mit", "mit license", "mit license"),
    template("apache", "apache license", "apache license"),
    template("gpl", "general public license", "general public license"),
)
# Words of licence notices, and the phrase that each of them must contain.
NOTICES = (
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    template("mit", "released under the mit license", "the mit license"),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    template("gpl-2.0", "under the terms of the gnu general public license version 2", "gnu general public license version 2"),
    template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose",
             "permission to use copy modify and or distribute"),
    template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    template("cc-by", "this work is licensed under a creative commons attribution", "creative commons attribution"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words of a whole text. The one letter whose lower case is ASCII (Kelvin sign) is kept apart."""
    lowered = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("K"), F.lit("ķ")))
    return F.array_remove(F.split(lowered, NOT_A_WORD), "")


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_frequencies(words: DataFrame, templates: tuple[Template, ...]) -> dict[str, int]:
    """In how many documents each key word of the templates occurs. As many rows as key words reach the driver."""
    vocabulary = sorted({w for t in templates for w in t.words[t.key:t.key + t.size]})
    found = words.select(F.explode(F.array_intersect("words", _texts(vocabulary))).alias("word"))
    counted = {r.word: r.n for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: counted.get(w, 0) for w in vocabulary}


def anchors(t: Template, frequency: dict[str, int], count: int = ANCHORS) -> list[tuple[str, int]]:
    """The rarest words of the key phrase (highest IDF) with their places in it; ties go to the later word."""
    places = {w: i for i, w in enumerate(t.words[t.key:t.key + t.size])}
    return sorted(places.items(), key=lambda p: (frequency[p[0]], -p[1]))[:count]


def _places(t: Template, index: list[tuple[str, int]]) -> Column:
    """Starts of the key phrase: postings of its anchors intersected by relative position, then verified."""
    def postings(word: str, offset: int) -> Column:
        return F.transform(F.filter("found", lambda x: x["word"] == word), lambda x: x["at"] - F.lit(offset))

    starts = None
    for word, offset in index:
        own = postings(word, offset)
        starts = own if starts is None else F.array_intersect(starts, own)
    phrase = _texts(t.words[t.key:t.key + t.size])
    return F.filter(starts, lambda s: (s >= 0) & (F.slice("words", s + 1, t.size) == phrase))


def _coverage(t: Template, places: str) -> Column:
    """Largest share of the template's words that stand in their place around a key phrase."""
    def share(start: Column) -> Column:
        hits = [F.coalesce((F.get("words", start + (j - t.key)) == w).cast("int"), F.lit(0)) for j, w in enumerate(t.words)]
        total = hits[0]
        for hit in hits[1:]:
            total = total + hit
        return total / F.lit(float(len(t.words)))
    return F.coalesce(F.array_max(F.transform(places, share)), F.lit(0.0))


def scan_licenses(docs: DataFrame, base: tuple[Template, ...] = BASE, notices: tuple[Template, ...] = NOTICES,
                  id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every whole text.

    A first pass counts in how many documents the templates' key words occur.
    The rarest of each template are its anchors; a file's anchor words are
    looked up, their positions minus their places in the template are
    intersected, and what is left is verified word by word. n_base counts all
    places of the base phrases, first_word and last_word are their smallest and
    largest start. Labels are those of the base and of the notices, sorted and
    joined by commas (empty if there are none). The score is the largest share
    of a found template's words that stand in their place, 0 without label.

    Null texts count as empty, null ids and repeated rows give a row each, and
    further columns are not read. An empty table gives no rows.
    """
    templates = (*base, *notices)
    words = docs.select(F.col(id_column).alias("doc_id"), words_of(F.col(text)).alias("words"))
    frequency = document_frequencies(words, templates)
    index = [anchors(t, frequency) for t in templates]
    looked_up = sorted({w for entry in index for w, _ in entry})

    every = F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    found = F.filter(every, lambda x: x["word"].isin(looked_up))
    none = F.array().cast("array<struct<word:string,at:int>>")
    # files without any anchor skip the lookup
    scanned = words.withColumn("found", F.when(F.arrays_overlap("words", _texts(looked_up)), found).otherwise(none))
    scanned = scanned.withColumns({f"p{i}": F.when(F.size("found") > 0, _places(t, entry)).otherwise(F.array().cast("array<int>"))
                                   for i, (t, entry) in enumerate(zip(templates, index))})
    present = [F.when(F.size(f"p{i}") > 0, F.lit(t.label)) for i, t in enumerate(templates)]
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")
    places = F.concat(*[F.col(f"p{i}") for i in range(len(base))])
    score = F.greatest(*[F.when(F.size(f"p{i}") > 0, _coverage(t, f"p{i}")).otherwise(0.0) for i, t in enumerate(templates)])
    return scanned.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        joined(present[:len(base)]).alias("base_labels"), joined(present).alias("labels"), F.round(score, 6).alias("score"))


def scan_sql(table: str = "documents") -> str:
    """The same rows in SQL, with the templates compared at every word."""
    rules = [
        ("mit", "mit license", 0, 2), ("apache", "apache license", 0, 2), ("gpl", "general public license", 0, 3),
        *[(t.label, " ".join(t.words), t.key, t.size) for t in NOTICES]]
    flags, shares, most = [], [], 0
    for n, (_, text, key, size) in enumerate(rules):
        words = text.split()
        at = lambda j: "w" if j == 0 else f"lead(w, {j}) OVER o" if j > 0 else f"lag(w, {-j}) OVER o"
        flags.append("(" + " AND ".join(f"coalesce({at(j - key)} = '{words[j]}', false)" for j in range(key, key + size)) + f") AS f{n}")
        shares.append("(" + " + ".join(f"coalesce(({at(j - key)} = '{w}')::INT, 0)" for j, w in enumerate(words)) + f") / {len(words)}.0::DOUBLE AS s{n}")
    names = range(len(rules))
    label = lambda some: "array_to_string(list_sort(list_distinct([x FOR x IN [" + ", ".join(
        f"CASE WHEN bool_or(f{n}) THEN '{rules[n][0]}' END" for n in some) + "] IF x IS NOT NULL])), ',')"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    base = "(f0::INT + f1::INT + f2::INT)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM {table}),
p AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM d),
m AS (SELECT r, pos, {', '.join(flags)}, {', '.join(shares)} FROM p WINDOW o AS (PARTITION BY r ORDER BY pos)),
a AS (SELECT r, sum({base}) AS n_base, min(CASE WHEN {base} > 0 THEN pos END) AS first_word,
        max(CASE WHEN {base} > 0 THEN pos END) AS last_word, {label(range(3))} AS base_labels, {label(names)} AS labels,
        max(greatest({', '.join(f'CASE WHEN f{n} THEN s{n} ELSE 0 END' for n in names)})) AS score
      FROM m GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(score, 0), 6)::DOUBLE AS score
FROM d LEFT JOIN a USING (r)"""
