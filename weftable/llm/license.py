"""License scans by a positional index of rare words.

Patterns are notices and phrases, as sequences of words. The index holds, of every pattern, its words of highest inverse document
frequency in the corpus with their places in it: one of a phrase, ``ANCHORS`` of a notice. A file looks up those of its words
that the index holds; a hit at place i of a word at place j of a pattern is a posting that the pattern starts at i - j. Postings
of a pattern are intersected: a phrase needs one at a start, a notice ``AGREE`` different words at the same. At each start left, the
file's words are compared with the pattern's, place by place: a phrase must be equal; of a notice ``NEED`` per cent must be, and
all its key phrases must stand within the same words of the file. Nothing but rows of the file is compared, so no rows are
shuffled but the counts of the patterns' words. Only built-in functions are used.

The base phrases give the base labels and places; notices add labels. ``score`` is the largest share of a notice that was found,
half for a file with base phrases only, else 0.

Defined cases: words are runs of digits, letters A-Z (lower-cased) and everything beyond ASCII; a null or empty text has no words;
a notice may begin before the file or end after it; equal frequencies go by the word; places that overlap all count; equal rows get
equal results; an empty table gives no rows. Only the key and the results are returned, whatever other columns the table has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ANCHORS, AGREE, NEED = 4, 2, 70

# The base phrases and their labels.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# Usual public notices, their labels, and the phrases that must stand in them (parted by bars).
NOTICES = (
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("apache-2.0", "distributed on an as is basis without warranties or conditions of any kind either express or implied", "as is basis|conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms|without modification"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "endorse or promote"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright"),
    ("gpl-2.0", "under the terms of the gnu general public license version 2", "general public license version 2"),
    ("gpl-2.0-or-later", "either version 2 of the license or at your option any later version", "version 2 of the license|any later version"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-3.0-or-later", "either version 3 of the license or at your option any later version", "version 3 of the license|any later version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free of charge|any person obtaining a copy"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software|public domain"),
)

#: The Kelvin sign is the one character beyond ASCII that lower case turns into an ASCII letter; any other sign may stand for it.
_KELVIN, _ANOTHER = "K", "Å"


def patterns() -> list[tuple[str, bool, list[str], list[str]]]:
    """Label, whether a base phrase, words, key phrases of each pattern."""
    base = [(label, True, phrase.split(), []) for label, phrase in BASE]
    return base + [(label, False, text.split(), keys.split("|")) for label, text, keys in NOTICES]


def words_of(text: Column) -> Column:
    whole = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit(_ANOTHER)))
    return F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))


def document_frequencies(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """In how many texts each word of the patterns stands; as many entries as the patterns have words."""
    known = F.array(*[F.lit(w) for w in sorted({w for p in patterns() for w in p[2]})])
    found = docs.select(F.explode(F.array_intersect(words_of(F.col(f"`{text}`")), known)).alias("word"))
    return {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def anchors(frequencies: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """The index: of each rare word its postings, (pattern, place in the pattern)."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, (_, base, words, _) in enumerate(patterns()):
        rare = sorted(set(words), key=lambda w: (frequencies.get(w, 0), w))[: 1 if base else ANCHORS]
        for place, word in enumerate(words):
            if word in rare:
                index.setdefault(word, []).append((number, place))
    return index


def _case(by: Column, values: dict, otherwise: Column) -> Column:
    case = F.when(F.lit(False), otherwise)
    for k, v in values.items():
        case = case.when(by == k, v)
    return case


def _votes(index: dict[str, list[tuple[int, int]]]) -> Column:
    """Sorted distinct (pattern, start, word): where the index says that a pattern starts, and by which word."""
    known = sorted(index)
    hits = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(known), F.struct(i.alias("at"), w.alias("word")))), lambda h: h.isNotNull()
    )
    postings = {w: F.array(*[F.struct(F.lit(p).alias("pattern"), F.lit(j).alias("place")) for p, j in index[w]]) for w in known}
    none = F.lit(None).cast("array<struct<pattern:int,place:int>>")

    def starts(h: Column) -> Column:
        return F.transform(
            _case(h["word"], postings, none),
            lambda p: F.struct(p["pattern"].alias("pattern"), (h["at"] - p["place"]).alias("start"), h["word"].alias("word")),
        )

    return F.sort_array(F.array_distinct(F.flatten(F.transform(hits, starts))))


def _agreed(votes: Column) -> Column:
    """Of sorted votes, one of each pattern and start that enough different words gave."""

    def same(v: Column, i: Column) -> Column:
        other = F.get(votes, i)
        return F.coalesce((other["pattern"] == v["pattern"]) & (other["start"] == v["start"]), F.lit(False))

    def enough(v: Column, i: Column) -> Column:
        whole = ~same(v, i - AGREE)
        for k in range(1, AGREE):
            whole &= same(v, i - k)
        return F.when(v["pattern"] < len(BASE), ~same(v, i - 1)).otherwise(whole)

    return F.filter(votes, enough)


def _verified(agreed: Column) -> Column:
    """Structs ``pattern, start, matched, length`` of the starts at which the words and key phrases are found."""
    all_words = {n: F.array(*[F.lit(w) for w in p[2]]) for n, p in enumerate(patterns())}
    all_keys = {n: F.array(*[F.lit(f" {k} ") for k in p[3]]).cast("array<string>") for n, p in enumerate(patterns())}
    none = F.lit(None).cast("array<string>")

    def compared(v: Column) -> Column:
        expected = _case(v["pattern"], all_words, none)
        here = F.transform(expected, lambda _, j: F.get("words", v["start"] + j))
        equal = F.zip_with(here, expected, lambda a, b: F.coalesce(a == b, F.lit(False)))
        return F.struct(
            v["pattern"].alias("pattern"),
            v["start"].alias("start"),
            F.size(F.filter(equal, lambda e: e)).alias("matched"),
            F.size(expected).alias("length"),
            F.concat(F.lit(" "), F.array_join(here, " "), F.lit(" ")).alias("window"),
        )

    def holds(c: Column) -> Column:
        keys = F.forall(_case(c["pattern"], all_keys, none), lambda k: c["window"].contains(k))
        whole = c["matched"] == c["length"]
        return F.when(c["pattern"] < len(BASE), whole).otherwise((100 * c["matched"] >= NEED * c["length"]) & keys)

    return F.filter(F.transform(agreed, compared), holds)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", frequencies: dict[str, int] | None = None) -> DataFrame:
    """``key, n_words, base, notices, base_labels, labels, score`` for each row.

    ``base`` has the places of the base phrases, as structs ``label, start, words``; ``notices`` those of the notices, with the
    number of words ``matched`` too. ``frequencies`` are the document frequencies of the patterns' words, by default those in ``docs``.
    """
    index = anchors(document_frequencies(docs, text) if frequencies is None else frequencies)
    names = {n: F.lit(p[0]) for n, p in enumerate(patterns())}
    own = docs.select(F.col(f"`{key}`").alias("key"), words_of(F.col(f"`{text}`")).alias("words"))
    voted = own.select("key", "words", _votes(index).alias("votes"))
    found = voted.select("key", F.size("words").cast("long").alias("n_words"), _verified(_agreed(F.col("votes"))).alias("found"))

    def place(c: Column, *more: Column) -> Column:
        label = _case(c["pattern"], names, F.lit(None).cast("string"))
        return F.struct(label.alias("label"), c["start"].cast("long").alias("start"), c["length"].alias("words"), *more)

    is_base = lambda c: c["pattern"] < len(BASE)
    placed = found.select(
        "key",
        "n_words",
        F.transform(F.filter("found", is_base), lambda c: place(c)).alias("base"),
        F.transform(F.filter("found", lambda c: ~is_base(c)), lambda c: place(c, c["matched"].alias("matched"))).alias("notices"),
    )
    share = F.array_max(F.transform("notices", lambda n: n["matched"] / n["words"]))
    return placed.select(
        F.col("key").alias(key),
        "n_words",
        "base",
        "notices",
        _labels(F.col("base.label")).alias("base_labels"),
        _labels(F.concat("base.label", "notices.label")).alias("labels"),
        F.coalesce(share, F.when(F.size("base") > 0, 0.5), F.lit(0.0)).alias("score"),
    )


def _labels(names: Column) -> Column:
    return F.array_join(F.sort_array(F.array_distinct(names)), ",")
