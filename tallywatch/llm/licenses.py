"""License scans with a positional index of licence phrases, in DataFrame functions only."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: How far, in words, a further key phrase may stand from its place in the template.
SLACK = 8


@dataclass(frozen=True)
class Template:
    """A licence text or phrase. keys[0] must stand word for word and fixes where the template lies; the other keys must stand
    within SLACK words of their place. base: counts as a plain phrase, too."""
    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def phrases(self) -> list[tuple[int, list[str]]]:
        """Key phrases with their places in the template."""
        out = []
        for key in self.keys or (self.text,):
            k, w = key.split(), self.words
            out.append((next(i for i in range(len(w)) if w[i:i + len(k)] == k), k))
        return out


# Public licence phrases and notices, in the words that scanning sees.
TEMPLATES = (
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "under the mit license", base=True),
    Template("agpl-3", "gnu affero general public license version 3", ("gnu affero general public license version 3",)),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl-2.1", "gnu lesser general public license version 2 1"),
    Template("lgpl-3", "gnu lesser general public license version 3"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
             "files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
             ("licensed under the apache license version 2 0", "in compliance with the license")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "conditions are met")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify", "is hereby granted")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
             ("provided as is without any express or implied warranty",)),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SPLIT), "")


def _array(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def document_frequency(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each licence word stands, over all of them; the result has a row per word of the templates."""
    found = words.select(F.explode(F.array_intersect("words", F.expr(_array(vocabulary)))).alias("w"))
    return {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, places: array of (label, base, start, share), one for each place of a template.

    Method: the templates' words are counted over all documents; each template is indexed under the two rarest words of its first
    key phrase. A document's words are looked up in that index; postings are intersected by relative position (both words must
    imply the same start), then the key phrases are verified. share: part of the template's words that stand at their place.
    Everything happens within a row, so there is no shuffle but that of the counts (a row per licence word).

    Null text: no words. Repeated rows: each is scanned. Null doc_id: kept as null. Empty table: no rows. Other columns are not looked at.
    """
    words = docs.select(docs["doc_id"].cast("long").alias("doc_id"), words_of(docs["text"]).alias("words"))
    vocabulary = sorted({w for t in templates for _, key in t.phrases() for w in key})
    df = document_frequency(words, vocabulary)

    def rare(template: Template) -> list[tuple[int, str]]:
        at, key = template.phrases()[0]
        return sorted(((at + j, w) for j, w in enumerate(key)), key=lambda x: (df.get(x[1], 0), x[1], x[0]))[:2]

    anchors = sorted({rare(t)[0][1] for t in templates})
    entries = F.expr(f"filter(transform(words, (w, i) -> struct(w as w, i as i)), s -> s.w in ({', '.join(f"'{a}'" for a in anchors)}))")
    places = [_places(t, rare(t)) for t in templates]
    return (words.withColumn("found", entries)
            .select("doc_id", F.size("words").cast("long").alias("n_words"), F.expr(f"flatten(array({', '.join(places)}))").alias("places")))


def _places(t: Template, rare: list[tuple[int, str]]) -> str:
    at, word = rare[0]
    starts = f"transform(filter(found, s -> s.w = '{word}'), s -> s.i - {at})"
    if len(rare) > 1:
        starts = f"filter({starts}, p -> get(words, p + {rare[1][0]}) = '{rare[1][1]}')"
    (first, key), *more = t.phrases()
    checks = [f"p + {first} >= 0 and slice(words, greatest(p + {first}, 0) + 1, {len(key)}) = {_array(key)}"]
    for place, key in more:
        checks.append(f"exists(sequence(greatest(p + {place - SLACK}, 0), greatest(p + {place + SLACK}, 0)), q -> slice(words, q + 1, {len(key)}) = {_array(key)})")
    share = f"aggregate(transform({_array(t.words)}, (w, j) -> if(get(words, p + j) = w, 1, 0)), 0, (a, b) -> a + b) / {len(t.words)}D" if more or t.keys else "1D"
    return (f"transform(filter({starts}, p -> {' and '.join(checks)}), p -> "
            f"struct('{t.label}' as label, {str(t.base).lower()} as base, cast(p as bigint) as start, coalesce({share}, 0D) as share))")
