"""License scan by a positional index of rare words.

A template is a notice as words, with a phrase of it that must stand word for word (its key). The index has the rarest words of
every key, those of the highest IDF over all files that are scanned, with their places in the key. In a file, the places of
indexed words are looked up: each gives, less the word's place in the key, a start of the key, and what the starts of all indexed
words of a key have in common is where the key may stand. There the whole phrase is verified, word by word. As every place of a
key has all its words, none is lost, whichever words are rare; rare words only keep candidates few.

How much of the notice around a key is there is its score: the share, weighed by IDF, of the notice's words that stand near.

Everything is column expressions over one row: a file is never exploded, shuffled or joined. Only the words of the templates are
counted over all files beforehand (a row a word comes to the driver, so their number is bound by the templates).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name


class Template(NamedTuple):
    """A notice and its key, as lower-case words with single spaces; an empty notice is its key."""

    label: str
    key: str
    notice: str = ""
    base: bool = False

    @property
    def words(self) -> list[str]:
        return (self.notice or self.key).split()

    @property
    def at(self) -> int:
        """The key's first word in the notice."""
        phrase, words = self.key.split(), self.words
        return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


#: Short phrases, and the sentences by which public licences are told.
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2", "you may not use this file except in compliance with the license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("gpl-2", "gnu general public license version 2", "licensed under the gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3", "licensed under the gnu general public license version 3"),
    Template("gpl", "under the terms of the gnu general public license", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "gnu lesser general public license", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    Template("agpl", "gnu affero general public license", "under the terms of the gnu affero general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("epl", "eclipse public license", "made available under the terms of the eclipse public license"),
    Template("unlicense", "free and unencumbered software released into the public domain", "this is free and unencumbered software released into the public domain"),
    Template("cc-by", "creative commons attribution", "licensed under a creative commons attribution international license"),
    Template("cc0", "cc0 1 0 universal"),
)
#: Words of a key that the index has; words of a file before and after a notice's own place that count for its score.
RARE, SLACK = 2, 10

_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text (null: none) as an array. A-Z are lower-cased.

    `lower` knows other letters too, which no word of a template has; only the Kelvin sign would become an ASCII letter.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Å")))
    return F.array_remove(F.split(low, _APART), "")


def idf(files: DataFrame, text: str, templates: Sequence[Template] = TEMPLATES) -> dict[str, int]:
    """The weight of every word of the templates: thousandths of log2((files + 1) / (files with the word + 1)), and 1."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = F.array_distinct(F.filter(words_of(F.col(text)), lambda w: w.isin(vocabulary)))
    # The empty word counts the files.
    rows = files.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    n = {r["word"]: r["n"] for r in rows}
    return {w: 1 + round(1000 * math.log2((n.get("", 0) + 1) / (n.get(w, 0) + 1))) for w in vocabulary}


def index(templates: Sequence[Template], weights: dict[str, int], rare: int = RARE) -> list[list[tuple[str, int]]]:
    """Of each template, the rarest words of its key with their (first) places in it."""
    out = []
    for t in templates:
        key = t.key.split()
        out.append([(w, key.index(w)) for w in sorted(set(key), key=lambda w: (-weights[w], w))[:rare]])
    return out


def scan(files: DataFrame, text: str = "text", templates: Sequence[Template] = TEMPLATES, rare: int = RARE, slack: int = SLACK) -> DataFrame:
    """files with n_words and license_places: an array of (label, template, base, start, words, score), one for every place of
    every key; start is the number of words before the key's first, template the template's number.

    One row per row of files; a null or empty text has no words and no places. Overlapping places all count. Columns of files
    that are named n_words or license_places are replaced; other columns stay. A table without rows gives none.
    """
    names = [c for c in files.columns if c.lower() not in ("n_words", "license_places")]
    weights = idf(files, text, templates)
    postings = index(templates, weights, rare)
    indexed = sorted({w for posting in postings for w, _ in posting})
    words, spots, *found = (free_name(files, x) for x in ("license_words", "license_spots", *(f"license_word_{i}" for i in range(len(indexed)))))
    at = dict(zip(indexed, found, strict=True))
    word, empty = (lambda i: F.get(F.col(words), i)), F.array().cast("array<int>")

    df = files.select(*names, words_of(F.col(text)).alias(words))
    size = F.size(words)
    df = df.withColumn(spots, F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), lambda i: word(i).isin(indexed))).otherwise(empty))
    df = df.withColumns({at[w]: _equal(spots, word, w) for w in indexed})
    parts = [_places(number, t, [(at[w], place) for w, place in posting], word, F.col(words), weights, slack) for number, (t, posting) in enumerate(zip(templates, postings, strict=True))]
    places = F.when(F.size(spots) > 0, F.concat(*parts)).otherwise(F.array().cast("array<struct<label:string,template:int,base:boolean,start:int,words:int,score:double>>"))
    return df.select(*names, size.cast("long").alias("n_words"), places.alias("license_places"))


def _equal(spots: str, word: Callable[[Column], Column], w: str) -> Column:
    return F.filter(spots, lambda i: word(i) == w)


def _places(number: int, t: Template, posting: list[tuple[str, int]], word: Callable[[Column], Column], words: Column, weights: dict[str, int], slack: int) -> Column:
    """The places of one template: starts that all its indexed words agree on, where the whole key stands."""
    key = t.key.split()

    def shifted(column: str, place: int) -> Column:
        return F.transform(column, lambda i: i - place)

    def stands(s: Column) -> Column:
        return F.coalesce(reduce(lambda a, b: a & b, [s >= 0, *(word(s + j) == w for j, w in enumerate(key))]), F.lit(False))

    def place(s: Column) -> Column:
        values = {"label": F.lit(t.label), "template": F.lit(number), "base": F.lit(t.base), "start": s, "words": F.lit(len(key)), "score": _score(words, s, t, weights, slack)}
        return F.struct(*[v.alias(k) for k, v in values.items()])

    return F.transform(F.filter(reduce(F.array_intersect, [shifted(*p) for p in posting]), stands), place)


def _score(words: Column, start: Column, t: Template, weights: dict[str, int], slack: int) -> Column:
    """The weighed share of the notice's different words in the file's words about its place."""
    own = sorted(set(t.words))
    if own == sorted(set(t.key.split())):
        return F.lit(1.0)
    first = F.greatest(start - t.at - slack, F.lit(0))
    near = F.slice(words, first + 1, start - t.at + len(t.words) + slack - first)
    weight = F.create_map(*[F.lit(x) for w in own for x in (w, weights[w])])
    total = sum(weights[w] for w in own)
    return F.aggregate(F.array_intersect(F.array(*map(F.lit, own)), near), F.lit(0).cast("long"), lambda a, w: a + weight[w]) / F.lit(float(total))
