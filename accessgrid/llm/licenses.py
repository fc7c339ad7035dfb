"""License scan: phrases in texts, and an exact set-similarity join with license templates.

Texts are cut into paragraphs (runs of lines that aren't blank).  A paragraph meets a template if one of
its lines, or a window of its words as long as the template, holds at least CONTAINMENT of the
template's words; windows go across line feeds, so wrapped templates are met.  The words of all
templates are ordered by how many paragraphs hold them, rarest first.  A paragraph that meets a
template must hold one of the template's first words in that order (prefix filter), must be long
enough (length filter), and the first word found must leave enough behind it (positional filter);
lines and windows of what is left are counted exactly.  Templates are a parameter of bounded size;
paragraphs never leave their row until they have met one.
"""
from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessgrid.llm.common import row_key, written

CONTAINMENT = 0.8
# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Statements and opening paragraphs of public licenses.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of digits, letters a-z and characters beyond ASCII.  Only A-Z are lower-cased: the two
    other letters whose lower case is in a-z are kept from it."""
    safe = F.translate(text, "İK", "ıĸ")
    return F.array_remove(F.split(F.lower(safe), _BETWEEN), "")


def _template_words(text: str) -> list[str]:
    return [w for w in re.split(_BETWEEN, text.lower()) if w]


def _literal(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def phrase_places(w: Column, phrase: str) -> Column:
    """Word numbers, from 0, where the phrase's words stand one after another."""
    first, *rest = phrase.split()

    def here(i: Column) -> Column:
        hit = F.get(w, i) == first
        for n, word in enumerate(rest, 1):
            hit &= F.coalesce(F.get(w, i + n) == word, F.lit(False))
        return hit

    there = F.array_contains(w, first) & F.array_contains(w, rest[-1] if rest else first)
    none = F.array().cast("array<int>")
    return F.when(there, F.filter(F.sequence(F.lit(0), F.size(w) - 1), here)).otherwise(none)


def base(df: DataFrame, id_col: str, text: str, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base): the phrases' places in whole texts."""
    split = df.select(row_key(id_col, text).alias("key"), words(F.coalesce(F.col(text), F.lit(""))).alias("w"))
    found = {p: f"p{n}" for n, p in enumerate(phrases)}
    for phrase, name in found.items():
        split = split.withColumn(name, phrase_places(F.col("w"), phrase))
    places = F.concat(*found.values())
    labels = [F.when(F.size(found[p]) > 0, F.lit(label)) for p, label in phrases.items()]
    return split.select(
        "key",
        F.size("w").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.filter(F.array(*labels), lambda x: x.isNotNull()).alias("base"),
    )


def blocks(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(key, block, tokens): the paragraphs of the texts and their distinct words."""
    split = F.transform(F.split(F.col(text), r"\n\s*\n"), lambda p: F.struct(p.alias("block"), F.array_distinct(words(p)).alias("tokens")))
    return df.select(row_key(id_col, text).alias("key"), F.explode(split).alias("p")).select("key", "p.*").filter(F.size("tokens") > 0)


def ordered_templates(tokens: DataFrame, templates: list[tuple[str, str]], containment: float) -> list[dict]:
    """Templates with their words in the order of all blocks' frequencies, rarest first.

    The frequencies of the templates' words, a bounded number, come to the driver.
    """
    vocabulary = sorted({w for _, t in templates for w in _template_words(t)})
    hits = tokens.select(F.explode(F.array_intersect("tokens", _literal(vocabulary))).alias("word"))
    counts = {r["word"]: r["n"] for r in hits.groupBy("word").agg(F.count("*").alias("n")).collect()}
    out = []
    for label, text in templates:
        row = _template_words(text)
        own = sorted(set(row), key=lambda w: (counts.get(w, 0), w))
        need = math.ceil(containment * len(own) - 1e-9)
        out.append({"label": label, "words": own, "need": need, "length": len(row), "prefix": own[: len(own) - need + 1]})
    return out


def matches(tokens: DataFrame, templates: list[dict]) -> DataFrame:
    """(key, label, score) of each paragraph and template that meet in a line or window."""
    prefix = sorted({w for t in templates for w in t["prefix"]})
    least = min(t["need"] for t in templates)
    near = tokens.filter((F.size("tokens") >= least) & F.arrays_overlap("tokens", _literal(prefix)))
    found = []
    for t in templates:
        own, size = _literal(t["words"]), len(t["words"])
        common = F.array_intersect(own, F.col("tokens"))  # in the templates' order
        behind = size - F.array_position(own, F.element_at(common, 1)) + 1
        fits = (F.size("tokens") >= t["need"]) & F.arrays_overlap("tokens", _literal(t["prefix"]))
        fits &= F.when(fits, (behind >= t["need"]) & (F.size(common) >= t["need"])).otherwise(F.lit(False))
        values = {"label": F.lit(t["label"]), "own": own, "need": F.lit(t["need"]), "length": F.lit(t["length"])}
        found.append(F.when(fits, F.struct(*[v.alias(k) for k, v in values.items()])))
    maybe = near.select("key", "block", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("t"))
    # Through explode, so that the words are made once and not anew for each window.
    made = F.struct(words(F.col("block")).alias("w"), F.transform(F.split("block", "\n"), words).alias("lines"))
    split = maybe.select("key", "t.*", F.explode(F.array(made)).alias("b")).select("key", "label", "own", "need", "length", "b.*")
    held = lambda some: F.size(F.array_intersect("own", some))
    starts = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: F.array_contains("own", F.element_at("w", i)))
    windows = F.transform(starts, lambda i: held(F.slice("w", i, F.col("length"))))
    best = F.greatest(F.array_max(windows), F.array_max(F.transform("lines", held)))
    met = split.select("key", "label", "need", F.size("own").alias("size"), best.alias("best")).filter("best >= need")
    return met.select("key", "label", (F.col("best") / F.col("size")).alias("score"))


def license_scan(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row for each row of df.

    score is the largest containment of a template in a line or window of words, 1 where a phrase is found, else 0.
    Null and empty texts have no words, empty label lists and null places.  Repeated rows are judged
    alike.  Further columns are not read.
    """
    tokens = blocks(df, id_col, text)
    met = matches(tokens, ordered_templates(tokens, templates, containment))
    added = written(met.groupBy("key").agg(F.collect_set("label").alias("added"), F.max("score").alias("best")))
    joined = base(df, id_col, text).join(added, "key", "left")
    none = F.array().cast("array<string>")
    line = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return joined.select(
        F.col("key.id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        line(F.col("base")).alias("base_labels"),
        line(F.concat("base", F.coalesce("added", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
