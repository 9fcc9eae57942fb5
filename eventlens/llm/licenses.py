"""License scan: exact set-similarity join of text blocks with templates.

A block is a window of ``BLOCK_WORDS`` consecutive words of a text, one
starting every ``BLOCK_STEP`` words.  A block matches a template if it holds
at least ``THRESHOLD`` of the template's distinct words (containment).

Words are ordered by the number of texts of the corpus that hold them, rarest
first.  Of a template of s words with minimum overlap o, only its s - o + 1
rarest words can be the first word shared with a matching block (prefix
filter), and that word lies among the block's b - o + 1 rarest (b: template
words the block holds; b < o cannot match, the length filter).  A shared word
at positions i and j leaves at most min(s - i, b - j) shared words (positional
filter).  Survivors are verified by counting.  Words that no template has can
match nothing and are left out of the blocks; the templates' word list is
fixed, so the frequency table has a fixed size and may be sent to all tasks.
Texts are split into words once: what the join needs of them is written to a
table, the template words that each text holds and, for texts that hold enough
of one template's, all their words.  Only these are cut into blocks, after the
length and prefix filters of the whole text.

Besides, the places of fixed license phrases are found in the word sequence.

Only DataFrame functions run here.  Nulls: a null text counts as empty (no
words, no places, no labels, score 0).  Null ids and repeated rows keep their
rows; rows with equal id and text get equal results.

Other columns are not read and may bear any name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm.shared import staged

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BLOCK_WORDS = 64
BLOCK_STEP = 32
THRESHOLD = 0.8

#: Phrase and its label.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: Family, label and wording.  Of one family the best template
#: of a block counts.
TEMPLATES = [
    ("mit", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this"
     " software and associated documentation files to deal in the software without restriction"),
    ("apache", "apache-2", "licensed under the apache license version 2 0 you may not use this file except"
     " in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gpl", "this program is free software you can redistribute it and or modify it under the"
     " terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "lgpl", "this library is free software you can redistribute it and or modify it under the"
     " terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "bsd", "redistribution and use in source and binary forms with or without modification are"
     " permitted provided that the following conditions are met"),
    ("mpl", "mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"
     " if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("cc", "cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc", "cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0"
     " international license"),
    ("cc", "cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0"
     " international license"),
    ("public", "unlicense", "this is free and unencumbered software released into the public domain"),
    ("closed", "all-rights-reserved", "all rights reserved no part of this publication may be reproduced"
     " distributed or transmitted in any form or by any means without prior written permission of the publisher"),
]


def template_sets(templates=None) -> list[tuple[str, str, list[str], int]]:
    """Family, label, distinct words and minimum overlap of every template."""
    out = []
    for family, label, wording in templates or TEMPLATES:
        words = sorted(set(wording.split()))
        need = next(k for k in range(len(words) + 1) if k >= THRESHOLD * len(words) - 1e-9)
        out.append((family, label, words, need))
    return out


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; letters beyond ASCII are word characters."""
    folded = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def _base(words: Column) -> dict[str, Column]:
    """Places of the phrases in a word sequence.

    The words are written with a blank on each side, so neighbouring words
    share none and places are found by plain string search."""
    line = F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))
    parts = []
    for phrase, label in PHRASES:
        size = len(phrase.split())
        look = " " + "  ".join(phrase.split()) + " "
        known = F.forall(F.array(*map(F.lit, sorted(set(phrase.split())))), lambda w: F.array_contains(words, w))
        n = F.when(known, (F.length(line) - F.length(F.replace(line, F.lit(look), F.lit("")))) / len(look))
        n = F.coalesce(n.cast("long"), F.lit(0).cast("long"))
        head = F.substring_index(line, look, 1)
        tail = F.substring_index(line, look, -1)

        def blanks(part: Column) -> Column:
            return ((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("long")

        parts.append(F.struct(
            F.lit(label).alias("label"), n.alias("n"),
            F.when(n > 0, blanks(head)).alias("first"),
            F.when(n > 0, F.size(words) - blanks(tail) - size).cast("long").alias("last"),
        ))
    return {"__places": F.array(*parts)}


def _held(words: Column, order: list[str], least: int, heads: list[str]) -> Column:
    """An array holding the template words of ``words`` in the order ``order``,
    or nothing if they are too few or no head is in their prefix."""
    tokens = F.array_intersect(F.array(*map(F.lit, order)), words)
    head = F.array(*map(F.lit, heads))
    return F.filter(F.array(tokens), lambda t: (F.size(t) >= least) & F.arrays_overlap(
        F.slice(t, F.lit(1), F.greatest(F.size(t) - (least - 1), F.lit(0))), head))


def held_words(words: Column, sets) -> Column:
    """The template words that a text holds."""
    vocabulary = sorted({w for s in sets for w in s[2]})
    return F.array_intersect(F.array(*map(F.lit, vocabulary)), words)


def may_match(held: Column, sets) -> Column:
    """Whether a text holds enough words of a template in all."""
    enough = F.lit(False)
    for _, _, words, need in sets:
        enough = enough | (F.size(F.array_intersect(F.array(*map(F.lit, words)), held)) >= need)
    return enough


def candidate_blocks(rows: DataFrame, order: list[str], least: int, heads: list[str]) -> DataFrame:
    """``__id, __text_hash, __block, __tokens`` of blocks that pass the length
    and prefix filters; texts that fail them as a whole are not cut at all."""
    n = F.size("__words")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), n - BLOCK_WORDS + BLOCK_STEP - 1), F.lit(BLOCK_STEP))
    cut = F.transform(starts, lambda at: F.slice("__words", at + 1, F.lit(BLOCK_WORDS)))
    texts = rows.select(
        "__id", "__text_hash", "__words", F.explode(_held(F.col("__words"), order, least, heads)).alias("__all"))
    return (
        texts.select("__id", "__text_hash", F.posexplode(cut).alias("__block", "__cut"))
        .select("__id", "__text_hash", "__block",
                F.explode(_held(F.col("__cut"), order, least, heads)).alias("__tokens"))
    )


def _template_table(spark: SparkSession, sets, order: list[str]) -> DataFrame:
    """Prefix index: one row per template and word of its prefix."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for k, (family, label, words, need) in enumerate(sets):
        ranked = sorted(words, key=rank.__getitem__)
        rows += [(w, i, k, family, label, ranked, len(words), need)
                 for i, w in enumerate(ranked[:len(words) - need + 1])]
    names = ("word", "i", "template", "family", "label", "t", "s", "o")
    lit = [F.struct(*((F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(n)
                      for n, v in zip(names, row, strict=True))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*lit)))


def block_matches(rows: DataFrame, templates=None) -> DataFrame:
    """``__id, __text_hash, __block, family, label, containment`` of every
    block that meets the threshold; best template of a family only.

    ``rows``: ``__id, __text_hash``, ``__held`` (see ``held_words``) and
    ``__words``, which only texts that ``may_match`` need."""
    sets = template_sets(templates)
    vocabulary = sorted({w for s in sets for w in s[2]})
    held = rows.select(F.explode("__held").alias("w"))
    rows = rows.where("__words is not null")
    seen = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    index = _template_table(rows.sparkSession, sets, order)
    least = min(s[3] for s in sets)
    heads = sorted({w for s in sets for w in sorted(s[2], key=order.index)[:len(s[2]) - s[3] + 1]})
    found = candidate_blocks(rows, order, least, heads).withColumn("b", F.size("__tokens"))
    probes = found.select("*", F.posexplode(F.slice("__tokens", F.lit(1), F.col("b") - (least - 1))).alias("j", "word"))
    candidates = (
        probes.join(F.broadcast(index), "word")  # a few rows per template
        .where("b >= o and j <= b - o and least(s - i, b - j) >= o")
        .dropDuplicates(["__id", "__text_hash", "__block", "template"])
    )
    verified = (
        candidates.withColumn("shared", F.size(F.array_intersect("t", "__tokens"))).where("shared >= o")
    )
    return (
        verified.groupBy("__id", "__text_hash", "__block", "family")
        .agg(F.max(F.struct((F.col("shared") / F.col("s")).alias("containment"), "s", "label")).alias("best"))
        .select("__id", "__text_hash", "__block", "family", "best.label", "best.containment")
    )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, n_base, first_word,
    last_word, base_labels, labels, score`` (the best containment, 1 where a
    phrase stands, else 0)."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("__id"), F.xxhash64(F.col(f"`{text_col}`")).alias("__text_hash"),
        words_of(F.col(f"`{text_col}`")).alias("__words"),
    )
    sets = template_sets()
    rows = rows.withColumns({**_base(F.col("__words")), "__held": held_words(F.col("__words"), sets)})
    rows = staged(rows.select(
        "__id", "__text_hash", F.size("__words").cast("long").alias("n_words"),
        F.filter("__places", lambda p: p["n"] > 0).alias("__places"), "__held",
        F.when(may_match(F.col("__held"), sets), F.col("__words")).alias("__words")), "words")
    found = (
        block_matches(rows).groupBy("__id", "__text_hash")
        .agg(F.collect_set("label").alias("__found"), F.max("containment").alias("__best"))
        .select(F.col("__id").alias("m_id"), F.col("__text_hash").alias("m_hash"), "__found", "__best")
    )
    base = rows.select("__id", "__text_hash", "n_words", "__places")
    joined = base.join(
        found, base["__id"].eqNullSafe(found["m_id"]) & (base["__text_hash"] == found["m_hash"]), "left")
    own = F.array_sort(F.array_distinct(F.transform("__places", lambda p: p["label"])))
    every = F.array_sort(F.array_distinct(F.concat(
        F.transform("__places", lambda p: p["label"]), F.coalesce("__found", F.array().cast("array<string>")))))
    return joined.select(
        F.col("__id").alias(id_col), "n_words",
        F.aggregate("__places", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_base"),
        F.array_min(F.transform("__places", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("__places", lambda p: p["last"])).alias("last_word"),
        F.array_join(own, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("__places") > 0, F.lit(1.0)).otherwise(F.coalesce("__best", F.lit(0.0))).alias("score"),
    )
