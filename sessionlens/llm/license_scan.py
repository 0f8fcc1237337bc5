"""License scans by an exact set-similarity join (native).

Texts are lower-cased (A-Z only) and split into words.  Base: phrases whose
words stand consecutively, each place counted.  The method: every block of
``BLOCK`` words (one starts each ``STEP`` words, so any run of ``STEP`` words
lies within one) is joined with license templates by token containment: the
share of a template's distinct words that the block holds must be
``CONTAINMENT`` or more.  Notices of one family share most of their words, so
the block must also hold the template's telling phrase, the words that set it
apart from its siblings ("cc by 4 0" against "cc by nc 4 0"), one after the other.

The join is exact and filters before it verifies:

* tokens are ordered by their frequency over all documents, rarest first;
* prefix: a block that holds ``need`` of a template's n words holds one of the
  first n - need + 1, so only blocks with such a word are joined, on that word;
* length: the block must hold ``need`` template words at all, and its document
  ``need`` words of some template;
* position: after the matched word both sides must have enough words left;
* the pairs that remain are verified by intersecting the sets.

Texts are normalised and split once; what the join reads is written, and holds
the words of those documents only that pass the length filter.  Templates and
their words are a fixed list, so they are broadcast.  A null text is empty.
Rows equal in id and text share their labels.  No rows give no rows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import empty_if_null, materialise
from sessionlens.operators.joins import join_per_key

#: Base phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Templates: label, telling phrase and words of well-known license notices (fixed values).
TEMPLATES = [
    ("gpl-3.0", "general public license version 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2.0", "general public license version 2", "this work is licensed under the gnu general public license version 2"),
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("mit-notice", "mit license", "released under the mit license"),
    ("cc-by-4.0", "cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "licensed under cc by sa 4 0"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "licensed under cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "licensed under cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", "licensed under cc by nc nd 4 0"),
    ("cc-by-4.0", "attribution 4 0",
     "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", "attribution sharealike 4 0",
     "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc-4.0", "attribution noncommercial 4 0",
     "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("mit-text", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met"),
    ("gpl-notice", "gnu general public license",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation"),
    ("lgpl-notice", "gnu lesser general public license",
     "this library is free software you can redistribute it and or modify it under the terms of the gnu "
     "lesser general public license as published by the free software foundation"),
    ("agpl-notice", "gnu affero general public license",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "affero general public license as published by the free software foundation"),
    ("mpl-2.0", "mozilla public license",
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]
CONTAINMENT = 0.8
BLOCK = 64
STEP = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced_words(text: Column) -> Column:
    """Every word with one space before and one after it (so two between words)."""
    inner = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), BETWEEN, "  "))
    return F.when(inner == "", F.lit("")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def words_in(spaced: Column) -> Column:
    return ((F.char_length(spaced) - F.char_length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def spaced_phrase(phrase: str) -> str:
    return "".join(f" {w} " for w in phrase.split())


def base_columns(spaced: Column, n_words: Column) -> dict[str, Column]:
    """n_base, first_word, last_word, base (array of labels)."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        p = spaced_phrase(phrase)
        found = F.contains(spaced, F.lit(p))
        without = F.char_length(F.replace(spaced, F.lit(p), F.lit("")))
        counts.append(F.when(found, ((F.char_length(spaced) - without) / len(p)).cast("long")).otherwise(0))
        firsts.append(F.when(found, words_in(F.substring(spaced, F.lit(1), F.instr(spaced, p) - 1))))
        lasts.append(F.when(found, n_words - words_in(F.substring_index(spaced, p, -1)) - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    return {"n_base": sum(counts[1:], counts[0]).cast("long"), "first_word": F.least(*firsts),
            "last_word": F.greatest(*lasts), "base": F.array_compact(F.array(*labels))}


def literal_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def needed(own: list[str], containment: float) -> int:
    """How many of a template's words a block must hold."""
    return math.ceil(containment * len(own) - 1e-9)


def token_order(held: DataFrame, tokens: list[str]) -> list[str]:
    """``tokens`` by the number of documents that hold them, rarest first; ``held`` has each document's."""
    counts = {r["token"]: r["n"] for r in held.select(F.explode("held").alias("token")).groupBy("token")
              .agg(F.count("*").alias("n")).collect()}
    return sorted(tokens, key=lambda t: (counts.get(t, 0), t))


def template_matches(docs: DataFrame, templates: list[tuple[str, str, str]], containment: float = CONTAINMENT) -> DataFrame:
    """key, label, containment for each block and template that match; ``docs`` has key, held and words
    (null where the length filter has ruled all templates out)."""
    spark = docs.sparkSession
    order = token_order(docs, sorted({w for _, _, text in templates for w in text.split()}))
    rank = {t: i for i, t in enumerate(order)}
    index = []
    for label, phrase, text in templates:
        own = sorted(set(text.split()), key=rank.__getitem__)
        need = needed(own, containment)
        index += [(own[i], label, f" {phrase} ", own, len(own) - i - 1, need) for i in range(len(own) - need + 1)]
    prefixes = spark.createDataFrame(index, "token string, label string, phrase string, own array<string>, "
                                            "own_left int, need int")
    rare = sorted({row[0] for row in index}, key=rank.__getitem__)
    # Only documents with such a word are cut into blocks.
    words = docs.filter(F.col("words").isNotNull() & F.arrays_overlap("held", literal_array(rare)))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(STEP))
    blocks = words.select("key", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, F.lit(BLOCK)))).alias("block"))
    hit = blocks.filter(F.arrays_overlap("block", literal_array(rare)))
    # The block's template words in global order, and those among them that some prefix has.
    ordered = hit.select("key", "block", F.array_intersect(literal_array(order), "block").alias("held"))
    probes = ordered.select("key", "block", "held", F.explode(F.array_intersect(literal_array(rare), "held")).alias("token"))
    pairs = probes.join(F.broadcast(prefixes), "token")
    pairs = pairs.filter((F.size("held") >= F.col("need"))
                         & (F.least("own_left", F.size("held") - F.array_position("held", F.col("token")).cast("int")) + 1
                            >= F.col("need")))
    line = F.concat(F.lit(" "), F.array_join("block", " "), F.lit(" "))
    verified = (pairs.withColumn("overlap", F.size(F.array_intersect("own", "held"))).filter("overlap >= need")
                .filter(F.contains(line, F.col("phrase"))))
    return verified.select("key", "label", (F.col("overlap") / F.size("own")).alias("containment"))


def prepared(docs: DataFrame, id_col: str, text_col: str, templates: list[tuple[str, str, str]],
             containment: float) -> DataFrame:
    """One walk over the texts: doc_id, key, n_words, the base columns, held (the template words of the
    document) and, where some template's length filter is passed, its words."""
    text = empty_if_null(text_col)
    spaced = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("key"),
                         spaced_words(text).alias("spaced"))
    # Splitting " a  b " at the double spaces leaves a space at either end.
    words = F.when(F.col("spaced") == "", F.array().cast("array<string>")).otherwise(F.split(F.trim("spaced"), "  "))
    counted = spaced.withColumn("words", words).withColumn("n_words", F.size("words").cast("long"))
    owned = [sorted(set(text.split())) for _, _, text in templates]
    tokens = sorted({w for own in owned for w in own})
    held = counted.withColumn("held", F.array_intersect(literal_array(tokens), "words"))
    passed = reduce(or_, [F.size(F.array_intersect(literal_array(own), "held")) >= needed(own, containment)
                          for own in owned])
    return held.select("doc_id", "key", "n_words", "held", F.when(passed, F.col("words")).alias("words"),
                       *[c.alias(n) for n, c in base_columns(F.col("spaced"), F.col("n_words")).items()])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: list[tuple[str, str, str]] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    templates = TEMPLATES if templates is None else templates
    read = materialise(prepared(docs, id_col, text_col, templates, containment))
    found = (template_matches(read.select("key", "held", "words"), templates, containment).groupBy("key")
             .agg(F.collect_set("label").alias("own_labels"), F.max("containment").alias("containment")))
    joined = join_per_key(read.drop("held", "words"), found, "key", "left")
    own = F.coalesce("own_labels", F.array().cast("array<string>"))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                         F.array_join(F.sort_array(F.array_distinct("base")), ",").alias("base_labels"),
                         F.array_join(F.sort_array(F.array_union("base", own)), ",").alias("labels"),
                         score.alias("score"))
