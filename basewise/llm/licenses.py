"""License notices in texts: phrases, and an exact containment join with notice templates.

A block is a set of distinct words: one line of a text or, since notices are wrapped,
a run of words across line ends, sized by the template that it is compared with. A
block matches a template when it holds at least ``threshold`` of the template's
distinct words. Tokens are
ordered by how many blocks of all texts hold them, rarest first. A block that
matches must hold one of the rarest tokens of the template (prefix), have words
enough (length), and its rarest common token must stand early enough in the
template (position); what passes is counted exactly. Everything is column
functions: the texts are read once for lines and once for runs, a block is reduced
to the words that any template has, kept in the shared folder, counted, and joined with the table of
prefix tokens, whose size the templates fix.

Null texts count as empty and hold nothing, repeated rows get equal results, null
ids stay, an empty table gives none. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basewise.llm.common import settle

THRESHOLD = 0.8
# The templates' words in all; what is made from them is broadcast.
MOST_TEMPLATE_WORDS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What stands between words, line ends apart.
BETWEEN = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = "  "

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# First sentences of public license notices, and short forms.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def lines_of(text: Column) -> Column:
    """The lines of a text in lower case (ASCII), as words with ``GAP`` between them."""
    text = F.coalesce(text, F.lit(""))
    # lower() is quick, and equal to the plain rule but for two letters that become ASCII ones.
    plain = ~(F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a")))
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(F.split(F.regexp_replace(lowered, BETWEEN, GAP), "\n"), lambda line: F.trim(line))


def count_gaps(words: Column) -> Column:
    """How many gaps a line has."""
    return (F.octet_length(words) - F.octet_length(F.replace(words, F.lit(GAP), F.lit("")))) / 2


def count_words(words: Column) -> Column:
    """How many words stand in a text in which every word has a space on either side."""
    return ((F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" "), F.lit("")))) / 2).cast("long")


def phrase_columns(phrases: Mapping[str, str]) -> list[Column]:
    """``n_words``, ``n_base``, ``first_word``, ``last_word`` and the array ``base`` from the column ``words``."""
    words = F.col("words")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in sorted(phrases.items()):
        parts = phrase.split()
        look = F.lit("".join(f" {p} " for p in parts))
        has = F.contains(words, look)
        size = sum(len(p) + 2 for p in parts)
        places = ((F.octet_length(words) - F.octet_length(F.replace(words, look, F.lit("")))) / size).cast("long")
        counts.append(F.when(has, places).otherwise(F.lit(0).cast("long")))
        firsts.append(F.when(has, count_words(F.substring_index(words, "".join(f" {p} " for p in parts), 1))))
        behind = count_words(F.substring_index(words, "".join(f" {p} " for p in parts), -1))
        lasts.append(F.when(has, F.col("n_words") - behind - len(parts)))
        labels.append(F.when(has, F.lit(label)))
    total = counts[0]
    for c in counts[1:]:
        total = total + c

    def pick(f, columns: Sequence[Column]) -> Column:
        return f(*columns) if len(columns) > 1 else columns[0]

    return [total.alias("n_base"), pick(F.least, firsts).alias("first_word"), pick(F.greatest, lasts).alias("last_word"), F.array_compact(F.array(*labels)).alias("base")]


def holds(word: str) -> Callable[[Column], Column]:
    """Whether a line contains a word (or a longer one with it)."""
    return lambda line: F.contains(line, F.lit(word))


def blocks(docs: DataFrame, phrases: Mapping[str, str], vocabulary: Sequence[str]) -> DataFrame:
    """The lines of ``docs`` (``key`` and ``text``) in one pass over the texts.

    ``row``; ``n_words``, ``n_base``, ``first_word``, ``last_word`` and ``base`` of
    the whole text; ``at``, the line's number; ``size``, its words; ``tokens``, its
    distinct words of the vocabulary. The first line of each text is there, of the
    others those that have tokens.
    """
    # Rows of one id and text share what is found.
    row = F.xxhash64(F.col("key"), F.col("text"), F.length("text"))
    found = docs.select("key", row.alias("row"), lines_of(F.col("text")).alias("lines"))
    per_line = F.transform("lines", lambda w: F.when(w == "", F.lit(0)).otherwise(count_gaps(w) + 1))
    n_words = F.aggregate(per_line, F.lit(0.0), lambda s, n: s + n).cast("long")
    # Only texts in which the longest word of a phrase stands are put together again.
    likely = F.lit(False)
    for word in sorted({max(p.split(), key=len) for p in phrases}):
        likely = likely | F.exists("lines", holds(word))
    whole = F.array_join(F.filter("lines", lambda w: w != ""), GAP)
    words = F.when(likely, F.concat(F.lit(" "), whole, F.lit(" "))).otherwise(F.lit(""))
    found = found.select("key", "row", "lines", n_words.alias("n_words"), words.alias("words"))
    found = found.select("key", "row", "lines", "n_words", *phrase_columns(phrases))
    found = found.select("key", "row", "n_words", "n_base", "first_word", "last_word", "base", F.posexplode("lines").alias("at", "line"))
    # A list of bounded size: MOST_TEMPLATE_WORDS.
    tokens = F.array_distinct(F.filter(F.split("line", GAP), lambda w: w.isin(list(vocabulary))))
    return found.select("key", "row", "n_words", "n_base", "first_word", "last_word", "base", "at", (count_gaps(F.col("line")) + 1).alias("size"), tokens.alias("tokens")).where((F.size("tokens") > 0) | (F.col("at") == 0))


def span_of(text: str, threshold: float) -> int:
    """Words in which a template's notice stands whole, with as many words between as the threshold allows to be missing."""
    return ceil(len(text.split()) / threshold - 1e-9)


def place_of(span: int, least: int) -> Callable[[Column], Column]:
    """From the number of a run to its place, its span and the fewest words that a match needs."""
    return lambda i: F.struct((i * span).alias("start"), F.lit(span).alias("span"), F.lit(least).alias("least"))


def windows(docs: DataFrame, templates: Sequence[tuple[str, str]], threshold: float, vocabulary: Sequence[str]) -> DataFrame:
    """Runs of words across line ends in texts of several lines: ``row``, ``span``, ``size`` and ``tokens``.

    Runs of twice ``span`` words begin every ``span`` words, so that any ``span``
    words in a row stand in one of them. A text that matches a template must hold
    one of its k - need + 1 longest words; others are not cut up for its span.
    """
    row = F.xxhash64(F.col("key"), F.col("text"), F.length("text"))
    several = docs.where(F.contains("text", F.lit("\n"))).select(row.alias("row"), lines_of(F.col("text")).alias("lines"))
    whole = several.select("row", F.array_join(F.filter("lines", lambda w: w != ""), GAP).alias("whole"))
    by_span: dict[int, tuple[set[str], list[int]]] = {}
    for _, text in templates:
        words = sorted(set(text.split()), key=lambda w: (-len(w), w))
        need = ceil(threshold * len(words) - 1e-9)
        longest, needs = by_span.setdefault(span_of(text, threshold), (set(), []))
        longest.update(words[: len(words) - need + 1])
        needs.append(need)
    n = count_gaps(F.col("whole")) + 1
    starts = []
    for span, (longest, needs) in sorted(by_span.items()):
        likely = F.lit(False)
        for word in sorted(longest):
            likely = likely | F.contains("whole", F.lit(word))
        last = F.greatest(F.ceil(n / span) - 2, F.lit(0)).cast("int")
        none = F.array().cast("array<struct<start: int, span: int, least: int>>")
        starts.append(F.when(likely, F.transform(F.sequence(F.lit(0), last), place_of(span, min(needs)))).otherwise(none))
    placed = whole.select("row", "whole", F.concat(*starts).alias("starts")).where(F.size("starts") > 0)
    # Only places are multiplied; the words of a run are cut out behind that.
    each = placed.select("row", F.split("whole", GAP).alias("words"), "starts").select("row", "words", F.explode("starts").alias("run"))
    words = F.slice("words", F.col("run.start") + 1, F.col("run.span") * 2)
    cut = each.select("row", "run.span", "run.least", words.alias("words"))
    tokens = F.array_distinct(F.filter("words", lambda w: w.isin(list(vocabulary))))
    found = cut.select("row", "span", "least", F.size("words").cast("double").alias("size"), tokens.alias("tokens"))
    return found.where(F.size("tokens") >= F.col("least")).drop("least")


def vocabulary_of(templates: Sequence[tuple[str, str]]) -> list[str]:
    """The distinct words of all templates; their number is bounded, since lists of them go to every task."""
    if sum(len(text.split()) for _, text in templates) > MOST_TEMPLATE_WORDS:
        raise ValueError("the templates are too large to be sent to every task")
    return sorted({w for _, text in templates for w in text.split()})


def containment_join(found: DataFrame, templates: Sequence[tuple[str, str]], threshold: float) -> DataFrame:
    """``row``, ``label`` and ``containment`` for every block (``row``, ``span``, ``size``, ``tokens``) and template that match.

    A block whose ``span`` is 0 is compared with all templates, others with those of their span.
    """
    spark = found.sparkSession
    sets = [(i, label, sorted(set(text.split()))) for i, (label, text) in enumerate(templates)]
    # Blocks that hold each token, over all texts; one row per word of the vocabulary.
    frequency = found.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    spans = [span_of(text, threshold) for _, text in templates]
    listed = spark.createDataFrame([(i, label, w, len(words), ceil(threshold * len(words) - 1e-9), spans[i]) for i, label, words in sets for w in words], "template int, label string, token string, k int, need int, own_span int")
    by_rank = Window.partitionBy("template").orderBy("n", "token")
    ranked = listed.join(F.broadcast(frequency), "token", "left").na.fill(0, ["n"]).withColumn("at", F.row_number().over(by_rank) - 1)
    ordered = ranked.withColumn("all_tokens", F.sort_array(F.collect_list(F.struct("at", "token")).over(Window.partitionBy("template"))).getField("token"))
    # Prefix: of the k tokens the rarest k - need + 1.
    prefix = ordered.where(F.col("at") <= F.col("k") - F.col("need")).select("template", "label", "token", "k", "need", "at", "all_tokens", "own_span")
    pairs = found.withColumn("token", F.explode("tokens")).join(F.broadcast(prefix), "token").where((F.col("span") == 0) | (F.col("span") == F.col("own_span")))
    # Length, position, and only the rarest common token makes a candidate.
    earlier = F.slice("all_tokens", F.lit(1), F.col("at"))
    candidates = pairs.where((F.col("size") >= F.col("need")) & (F.col("k") - F.col("at") >= F.col("need")) & ~F.arrays_overlap(earlier, F.col("tokens")))
    common = F.size(F.array_intersect("tokens", "all_tokens"))
    return candidates.where(common >= F.col("need")).select("row", "label", (common / F.col("k")).alias("containment"))


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: key, ``n_words``, ``n_base`` (places of phrases), ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    ``score`` is the best containment of a template in a block, 1 where a phrase stands.
    """
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    vocabulary = vocabulary_of(templates)
    found = settle(blocks(narrow, phrases, vocabulary))
    runs = settle(windows(narrow, templates, threshold, vocabulary))
    every_block = found.select("row", F.lit(0).alias("span"), "size", "tokens").unionByName(runs)
    matched = containment_join(every_block, templates, threshold)
    best = matched.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment"))
    joined = found.where(F.col("at") == 0).join(best, "row", "left")
    every = F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        F.col("key").alias(key), "n_words", "n_base", F.col("first_word"), F.col("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
