"""License scans: exact set-similarity join, in DataFrame functions only.

Text blocks (sentences and lines; sentences across lines for :func:`notices`) and license templates are sets of words. A block
matches a template if it holds at least ``CONTAINMENT`` of the template's words.
The join finds every such pair:

* the templates' words are ordered by how many documents hold them, rarest first;
* prefix filter: with an overlap of ``need`` words, a template's first
  ``size - need + 1`` words and a block's first ``size - need + 1`` template words
  have one in common, so an equality join on prefix words makes all candidates;
* length filter: the block has ``need`` template words at least;
* positional filter: what follows the common word on both sides suffices;
* candidates are verified by the intersection of both sets.

Templates that differ by one word hold each other's words: :func:`notices` keeps a
match only if its block also has the template's ``TELLING`` words, in order.

Words that no template has can't match and are left out before the join; documents
without any prefix word are left out before their blocks are made. What is
broadcast is the table of templates, a constant.

Base phrases are looked for in the whole word sequence, across blocks.

Defined results: a null text is empty; a text without words has 0 words, no places
and score 0; a word is a run of digits, letters and characters beyond ASCII, A-Z
in lower case; repeated rows have the same result; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm._common import prepare, text_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Blocks end at line breaks and at sentence ends.
BLOCK_END = r"[\r\n]+|(?<=[.!?])[ \t]+"
#: Blocks of :func:`notices` end at blank lines and at sentence ends: hard-wrapped notices stay whole, "v. 2.0" too.
NOTICE_END = r"(?>\r\n|[\r\n])[ \t]*(?>\r\n|[\r\n])\s*|(?<=[.!?])\s+(?!\d)"
CONTAINMENT = 0.8

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Labels of the method and the notices that they stand for.
TEMPLATES = {
    "agpl-3.0": "licensed under the gnu affero general public license version 3",
    "all-rights-reserved": "all rights reserved",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-4.0": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "cc0-1.0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose is hereby granted",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}

#: What a notice of the label must have, whatever else it holds of the template (patterns over
#: the block's words, each between single blanks).
TELLING = {
    "agpl-3.0": "(?s)(?=.* gnu affero general public license )(?=.* (v|version )3 )",
    "all-rights-reserved": " all rights reserved ",
    "apache-2.0": "(?s)(?=.* apache license )(?=.* v?2 0 )",
    "bsd": " source and binary forms ",
    "cc-by-4.0": " creative commons attribution (version )?v?4 0 ",
    "cc-by-nc-4.0": " cc by nc (version )?v?4 0 ",
    "cc-by-sa-4.0": " cc by sa (version )?v?4 0 ",
    "cc0-1.0": " waived all copyright ",
    "gpl-3.0": "(?s)(?=.* gnu general public license )(?=.* (v|version )3 )",
    "isc": " permission to use copy modify ",
    "mit": " mit license ",
    "mit-grant": " hereby granted free of charge ",
    "mpl-2.0": "(?s)(?=.* mozilla public license )(?=.* v?2 0 )",
}


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORDS), F.lit(0))


def template_sets(templates: dict[str, str] | None = None) -> dict[str, list[str]]:
    return {label: sorted(set(text.split())) for label, text in (templates or TEMPLATES).items()}


def _strings(items) -> Column:
    return F.array(*[F.lit(x) for x in items]) if items else F.array().cast("array<string>")


def word_order(texts: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' words, those in fewest documents first (a row per template word comes to the driver)."""
    held = texts.select(F.explode(F.array_intersect(F.array_distinct("words"), _strings(vocabulary))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_matches(texts: DataFrame, templates: dict[str, str] | None = None,
                     containment: float = CONTAINMENT, telling: dict[str, str] | None = None,
                     block_end: str = BLOCK_END) -> DataFrame:
    """(id, print, block, label, containment) of every block of ``texts`` (id, print, text) that matches a template.

    ``telling``: patterns that a block's words must match for a label besides.
    """
    spark = texts.sparkSession
    sets = template_sets(templates)
    vocabulary = sorted(set().union(*sets.values()))
    order = word_order(texts.select(words_of(F.col("text")).alias("words")), vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for label, words in sets.items():
        ranks = sorted(rank[w] for w in words)
        need = max(1, math.ceil(containment * len(ranks) - 1e-9))
        rows += [(r, i, label, need, ranks) for i, r in enumerate(ranks[: len(ranks) - need + 1])]
    prefixes = spark.createDataFrame(rows, "rank int, at_t int, label string, need int, ranks array<int>")
    least = min(r[3] for r in rows)
    prefix_words = sorted({order[r[0]] for r in rows})

    held = texts.withColumn("all_words", words_of(F.col("text"))).filter(
        F.arrays_overlap("all_words", _strings(prefix_words)))
    blocks = held.select("id", "print", F.posexplode(F.split("text", block_end)).alias("block", "part"))
    carried = ["part"] if telling else []
    blocks = blocks.withColumn("held", F.array_intersect(F.array_distinct(words_of(F.col("part"))), _strings(order)))
    blocks = blocks.filter(F.size("held") >= least).select(
        "id", "print", "block", *carried,
        F.sort_array(F.transform("held", lambda w: (F.array_position(_strings(order), w) - 1).cast("int"))).alias("own"))
    size = F.size("own")
    probes = blocks.select("*", F.posexplode(F.slice("own", 1, size - least + 1)).alias("at_b", "rank"))
    pairs = probes.join(F.broadcast(prefixes), "rank").filter(
        (size >= F.col("need")) & (F.col("at_b") <= size - F.col("need"))
        & (F.least(size - F.col("at_b"), F.size("ranks") - F.col("at_t")) >= F.col("need")))
    common = F.size(F.array_intersect("own", "ranks"))
    pairs = pairs.filter(common >= F.col("need"))
    if telling:
        joined = F.concat(F.lit(" "), F.array_join(words_of(F.col("part")), " "), F.lit(" "))
        asked = F.create_map(*[F.lit(x) for pair in telling.items() for x in pair])
        pattern = F.coalesce(F.try_element_at(asked, F.col("label")), F.lit(""))
        pairs = pairs.filter(F.regexp_like(joined, pattern))
    return (pairs
            .select("id", "print", "block", "label", (common / F.size("ranks")).alias("containment")).distinct())


def phrase_places(words: Column, joined: Column, phrase: str) -> Column:
    """Numbers of the words at which a phrase's words stand; ``joined``: the words between single blanks."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        ok = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            ok = ok & (F.get(words, i + k) == part)
        return ok

    found = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


def notices(docs: DataFrame) -> DataFrame:
    """:func:`scan` for the licences that a text names: what one template shares with another isn't enough."""
    return scan(docs, telling=TELLING, block_end=NOTICE_END)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT,
         telling: dict[str, str] | None = None, block_end: str = BLOCK_END) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    prepare(docs.sparkSession)
    text = text_of(docs)
    texts = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))
    matches = template_matches(texts, templates, containment, telling, block_end)
    found = written(matches.groupBy("id", "print").agg(F.collect_set("label").alias("more"),
                                                       F.max("containment").alias("score")), "licenses")
    base = texts.select("id", "print", words_of(F.col("text")).alias("words"))
    base = base.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    names = {phrase: f"_{i}" for i, phrase in enumerate(PHRASES)}
    base = base.select("id", "print", F.size("words").cast("long").alias("n_words"),
                       *[phrase_places(F.col("words"), F.col("joined"), p).alias(c) for p, c in names.items()])
    places = F.concat(*[F.col(c) for c in names.values()])
    labels = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(PHRASES[p])) for p, c in names.items()]))
    base = base.select("id", "print", "n_words", places.alias("places"), F.array_sort(labels).alias("base"))
    mine = found.select(F.col("id").alias("id_m"), F.col("print").alias("print_m"), "more", "score")
    out = base.join(mine, F.col("id").eqNullSafe(F.col("id_m")) & (F.col("print") == F.col("print_m")), "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return out.select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.greatest(F.coalesce("score", F.lit(0.0)), F.when(F.size("base") > 0, 1.0).otherwise(0.0)).alias("score"))
