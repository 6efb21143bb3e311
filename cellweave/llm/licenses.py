"""License scans as an exact set-similarity join of text blocks and licence templates.

A text's words are cut into overlapping blocks; a block meets a template when it holds at least the
template's threshold share of the template's distinct words. Words are ordered by their frequency over
the whole corpus, rare ones first; a template's prefix is the shortest run of its rarest words of which
any block that meets it must hold one. Blocks without a prefix word are never built. Blocks and prefixes
are equi-joined on the word's rank; length and positional filters and then the full overlap decide.
Templates whose threshold is 1 and whose words must stand in order (phrases) are confirmed place by place.

Everything is DataFrame code. Only the templates (a constant) are broadcast, and their words' counts
(bounded by the templates) come to the driver.

Defined cases: a null text counts as empty (no words, null first and last word, empty labels, score 0);
blocks have a fixed number of words, so a very long text gives many blocks; the longest template sets it where it has more
words than a stride, so whole licence texts can be templates; ties don't arise, as labels are sets and the score is a maximum; repeated rows are judged each
by itself; other columns stay out of the result; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Fixed value: what stands between words once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A block is two strides long, so that anything of up to a stride stands whole in some block. Longer templates widen it.
STRIDE = 64


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(BETWEEN, "".join(c.lower() if "A" <= c <= "Z" else c for c in self.text)) if w]


PHRASES = [
    Template("mit", "under the mit license", 1.0, True),
    Template("apache-2", "apache license version 2", 1.0, True),
    Template("cc-by-nc", "cc by nc", 1.0, True),
]
#: Sentences by which licences are declared.
TEMPLATES = [
    *PHRASES,
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2", "licensed under the apache license version 2.0 you may not use this file except in compliance with the license"),
    Template("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    Template("proprietary", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form without the prior written permission of the publisher"),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def frequencies(docs: DataFrame, vocabulary: Sequence[str], text: str = "text") -> dict[str, int]:
    """How often each word of the templates stands in the whole corpus; partial sums before the shuffle."""
    found = docs.select(F.explode(F.filter(words_of(F.col(text)), lambda w: w.isin(*vocabulary))).alias("w")).groupBy("w").count()
    return dict.fromkeys(vocabulary, 0) | {r["w"]: r["count"] for r in found.collect()}


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, key: str = "doc_id", text: str = "text", stride: int = STRIDE) -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels and score of each row."""
    stride = max([stride, *(len(t.words) for t in templates)])
    vocabulary = sorted({w for t in templates for w in t.words})
    often = frequencies(docs, vocabulary, text)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (often[w], w)))}
    index, prefix_words = [], set()
    for n, t in enumerate(templates):
        ordered = sorted({rank[w] for w in t.words})
        need = ceil(t.threshold * len(ordered) - 1e-9)
        for j, r in enumerate(ordered[: len(ordered) - need + 1]):
            index.append(f"({r}, {n}, {j}, {need})")
            prefix_words.add(next(w for w in rank if rank[w] == r))
    spark = docs.sparkSession
    array = lambda xs: "array(" + ", ".join(xs) + ")"
    quote = lambda s: "'" + s.replace("'", "\\'") + "'"
    held = ", ".join(f"({n}, {quote(t.label)}, {str(t.phrase).lower()}, {array([str(r) for r in sorted({rank[w] for w in t.words})])}, {array([quote(w) for w in t.words])})" for n, t in enumerate(templates))
    prefixes = spark.sql(f"SELECT * FROM VALUES {', '.join(index)} AS p(_rank, _t, _j, _need)").join(spark.sql(f"SELECT * FROM VALUES {held} AS h(_t, _label, _phrase, _ranks, _phrase_words)"), "_t")

    rows = docs.select(F.col(key), words_of(F.col(text)).alias("_words")).withColumn("_row", F.monotonically_increasing_id())
    at = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(*sorted(prefix_words)), i)), lambda i: i.isNotNull())
    own = lambda i: F.floor(i / stride).cast("int")
    rows = rows.withColumn("_at", at)
    hit = F.array_distinct(F.flatten(F.transform("_at", lambda i: F.array(own(i), F.greatest(own(i) - 1, F.lit(0))))))
    rows = rows.select("_row", key, F.size("_words").cast("long").alias("n_words"), F.explode_outer(F.transform(hit, lambda b: F.struct(b.alias("b"), F.slice("_words", b * stride + 1, F.lit(2 * stride)).alias("words")))).alias("_block"))
    ranks = F.create_map(*[F.lit(x) for w, r in rank.items() for x in (w, r)])
    known = F.filter(F.col("_block.words"), lambda w: w.isin(*vocabulary))
    rows = rows.withColumn("_known", F.array_sort(F.transform(F.array_distinct(known), lambda w: F.element_at(ranks, w))))
    rows = rows.select("*", F.posexplode_outer("_known").alias("_i", "_rank"))
    met = rows.join(F.broadcast(prefixes), "_rank", "left")
    could = (F.size("_known") >= F.col("_need")) & (1 + F.least(F.size("_known") - F.col("_i"), F.size("_ranks") - F.col("_j")) - 1 >= F.col("_need"))
    overlap = F.when(could, F.size(F.array_intersect("_known", "_ranks")))
    share = F.when(overlap >= F.col("_need"), overlap / F.size("_ranks"))
    met = met.withColumn("_share", share)
    # a phrase's places count in the block in whose first stride they start, and once, from its rarest word
    places = F.filter(F.sequence(F.lit(0), F.lit(stride - 1)), lambda k: F.slice(F.col("_block.words"), k + 1, F.size("_phrase_words")) == F.col("_phrase_words"))
    met = met.withColumn("_starts", F.when(F.col("_phrase") & F.col("_share").isNotNull(), F.transform(places, lambda k: (k + F.col("_block.b") * stride).cast("long"))))
    based = F.size("_starts") > 0
    met = met.select(
        "_row", key, "n_words", F.when(based, F.size("_starts")).alias("_n"), F.when(based, F.array_min("_starts")).alias("_first"), F.when(based, F.array_max("_starts")).alias("_last"),
        F.when(based, F.col("_label")).alias("_base"), F.when(based | (~F.col("_phrase") & F.col("_share").isNotNull()), F.col("_label")).alias("_label"), F.when(based | ~F.col("_phrase"), F.col("_share")).alias("_share"),
    )
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return met.groupBy("_row", key, "n_words").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_base"), F.min("_first").alias("first_word"), F.max("_last").alias("last_word"),
        joined("_base").alias("base_labels"), joined("_label").alias("labels"), F.coalesce(F.max("_share"), F.lit(0.0)).cast("double").alias("score"),
    ).drop("_row")
