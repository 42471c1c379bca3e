"""License scan by diagonal voting, in DataFrame functions alone.

Texts are taken as words. Every run of K words is hashed and joined with the runs of the license
templates; a match votes for its diagonal (place in the text minus place in the
template). Votes are counted per text, template and diagonal; neighbouring diagonals,
as words inserted or left out make them, are merged to one span. Votes only propose:
one is enough. A span counts if it is verified: its words, from where the template
would begin to where it would end, hold `MIN_SHARE` of the template's distinct words,
and `MIN_OWN` of those that no template of another label has.

Phrases with a fixed label ("base" labels) are looked for word by word beside that.

Only texts with a word that the templates' runs and the phrases need can match,
and only their words are spread into rows: every run that is looked up holds a word outside
`COMMON`, so the test by words loses nothing. Templates are parameters of a bounded size (`MAX_TEMPLATE_WORDS`), so
their runs can be broadcast.

Defined cases: NULL and empty texts have no words, no label and score 0. Every input row
gives a row, also with equal ids. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from keelstone.llm.shared import stage

K = 4
MERGE = 3  # diagonals this close belong together
MIN_SHARE = 0.6  # of a template's words
MIN_OWN = 0.5  # of the words that tell its label from others
MAX_TEMPLATE_WORDS = 20_000

PHRASES: dict[str, str] = {
    "cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved",
}

#: Telling passages of well-known licenses, by label; `label/part` gives a label several.
TEMPLATES: dict[str, str] = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files"
    ),
    "mit/warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY"
    ),
    "mit/line": "Released under the MIT License",
    "mit/line-2": "Licensed under the MIT License",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License"
    ),
    "apache-2.0/line": "Licensed under the Apache License, Version 2.0",
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "bsd/line": "Use of this source code is governed by a BSD-style license",
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"
    ),
    "gpl/line": "licensed under the GNU General Public License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted"
    ),
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"
    ),
    "cc-by-sa/line": "Licensed under CC BY-SA 4.0",
    "cc0": (
        "To the extent possible under law, the person who associated CC0 with this work has waived "
        "all copyright and related or neighboring rights to this work"
    ),
    "unlicense": "This is free and unencumbered software released into the public domain",
    "bsd/name": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission"
    ),
    "bsd/notice": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer"
    ),
    "lgpl": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation"
    ),
    "agpl": (
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation"
    ),
    "mit/spdx": "SPDX-License-Identifier: MIT",
    "apache-2.0/spdx": "SPDX-License-Identifier: Apache-2.0",
    "gpl/spdx": "SPDX-License-Identifier: GPL-3.0-or-later",
    "bsd/spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "mpl-2.0/spdx": "SPDX-License-Identifier: MPL-2.0",
    "reserved": (
        "No part of this publication may be reproduced, distributed, or transmitted in any form or "
        "by any means without the prior written permission of the publisher"
    ),
}

#: Words that do not make a text worth a look. A run of common words alone is not looked up.
COMMON = frozenset(
    "a all an and any are as at be but by can copy extent files following for forms form free "
    "from has have in is it kind law may means met no not of on or part person possible public "
    "purpose related source terms that the this to under use used who with without work you "
    "0 2 4 v".split()
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(BETWEEN, text.lower()) if w]


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased and all other letters as they are.

    `lower` is much faster than `translate`, and letters beyond ASCII that it changes stay
    beyond ASCII, save two, which it would turn into i and k.
    """
    text = F.coalesce(text, F.lit(""))
    odd = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212A"))
    low = F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(low, BETWEEN), "")


def _check(templates: Mapping[str, str]) -> None:
    if sum(len(template_words(t)) for t in templates.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"more than {MAX_TEMPLATE_WORDS} template words")


def _label(template: str) -> str:
    return template.split("/")[0]


def _runs(spark, templates: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """(gram, template, t_at, t_words, t_own) of all runs, and the words that every run needs one of."""
    words_of_label: dict[str, set[str]] = {}
    for name, text in templates.items():
        words_of_label.setdefault(_label(name), set()).update(template_words(text))
    rows, needed = [], set()
    for name, text in templates.items():
        words = template_words(text)
        others = set().union(*(w for label, w in words_of_label.items() if label != _label(name)))
        runs = [
            (i, words[i : i + K]) for i in range(len(words) - K + 1)
            if set(words[i : i + K]) - COMMON
        ]
        for i, run in runs:
            needed.update(set(run) - COMMON)
            rows.append((*run, name, i, words, sorted(set(words) - others)))
    names = [f"w{i}" for i in range(K)]
    schema = ", ".join(f"{n} string" for n in names)
    schema += ", template string, t_at int, t_words array<string>, t_own array<string>"
    return (
        spark.createDataFrame(rows, schema)
        .select(F.xxhash64(*names).alias("gram"), "template", "t_at", "t_words", "t_own"),
        sorted(needed),
    )


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, phrases: Mapping[str, str] = PHRASES
) -> DataFrame:
    """One row per document: words, base places and labels, all labels, score and the best span."""
    _check(templates)
    spark = docs.sparkSession
    runs, needed = _runs(spark, templates)
    by_phrase = {p: p.split(" ") for p in phrases}
    # A phrase needs all its words, so its rarest one will do: the longest.
    wanted = sorted({*needed, *(max(p, key=len) for p in by_phrase.values())})
    words = words_of(F.col("text"))
    # Written once: the words of the few texts worth a look, and the number of words of all.
    rows = stage(
        docs.select("doc_id", words.alias("words"))
        .select(
            "doc_id", F.size("words").cast("bigint").alias("n_words"),
            F.when(
                F.arrays_overlap("words", F.array(*[F.lit(w) for w in wanted])), F.col("words")
            ).alias("words"),
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "license_words",
    )
    looked = rows.where("words is not null").select("row", "words", F.size("words").alias("n"))

    at = lambda i: F.get(F.col("words"), i)

    def starts(words_: list[str]):
        return lambda i: _all([at(i + j) == w for j, w in enumerate(words_)])

    def labelled(label: str):
        return lambda i: F.struct(i.alias("at"), F.lit(label).alias("label"))

    places = [
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("n") - 1), starts(p)), labelled(phrases[text])
        )
        for text, p in by_phrase.items()
    ]
    base = (
        looked.select("row", F.concat(*places).alias("found")).where(F.size("found") > 0)
        .select(
            "row", F.size("found").cast("bigint").alias("n_base"),
            F.array_min("found.at").cast("bigint").alias("first_word"),
            F.array_max("found.at").cast("bigint").alias("last_word"),
            F.array_distinct("found.label").alias("base"),
        )
    )

    # All runs of words of these texts against the runs of the templates.
    grams = looked.where(F.col("n") >= K).select(
        "row",
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.col("n") - K), lambda i: F.xxhash64(*[at(i + j) for j in range(K)])
        )).alias("at", "gram"),
    )
    votes = (
        grams.join(F.broadcast(runs.select("gram", "template", "t_at")), "gram")
        .groupBy("row", "template", (F.col("at") - F.col("t_at")).alias("diagonal"))
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    spans = (
        votes.withColumn("new", F.coalesce(
            (F.col("diagonal") - F.lag("diagonal").over(along) > MERGE).cast("int"), F.lit(1)
        ))
        .withColumn("span", F.sum("new").over(along))
        .groupBy("row", "template", "span")
        .agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("from"),
            F.max("diagonal").alias("to"),
        )
    )
    facts = runs.groupBy("template").agg(F.first("t_words").alias("t_words"), F.first("t_own").alias("t_own"))
    # Where the template lies in the text, by the diagonals that its runs voted for.
    begin = F.greatest(F.col("from"), F.lit(0))
    inside = F.slice(F.col("words"), begin + 1, F.col("to") + F.size("t_words") - begin)

    def held(words_: str) -> Column:
        return F.size(F.array_intersect(inside, words_)) / F.greatest(F.size(F.array_distinct(words_)), F.lit(1))

    verified = (
        spans.join(F.broadcast(facts), "template").join(looked.select("row", "words"), "row")
        .where((F.size("t_own") == 0) | (held("t_own") >= MIN_OWN))
        .select("row", "template", held("t_words").alias("share"), "first", (F.col("last") + K - 1).alias("last"))
        .where(F.col("share") >= MIN_SHARE)
        .groupBy("row")
        .agg(
            F.collect_set(F.substring_index("template", "/", 1)).alias("found"), F.max("share").alias("share"),
            F.max_by(F.struct("template", "first", "last"), F.struct("share", "template")).alias("best"),
        )
    )
    none = F.array().cast("array<string>")
    base_labels, found = F.coalesce("base", none), F.coalesce("found", none)
    return (
        rows.drop("words").join(base, "row", "left").join(verified, "row", "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
            "first_word", "last_word",
            F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union(base_labels, found)), ",").alias("labels"),
            # A base phrase alone says less than a verified passage.
            F.greatest(
                F.coalesce("share", F.lit(0.0)), F.when(F.size(base_labels) > 0, 0.5).otherwise(0.0)
            ).alias("score"),
            F.col("best.template").alias("template"), F.col("best.first").alias("span_first"),
            F.col("best.last").alias("span_last"),
        )
    )


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
