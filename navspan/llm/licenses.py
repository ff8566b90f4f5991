"""License scans: MinHash bands over overlapping text windows retrieve templates, and exact shingle containment
verifies them.

A window is WINDOW neighbouring word pairs, and one starts at every STRIDE-th pair; its MinHash under each of BANDS masks
is a band of one row. Templates are few and known beforehand, and their windows start at every pair, so of a copied
passage's windows all inner ones agree wholly with one of the template's. Where a template is no longer than a window, the
two windows that share three of its four pairs with it have similarity 0.6, and both miss it in all bands about once in
two million places (10 of 20 million simulated ones, with random hashes). All of this happens within the row, and
nothing is shuffled.

A template of fewer than SHINGLE words is one run of words, and a text holds it where this run stands, at any place. It is
retrieved by its first pair, or its only word, among all of the text's, so none is missed.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspan.llm.native import let

WINDOW, STRIDE, BANDS, SHINGLE, PERCENT = 4, 2, 5, 5, 75
#: Windows of all templates, at most: they are constants of the plan.
MOST_WINDOWS = 5_000
#: The first three bits of each mask are its own, as the minima under masks that begin alike are often the same pair's.
LEADING = [0, 7, 3, 5, 1]
MASKS = [((LEADING[i] << 61) | random.Random(20240601 + i).getrandbits(61)) - (1 << 63) for i in range(BANDS)]

#: Notices by which well-known licenses ask to be named, and the short forms in use. Fixed values.
NOTICES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "LGPL": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "All-Rights-Reserved": ["All rights reserved."],
}


def words_of(text: Column) -> Column:
    """Runs of ASCII letters and digits, A-Z as a-z."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def inner(v: Column) -> Column:
        """Only the first and the last can be empty."""
        first = (F.get(v["words"], 0) == "").cast("int")
        last = ((F.size(v["words"]) > 1) & (F.get(v["words"], F.size(v["words"]) - 1) == "")).cast("int")
        return F.slice(v["words"], first + 1, F.size(v["words"]) - first - last)

    return let(inner, words=F.split(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), "[^a-z0-9]+"))


def all_shingles(words: Column) -> Column:
    """Runs of SHINGLE words, one from each word on that has as many behind it; a shorter text is one run, an empty one
    has none."""
    def runs(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(v["words"]) - SHINGLE + 1))
        return F.transform(starts, lambda i: F.array_join(F.slice(v["words"], i, F.lit(SHINGLE)), " "))

    return let(lambda v: F.when(F.size(v["words"]) > 0, runs(v)).otherwise(F.array().cast("array<string>")), words=words)


def shingles_from(words: Column, pairs: Column, first: list[int]) -> Column:
    """Runs of SHINGLE words whose first pair is one of `first`; a shorter text has none."""
    def runs(v: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(v["words"]) - SHINGLE), lambda i: F.get(v["pairs"], i).isin(first))
        return F.transform(starts, lambda i: F.array_join(F.slice(v["words"], i + 1, F.lit(SHINGLE)), " "))

    return let(lambda v: F.when(F.size(v["words"]) >= SHINGLE, runs(v)).otherwise(F.array().cast("array<string>")), words=words, pairs=pairs)


def pairs_of(words: Column) -> Column:
    """Hash of each word with the next one; that of a single word with nothing."""
    def hashed(v: Column) -> Column:
        return F.slice(F.transform(v["words"], lambda w, i: F.xxhash64(w, F.get(v["words"], i + 1))), 1, F.greatest(F.lit(1), F.size(v["words"]) - 1))

    return let(hashed, words=words)


def window_minima(pairs: Column) -> Column:
    """For each mask, the MinHash of every window of WINDOW pairs, one from each STRIDE-th pair on."""
    def of(v: Column) -> Column:
        def band(mask: int) -> Column:
            return F.transform(v["starts"], lambda i: F.least(*[F.get(v["pairs"], i + k).bitwiseXOR(F.lit(mask)) for k in range(WINDOW)]))

        return F.array(*[band(m) for m in MASKS])

    def starting(v: Column) -> Column:
        starts = F.when(F.size(v["pairs"]) > 0, F.sequence(F.lit(0), F.size(v["pairs"]) - 1, F.lit(STRIDE))).otherwise(F.array().cast("array<int>"))
        return let(of, pairs=v["pairs"], starts=starts)

    return let(starting, pairs=pairs)


def template_windows(templates: DataFrame) -> DataFrame:
    """(number, MinHashes by mask) of the windows of each template, one from every pair on."""
    rows = templates.withColumn("pairs", pairs_of(F.col("words")))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("pairs") - WINDOW + 1))
    windows = rows.select("number", F.explode(F.transform(starts, lambda i: F.slice("pairs", i, F.lit(WINDOW)))).alias("window"))
    return windows.select("number", F.transform(window_minima(F.col("window")), lambda band: band[0]).alias("minima"))


def scan(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, percent: int = PERCENT) -> DataFrame:
    """The templates that each row of docs (doc_id, text) holds: doc_id, license, template (its place in the license's
    list), matched and size (shingles found, and those of the template).

    Matches have 100 * matched >= percent * size, over the distinct shingles of five words of template and whole text; a
    template of fewer words is one shingle of all its words, sought among the text's runs of as many words. Null and empty texts match nothing, nor does a template without words. Rows that repeat are each scanned; an empty
    table gives no rows; other columns are ignored. At most MOST_WINDOWS windows of templates, else a ValueError.
    """
    spark = docs.sparkSession
    listed = [(n, name, place, text) for n, (name, place, text) in enumerate((name, i, text) for name, texts in notices.items() for i, text in enumerate(texts))]
    templates = spark.createDataFrame(listed, "number int, license string, template int, notice string").withColumn("words", words_of(F.col("notice"))).where(F.size("words") > 0)
    templates = templates.withColumn("shingles", F.array_distinct(all_shingles(F.col("words"))))
    long, short = templates.where(F.size("words") >= SHINGLE), templates.where(F.size("words") < SHINGLE)
    windows = [(r["number"], r["minima"]) for r in template_windows(long).collect()]
    # Of short templates: the number, the only word or none, the first pair or none.
    firsts = short.select("number", F.col("shingles")[0].alias("run"), F.when(F.size("words") == 1, F.col("words")[0]).alias("word"), F.when(F.size("words") > 1, pairs_of(F.col("words"))[0]).alias("pair")).collect()
    words, pairs = ({x["number"]: x[kind] for x in firsts if x[kind] is not None} for kind in ("word", "pair"))
    runs = {x["number"]: x["run"] for x in firsts}
    verified = long.select(pairs_of(F.col("words")).alias("pairs"), all_shingles(F.col("words")).alias("shingles")).collect()
    if len(windows) + len(firsts) > MOST_WINDOWS:
        raise ValueError(f"{len(windows) + len(firsts)} windows of templates; at most {MOST_WINDOWS}")

    def constants(j: int, number: int | None = None) -> Column:
        values = sorted({minima[j] for n, minima in windows if number in (None, n)})
        return F.array(*[F.lit(x) for x in values]).cast("array<bigint>")

    def among(values: Column, wanted: dict[int, object], kind: str) -> Column:
        """Those of wanted that are among the values."""
        constants = F.array(*[F.lit(x) for x in sorted(set(wanted.values()))]).cast(f"array<{kind}>")
        return F.array_intersect(values, constants) if wanted else constants

    def hits(v: Column) -> Column:
        def of(w: Column) -> Column:
            found = let(lambda x: F.array(*[F.array_intersect(x["minima"][j], constants(j)) for j in range(BANDS)]), minima=window_minima(w["pairs"]))
            return F.struct(v["words"].alias("words"), w["pairs"].alias("pairs"), found.alias("hits"), among(w["pairs"], pairs, "bigint").alias("short"), among(v["words"], words, "string").alias("single"))

        return let(of, pairs=pairs_of(v["words"]))

    # Rows without hits end here. An explode, as the planner would move a filter, and all of the work with it, down.
    hit = F.filter(F.array(let(hits, words=words_of(F.col("text")))), lambda h: F.exists(h["hits"], lambda x: F.size(x) > 0) | (F.size(h["short"]) > 0) | (F.size(h["single"]) > 0))
    rows = docs.select("doc_id", F.explode(hit).alias("hit")).select("doc_id", "hit.*")
    numbers = sorted({n for n, _ in windows})
    retrieved = [F.when(reduce(Column.__or__, [F.arrays_overlap(F.col("hits")[j], constants(j, n)) for j in range(BANDS)]), F.lit(n)) for n in numbers]
    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    for column, wanted in (("short", pairs), ("single", words)):
        retrieved += [F.when(F.array_contains(column, F.lit(x)) & F.contains(spaced, F.lit(f" {runs[n]} ")), F.lit(n)) for n, x in wanted.items()]
    # Verified against all templates at once: of a text only the distinct shingles that some template has go on.
    known = F.array(*[F.lit(x) for x in sorted({x for r in verified for x in r["shingles"]})]).cast("array<string>")
    found = F.array_intersect(shingles_from(F.col("words"), F.col("pairs"), sorted({r["pairs"][i] for r in verified for i in range(len(r["shingles"]))})), known)
    rows = rows.select("doc_id", found.alias("found"), F.explode(F.array_compact(F.array(F.lit(None).cast("int"), *retrieved))).alias("number"))
    # Broadcast: the templates are the few constants above.
    rows = rows.join(F.broadcast(templates.select("number", "license", "template", "shingles", (F.size("words") < SHINGLE).alias("short"))), "number")
    matched = F.when(F.col("short"), F.lit(1)).otherwise(F.size(F.array_intersect("found", "shingles")))
    rows = rows.select("doc_id", "license", "template", matched.alias("matched"), F.size("shingles").alias("size"))
    return rows.where(F.col("matched") * 100 >= F.col("size") * percent)
