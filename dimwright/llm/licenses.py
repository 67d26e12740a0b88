"""License scan: windows of a text against license templates by Dice over word bigrams.

A text is normalised as a whole (lower case; runs of other characters than
letters, digits and dots, line breaks among them, become one blank), so a notice
is found wherever it stands: alone on a line, wrapped over several, or inside a
longer one. A window is a run of bigrams of the text; with the ``n`` bigrams of a
template its Dice is ``2 * shared / (m + n)``, ``m`` bigrams in the window and
``shared`` different ones of the template in it. Dice is at most
``2 min(m, n) / (m + n)``, so only windows of a length within the bounds that
follow from the bar are compared. Windows begin and end with a bigram of the
template; no other window can be better. Of each beginning the best window
stands, of equal ones the shortest; of overlapping windows that reach the bar one
stands unless an overlapping one is better (by Dice, the longer template, the
earlier begin, the template's place in the list).

Two exact bounds drop most texts early. A window that reaches the bar shares
``bar * n / (2 - bar)`` bigrams at least, so of any other ``n`` less that many
plus one it holds one: a text without a word of those is dropped by one regular
expression. And a template is compared only where enough of its bigrams occur.
The templates are a fixed short list, kept as literals, so there is no join and
no shuffle. Everything is built-in expressions, arrays bounded by one text.

Defined results: a NULL or empty text has no license; repeated rows are scanned
each for itself; an empty table gives no rows. Columns of the input other than
the text are kept in ``scan_licenses``; one that has the name of a result is
replaced by it.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices by which public licenses are named, and the grants or headers
# that stand in their full texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "This work is licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "This work is licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at",
    "BSD conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "BSD-3-Clause endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written permission.",
    "GPL-2.0 header": "This program is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or "
    "(at your option) any later version.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version.",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software",
    "Unlicense grant": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software",
}


def normal_words(text: Column) -> Column:
    """Words of a text in the form compared; a dot counts inside a word only."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?![\p{L}\p{N}])", " ")
    return F.split(F.trim(plain), " +")


def template_bigrams(notice: str) -> list[str]:
    """The same normalisation for a template, which is plain ASCII."""
    words = re.sub(r"[^a-z0-9.]+|\.(?![a-z0-9])", " ", notice.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def least_shared(n: int, bar: float) -> int:
    """Bigrams of a template of ``n`` that a window at the bar shares at least."""
    return math.ceil(bar * n / (2 - bar) - 1e-9)


def window_bounds(n: int, bar: float) -> tuple[int, int]:
    """Shortest and longest window, in bigrams, that can reach the bar."""
    return math.ceil(n * bar / (2 - bar) - 1e-9), math.floor(n * (2 - bar) / bar + 1e-9)


def anchors(sets: list[list[str]], bar: float) -> list[str]:
    """Words of which each window at the bar holds one: the longer word of each of
    so many bigrams of a template that no such window can do without all of them."""
    found = set()
    for grams in sets:
        longer = sorted((max(g.split(), key=len) for g in grams), key=lambda w: (-len(w), w))
        found.update(longer[: len(grams) - least_shared(len(grams), bar) + 1])
    return sorted(found)


def _own_windows(own: Column, rank: int, name: str, n: int, bar: float) -> Column:
    """The best window of every beginning for one template of ``n`` bigrams, from
    the places (at, gram) of its bigrams in order."""
    shortest, longest = window_bounds(n, bar)
    none = F.struct(F.lit(0.0).alias("dice"), F.lit(0).alias("m"), F.array().cast("array<string>").alias("seen"))

    def best_from(first: Column, reach: Column) -> Column:
        def step(state: Column, hit: Column) -> Column:
            m = hit["at"] - first["at"] + 1
            new = (m <= longest) & ~F.array_contains(state["seen"], hit["gram"])
            dice = F.when(m >= shortest, 2.0 * (F.size(state["seen"]) + 1) / (m + n)).otherwise(0.0)
            better = dice > state["dice"]
            grown = F.struct(
                F.when(better, dice).otherwise(state["dice"]).alias("dice"),
                F.when(better, m).otherwise(state["m"]).alias("m"),
                F.concat(state["seen"], F.array(hit["gram"])).alias("seen"),
            )
            return F.when(new, grown).otherwise(state)

        def window(best: Column) -> Column:
            return F.struct(
                best["dice"].alias("dice"), F.lit(n).alias("n"), first["at"].alias("at"), best["m"].alias("m"),
                F.lit(rank).alias("rank"), F.lit(name).alias("license"),
            )

        return F.aggregate(reach, none, step, window)

    # hits lie at different places, so no more than ``longest`` of them are in reach
    every = F.transform(own, lambda first, k: best_from(first, F.slice(own, k + 1, F.lit(longest))))
    return F.filter(every, lambda w: w["dice"] >= bar)


def _compared(hits: Column, rank: int, name: str, grams: list[str], bar: float) -> Column:
    """Windows of one template, if enough of its bigrams occur."""
    own = F.filter(hits, lambda h: h["gram"].isin(grams))
    enough = F.filter(F.array(own), lambda o: F.size(o) >= least_shared(len(grams), bar))
    return F.flatten(F.transform(enough, lambda o: _own_windows(o, rank, name, len(grams), bar)))


def _stands(window: Column, windows: Column) -> Column:
    """No overlapping window is better."""

    def order(w: Column) -> Column:
        return F.struct(w["dice"], w["n"], -w["at"], -w["rank"])

    return ~F.exists(
        windows,
        lambda w: (w["at"] <= window["at"] + window["m"])
        & (window["at"] <= w["at"] + w["m"])
        & (order(w) > order(window)),
    )


def scan_licenses(
    docs: DataFrame, text: str, templates: dict[str, str] = TEMPLATES, bar: float = 0.75
) -> DataFrame:
    """One row per window that names a license: the input's columns but the text,
    ``first_word`` (from 1), ``n_words``, ``license`` (the template) and ``dice``."""
    sets = {name: template_bigrams(notice) for name, notice in sorted(templates.items())}
    every = sorted({g for grams in sets.values() for g in grams})
    least = min(least_shared(len(grams), bar) for grams in sets.values())
    made = {"first_word", "n_words", "license", "dice"}
    kept = [c for c in docs.columns if c != text and c.lower() not in made]
    # columns go by their place, so that none of them can meet one made here
    carried = [f"c{i}" for i in range(len(kept))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(kept, carried)), F.col(text).alias("body"))
    worth = rows.filter(F.lower("body").rlike("|".join(map(re.escape, anchors(list(sets.values()), bar)))))

    def once(df: DataFrame, value: Column, name: str, keep) -> DataFrame:
        """An array that is worked out once a row, for the rows where it will do."""
        return df.select(*carried, F.explode(F.filter(F.array(value), keep)).alias(name))

    words = once(worth, normal_words(F.col("body")), "words", lambda w: F.size(w) > least)
    bigrams = F.zip_with(
        "words", F.slice("words", F.lit(2), F.size("words") - 1), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    # the last word has no partner: its NULL is in no template
    placed = F.transform(bigrams, lambda g, i: F.struct(i.alias("at"), g.alias("gram")))
    hits = once(words, F.filter(placed, lambda h: h["gram"].isin(every)), "hits", lambda h: F.size(h) >= least)
    found = [_compared(F.col("hits"), rank, *entry, bar) for rank, entry in enumerate(sets.items())]
    windows = once(hits, F.concat(*found), "windows", lambda w: F.size(w) > 0)
    standing = windows.select(
        *carried, F.explode(F.filter("windows", lambda w: _stands(w, F.col("windows")))).alias("w")
    )
    return standing.select(
        *(F.col(n).alias(c) for c, n in zip(kept, carried)),
        (F.col("w.at") + 1).cast("long").alias("first_word"),
        (F.col("w.m") + 1).cast("long").alias("n_words"),
        "w.license",
        "w.dice",
    )
