"""License windows: real notices in hard places, brute force, and the SQL twin."""

import random
import re

import duckdb
import pytest

from dimwright.llm import licenses
from dimwright.llm.licenses import TEMPLATES
from dimwright.llm.oracle import license_dice

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:"""


def words_slowly(text):
    plain = re.sub(r"[^\w.]+|_|\.(?![^\W_])", " ", (text or "").lower())
    return [w for w in plain.split(" ") if w]


def scan_slowly(text, bar=0.75):
    """Every window of every length, then the rule of overlaps."""
    w = words_slowly(text)
    grams = [f"{a} {b}" for a, b in zip(w, w[1:])]
    best = []
    for rank, (name, notice) in enumerate(sorted(TEMPLATES.items())):
        own = set(licenses.template_bigrams(notice))
        for at in range(len(grams)):
            if grams[at] not in own:
                continue
            found = max(
                (2 * len(own & set(grams[at : at + m])) / (m + len(own)), -m) for m in range(1, len(grams) - at + 1)
            )
            if found[0] >= bar:
                best.append((found[0], len(own), -at, -rank, name, -found[1]))
    return {
        (1 - x[2], x[5] + 1, x[4], round(x[0], 6))
        for x in best
        if not any(y[:4] > x[:4] and -y[2] <= -x[2] + x[5] and -x[2] <= -y[2] + y[5] for y in best)
    }


def scanned(spark, texts):
    schema = "doc_id bigint, text string, line string, dice string, row string, hits string"
    rows = [(i, t, "l", "d", "r", "h") for i, t in enumerate(texts)]
    df = licenses.scan_licenses(spark.createDataFrame(rows, schema).repartition(3), "text")
    assert df.columns == ["doc_id", "line", "row", "hits", "first_word", "n_words", "license", "dice"]
    got = {}
    for r in df.collect():
        assert (r.line, r.row, r.hits) == ("l", "r", "h")
        got.setdefault(r.doc_id, []).append((r.first_word, r.n_words, r.license, round(r.dice, 6)))
    assert all(len(v) == len(set(v)) for v in got.values())
    return {i: set(v) for i, v in got.items()}


def mixed_texts():
    rng = random.Random(11)
    pool = [w for t in TEMPLATES.values() for w in t.split()]
    texts = []
    for _ in range(40):
        out = []
        for _ in range(rng.randrange(1, 4)):
            words = TEMPLATES[rng.choice(sorted(TEMPLATES))].split()
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(0, 3)] = rng.choices(pool, k=rng.randrange(0, 3))
            out += [*rng.choices(pool, k=rng.randrange(0, 6)), *words]
        texts.append(" ".join(out))
    return texts


HARD = [
    "intro\nReleased under the MIT License.", "Licensed under the Apache License, version 2.0", None, "", " \n ",
    MIT, BSD, f"{BSD}\n{MIT}", "so: Licensed under\nCC BY-SA\n4.0. And on.",
    "Copyright 2020 Me. Released under the MIT License. All rights reserved and more words follow here.",
    "Released under the MIT License. Released under the MIT License.", "a license to sing", "the mit", "..", "a..b license .x",
    "Licensed under CC BY 4.0.", "RELEASED   UNDER\tTHE MIT LICENSE", "word " * 30_000 + "Released under the MIT License",
]


def test_notices_in_hard_places(spark):
    got = scanned(spark, HARD)
    names = {i: sorted(x[2] for x in v) for i, v in got.items()}
    assert names == {
        0: ["MIT"], 1: ["Apache-2.0"], 5: ["MIT grant"], 6: ["BSD conditions"], 7: ["BSD conditions", "MIT grant"],
        8: ["CC-BY-SA-4.0"], 9: ["MIT"], 10: ["MIT", "MIT"], 15: ["CC-BY-4.0"], 16: ["MIT"], 17: ["MIT"],
    }
    assert got[17] == {(30_001, 5, "MIT", 1.0)}


def test_windows_equal_brute_force(spark):
    texts = [*mixed_texts(), *HARD[:-1]]
    want = {i: found for i, t in enumerate(texts) if (found := scan_slowly(t))}
    assert len(want) > 40 and scanned(spark, texts) == want


def test_sql_twin_gives_the_same_rows(spark):
    texts = [*mixed_texts(), *HARD]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    rows = db.execute(license_dice()).fetchall()
    want = {}
    for i, *rest in rows:
        want.setdefault(i, set()).add(tuple(rest))
    assert scanned(spark, texts) == want


@pytest.mark.parametrize("bar", [0.5, 0.75, 0.9])
def test_bounds_are_exact(bar):
    for n in range(2, 60):
        best = {m: max(2 * s / (m + n) for s in range(min(m, n) + 1)) for m in range(1, 200)}
        low, high = licenses.window_bounds(n, bar)
        assert [m for m, d in best.items() if d >= bar - 1e-12] == [m for m in best if low <= m <= high]
        least = licenses.least_shared(n, bar)
        assert all(2 * s / (m + n) < bar for m in range(1, 200) for s in range(min(least, m + 1)))


def test_no_rows_no_licenses(spark):
    assert scanned(spark, []) == {}
