"""Collocations, vector search and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimwright.llm import collocations, importance, vector_search
from dimwright.llm.oracle import llm_oracles
from dimwright.llm.queries import llm_queries

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def texts():
    draw = random.Random(7)
    vocabulary = ["the", "of", "new", "york", "city", "été", "ß", "x\x00y", "𝒳", "a-b", "don't"]
    out = [
        (" ".join(draw.choices(vocabulary, k=draw.randint(0, 60))) + draw.choice([".", "!\n", "\t", " , "])) * 2
        for _ in range(60)
    ]
    out += ["New York\tCity", "new york, city", "", None, "...", "  ", "NEW YORK City " * 400, "É" * 3, "new\x0byork\x0ccity"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", "fr", None, "und"]
    data = [(i, t, langs[i % 4], "kept") for i, t in enumerate(texts())]
    data += data[:7]  # repeated rows
    schema = "doc_id bigint, text string, lang string, phrase string"  # a clashing name
    return spark.createDataFrame(data, schema).repartition(3)


def brute_collocations(rows, least, max_words, covered, top):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    found = {}
    cands = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    for (lang, p), a in cands.items():
        cuts = [(1000000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        inside = any(
            lang == lang2 and len(q) > len(p) and 100 * b >= covered * a
            and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (lang2, q), b in cands.items()
        )
        if not inside:
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
        for lang, rows in found.items()
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])
    )


@pytest.mark.parametrize("max_words,entries,burst", [(3, 10**6, 4096), (3, 40, 3), (4, 100, 5), (2, 10**6, 2)])
def test_collocations_equal_brute_force(docs, max_words, entries, burst):
    got = collocations.collocations(docs, least=4, max_words=max_words, top=25, entries=entries, burst=burst)
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 4, max_words, 50, 25)


def test_scores_stay_exact_beyond_64_bits(spark):
    big = 3_000_000_019
    rows = [("en", "a b", big), ("en", "a", big + 2), ("en", "b", big + 5)]
    got = collocations.score_phrases(spark.createDataFrame(rows, "lang string, phrase string, n long")).first()
    assert got["score"] == 1_000_000 * big * big // ((big + 2) * (big + 5))


def test_trie_bursts_and_gives_up_whole_subtrees():
    trie = collocations.HatTrie(burst=2)
    paths = [(1,), (1, 2), (1, 2, 3), (1, 2, 4), (1, 3, 2), (1, 4, 4), (5, 1)]
    for path in paths * 3:
        rest = 0
        for w in reversed(path[1:]):
            rest = rest << 32 | w
        trie.add(path[0], [rest], [1])
    assert trie.children[1].children is not None and trie.children[5].children is None
    assert trie.size == 7 and trie.largest(keep=1) == [1]
    assert sorted(trie.cut(1)) == [(p, 3) for p in paths[:6]]
    assert trie.size == 1 and sorted(trie.cut(5)) == [((5, 1), 3)]


def brute_features(text, n):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)], len(w)


def brute_resample(docs, target, n, buckets, least, percent):
    def hit(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(hit(f) for _, t in docs for f in brute_features(t, n)[0])
    t = Counter(hit(f) for x in target for f in brute_features(x, n)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for key, text in docs:
        features, words = brute_features(text, n)
        weight = sum(gain[hit(f)] for f in features)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(features), weight, score, words))
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0], r[2], r[1]))
    drawn = fit[: len(fit) * percent // 100]
    out = [(*r[:4], i + 1) for i, r in enumerate(drawn)]
    left = Counter(rows) - Counter(drawn)
    return sorted(out + [(*r[:4], None) for r in left.elements()], key=str)


@pytest.mark.parametrize("n,buckets", [(1, 10000), (3, 64)])
def test_resampling_equals_brute_force(spark, docs, n, buckets):
    more = spark.createDataFrame([(None, "new york city of the été new york", "en", "k")], docs.schema)
    some = docs.unionByName(more)
    target = spark.createDataFrame([("the city of New York",), (None,), ("ÉTÉ été 7",)], "text string")
    got = importance.resample(some, target, n=n, buckets=buckets, least_words=5, percent=30)
    rows = [(r["doc_id"], r["text"]) for r in some.collect()]
    want = brute_resample(rows, ["the city of New York", "", "ÉTÉ été 7"], n, buckets, 5, 30)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sum(r[-1] is not None for r in want) > 10


def test_no_run_of_words_crosses_two_texts():
    found = importance.batch_features(["a b", "", None, "c", "d e f"], n=3, buckets=1 << 32)
    names = ["a", "b", "c", "d", "e", "f", "a b", "d e", "e f", "d e f"]
    assert found.bucket.tolist() == [zlib.crc32(x.encode()) for x in names]
    assert found.text.tolist() == [0, 0, 3, 4, 4, 4, 0, 4, 4, 4]
    assert found.n_words.tolist() == [2, 0, 0, 1, 3]


def vectors(spark, extra=()):
    draw = np.random.default_rng(5)
    data = [(i, [float(x) for x in draw.normal(size=24)], 1.5) for i in range(400)]
    data += [(1000 + i, data[i % 3][1], 0.0) for i in range(40)]  # ties
    data += [(100, data[7][1], 0.0), (None, data[0][1], 0.0)]  # a repeated id, no id
    data += [(600, None, 0.0), (601, [1.0, None], 0.0), (602, [float("nan")] * 24, 0.0), (700, [float("inf")], 0.0)]
    data += [(800, [], 0.0), (801, [3.0], 0.0), *extra]
    return spark.createDataFrame(data, "vec_id bigint, embedding array<double>, score double").repartition(3)


def brute_top_k(rows, k):
    usable = [
        (i, key, [math.floor(1024 * x) for x in v])
        for i, (key, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, key, q in usable:
        if key is None or key % 100:
            continue
        scored = [
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), other is None, other or 0, other)
            for j, other, v in usable
            if j != i
        ]
        out += [(key, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("group_rows,group_bytes", [(2048, 32 << 20), (16, 4096)])
def test_top_k_equals_brute_force(spark, monkeypatch, group_rows, group_bytes):
    monkeypatch.setattr(vector_search, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(vector_search, "GROUP_BYTES", group_bytes)
    # values beyond what doubles add exactly
    df = vectors(spark, [(900, [1e15, -3.0, 1e14], 0.0), (901, [1e17, 7.0], 0.0)])
    got = vector_search.top_k(df, F.col("id") % 100 == 0, k=10)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute_top_k(rows, 10)


def test_search_drops_candidates_before_all_dimensions_are_read():
    draw = np.random.default_rng(3)
    centre = draw.normal(size=(20, 64))
    data = np.floor(200 * (centre[np.arange(4000) % 20] + 0.1 * draw.normal(size=(4000, 64))))
    table = vector_search.Vertical.of(data, np.arange(4000), np.arange(4000))
    at, scores = table.best(data[40], 40, 10)
    every = data @ data[40]
    every[40] = -np.inf
    want = sorted(range(4000), key=lambda i: (-every[i], i))[:10]
    assert at.tolist() == want and scores.tolist() == every[want].tolist()
    assert table.work < data.size / 2


def test_empty_tables_give_no_rows(spark, docs):
    none = docs.limit(0)
    assert collocations.collocations(none).count() == 0
    assert importance.resample(none, none).count() == 0
    # an empty target leaves the smoothing
    assert importance.resample(docs, none).count() == docs.count()
    assert vector_search.top_k(vectors(spark).limit(0), F.col("id") % 100 == 0).count() == 0
    assert vector_search.top_k(vectors(spark), F.lit(False)).count() == 0


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_its_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(llm_oracles()[name])
    got = llm_queries()[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns

    def table(rows, names):
        return sorted((tuple(repr(r[names.index(c)]) for c in columns) for r in rows))

    assert table(got.collect(), got.columns) == table(want.fetchall(), want.columns)
