"""The text operators against brute force on small tables, with hard cases."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimwright.llm import (
    common,
    decontaminate,
    interpolation,
    jaccard_join,
    language_id,
    pii,
    quality,
    sentencepiece,
    toxicity,
    url_filter,
)
from dimwright.llm.queries import URL_RULES, public_model

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    BASE,
    BASE,
    BASE.replace("word59", "other"),
    BASE.replace("word30", "middle"),
    BASE.upper(),
    "",
    None,
    "two words",
    "Two  words\n",
    "x" * 5000,
    " ".join(f"long{i % 997}" for i in range(20000)),
    "Call +1 (327) 555-3642 or mail a.b@c.example.com, 10.0.0.256 10.0.0.25 4111 1111 1111 1111",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "src0", "k") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, kept string").repartition(3)


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_jaccard_join_equals_brute_force(spark, docs):
    sets = [shingles(t) for t in TEXTS]
    root = list(range(len(TEXTS)))
    for _ in TEXTS:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0


def test_jaccard_signatures_never_part_near_sets(spark):
    """Sets of all sizes carry a signature; pairs far apart never get to their whole sets."""
    draw = np.random.default_rng(7)
    sets, pairs = [], []
    for size in (1, 5, 100, 448, 449, 900, 5000, 20000):
        base = draw.integers(0, 2**63, size).astype(np.uint64)
        for kept in (1.0, 0.9, 0.86, 0.3, 0.0):
            other = np.concatenate([base[: int(size * kept)], draw.integers(0, 2**63, size - int(size * kept)).astype(np.uint64)])
            pairs.append((len(sets), len(sets) + 1, size, size, jaccard_join._can_reach(size, size, int(size * kept))))
            sets += [base, other]
    sizes = np.array([len(x) for x in sets])
    signs = jaccard_join.signatures(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), sizes).to_pylist()
    signed = spark.createDataFrame([(i, int(n), x) for i, (n, x) in enumerate(zip(sizes, signs))], "key bigint, n int, signature array<bigint>")
    asked = spark.createDataFrame([p[:4] for p in pairs], "a bigint, b bigint, n_a int, n_b int")
    left = {r.a for r in jaccard_join._plausible(asked, signed).collect()}
    assert {p[0] for p in pairs if p[4]} <= left
    assert not {p[0] for p, kept in zip(pairs, [1.0, 0.9, 0.86, 0.3, 0.0] * 8) if kept <= 0.3 and p[2] >= 100} & left


def test_jaccard_links_join_components(spark):
    """Links between components, within one and of new nodes, against one search over all."""
    parts = spark.createDataFrame([(1, 1), (4, 1), (2, 2), (5, 2), (3, 3), (9, 3)], "node bigint, root bigint")
    links = spark.createDataFrame([(4, 5), (1, 5), (9, 10), (7, 8)], "a bigint, b bigint")
    got = {(r.node, r.root) for r in jaccard_join._joined_parts(parts, links).collect()}
    assert got == {(1, 1), (4, 1), (2, 1), (5, 1), (3, 3), (9, 3), (10, 3), (7, 7), (8, 7)}


def test_sentencepiece_equals_the_library(spark, docs):
    import public_tokenizers
    import sentencepiece as library

    reader = library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = sentencepiece.encode_texts(docs, "text", public_model())
    assert set(got.columns) == {"doc_id", "source", "kept", "n_tokens", "ids", "decoded"}
    for r in got.collect():
        ids = reader.encode(TEXTS[r.doc_id] or "", add_bos=True, add_eos=True)
        assert (r.n_tokens, list(r.ids), r.decoded) == (len(ids), ids, reader.decode(ids))
    digest = sentencepiece.encode_texts(docs, "text", public_model(), digests=True).filter("doc_id = 0").first()
    ids = reader.encode(TEXTS[0], add_bos=True, add_eos=True)
    assert digest.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_backtracking_equals_merging():
    vocab = sentencepiece.vocabulary(public_model())
    draw = np.random.default_rng(5)
    parts = ["a", "th", "er", "in", "▁", "▁▁", "日", "ing", "é", "😀", "1", "."]
    for _ in range(3000):
        text = "".join(draw.choice(parts, size=draw.integers(0, 12)))
        assert vocab.cover(text) == vocab.merged(text)


def test_units_and_pairs_remembered_are_bounded(monkeypatch):
    """Over all tasks of a worker; pairs share the vocabulary's strings."""
    monkeypatch.setattr(sentencepiece, "CACHE_UNITS", 100)
    vocab = sentencepiece.Vocabulary(public_model())
    unit = ["".join(x) for x in itertools.product("bcdgk", repeat=5)]
    for task in range(5):
        encoder = sentencepiece.Encoder(vocab)
        for i in range(200):
            encoder.ids(f"{unit[task * 200 + i]} the house")
    dicts = {id(d): d for x in (encoder, vocab) for d in vars(x).values() if isinstance(d, dict)}
    kept = [k for d in dicts.values() for k in d if isinstance(k, str) and k[1:] in unit and k not in vocab.ids]
    assert 100 <= len(kept) <= 2 * 103
    pairs = [p for pair in vocab._compatible for p in pair if p in vocab.ids and len(p) > 1]
    assert pairs and all(p is vocab.pieces[vocab.ids[p]] for p in pairs)


def test_word_hashes_need_little_beside_the_text():
    """Equal to the sum over places, without tables as long as the chunk."""
    import tracemalloc

    raw, at = common.text_bytes(pa.array(["", "ab c", "ab", None, "c " * (common.CHUNK_BYTES // 2)]))
    start, end, _ = common.word_spans(raw, at)
    common._powers.clear()
    tracemalloc.start()
    try:
        got = common.word_hashes(raw, start, end)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    inverse = pow(common._BASE, -1, 1 << 64)
    for i in (0, 1, 2, 3, 9_000, len(start) - 1):
        places = range(start[i], end[i])
        total = sum(int(common._BYTE[raw[p]]) * pow(common._BASE, p, 1 << 64) for p in places)
        value = total * pow(inverse, int(start[i]), 1 << 64) % (1 << 64)
        assert got[i] == common.mix(np.array([value], dtype=np.uint64))[0]
    assert got[0] == got[2] and got[1] == got[3] == got[-1]
    assert peak < 28 * common.CHUNK_BYTES  # the sums, and for each word, of two bytes here, two or three numbers


def test_interpolation_base_counts_and_probabilities(spark, docs):
    role = F.when(F.col("doc_id") % 4 == 0, 0).when(F.col("doc_id") % 4 == 1, 2).otherwise(1)
    got = {r.doc_id: r for r in interpolation.score_texts(docs.select("doc_id", "text"), role).collect()}
    tokens = {i: [*words(t), "\n"] for i, t in enumerate(TEXTS)}
    c = Counter(w for i, t in tokens.items() if i % 4 for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert got[i].base_score == pytest.approx(base) and got[i].score < 0
    assert got[4].score < got[1].score + 1e-6  # both copies of the base text, one seen in training
    assert interpolation.score_texts(docs.limit(0).select("doc_id", "text"), role).count() == 0


def test_interpolation_does_not_depend_on_the_numbered_words(spark, docs, monkeypatch):
    """Scores from brute-force counts, whichever words are numbered."""
    role = F.when(F.col("doc_id") % 4 == 0, 0).when(F.col("doc_id") % 4 == 1, 2).otherwise(1)
    asked = docs.select("doc_id", "text")
    learn, learnt = interpolation.learn_weights, []
    monkeypatch.setattr(interpolation, "learn_weights", lambda e, n: learnt.append((dict(e), n, learn(e, n))) or learnt[-1][2])
    tokens = {i: ["\n", *words(t), "\n"] for i, t in enumerate(TEXTS)}
    c = Counter(w for i, t in tokens.items() if i % 4 for w in t[1:])
    pairs = Counter(p for i, t in tokens.items() if i % 4 for p in zip(t, t[1:]))
    for vocabulary in (65_000, 40, 1):
        monkeypatch.setattr(interpolation, "VOCABULARY", vocabulary)
        got = {r.doc_id: r.score for r in interpolation.score_texts(asked, role).collect()}
        events, classes, weights = learnt[-1]
        assert (events, classes) == (learnt[0][0], len(c) + 1)
        for i, t in tokens.items():
            want = 0.0
            for h, w in zip(t, t[1:]):
                a, b, u = weights[int(math.log2(c[h])) + 1 if c[h] else 0]
                want += math.log10(a * pairs[h, w] / max(c[h], 1) + b * c[w] / sum(c.values()) + u / classes)
            assert got[i] == pytest.approx(want)


def test_interpolation_numbers_as_many_words_as_fit(spark, monkeypatch):
    """Pairs of more words than 32 bits hold keep their number; equal counts are numbered together or not at all."""
    draw = np.random.default_rng(3)
    hashes = np.unique(draw.integers(-(2**63), 2**63 - 1, 200_000))
    counts = np.arange(len(hashes), 0, -1)
    vocab = interpolation.Vocab(hashes, counts, counts * 0, (5, 0), (int(counts.sum()) + 5, 0))
    asked = np.concatenate([hashes[::7], hashes[::5] + 1, [2**63 - 1, -(2**63)]])
    number = {int(h): i + interpolation.FIRST for i, h in enumerate(hashes)}
    assert vocab.classes(asked).tolist() == [number.get(int(h), interpolation.OTHER) for h in asked]
    code = np.array([0, 1, vocab.width**2 - 1, (interpolation.VOCABULARY + 2) ** 2 - 1])
    assert interpolation._unpacked(pa.scalar(interpolation._packed(code))).tolist() == code.tolist()
    words = spark.createDataFrame([(i, n, 0) for i, n in enumerate([9, 4, 4, 1, 1, 1])], "word bigint, n bigint, dev bigint")
    for fit, listed in ((6, 6), (5, 3), (3, 3), (2, 1), (0, 0)):
        monkeypatch.setattr(interpolation, "VOCABULARY", fit)
        assert interpolation._vocabulary(words, (0, 0), (20, 0)).width - interpolation.FIRST == listed


def test_weights_follow_the_events():
    key = (5 * 2000 + (-4 + 999)) * 2000 + (-40 + 999)
    weights = interpolation.learn_weights({key: 100}, 1000)
    assert weights[5][0] > 0.9 and np.allclose(weights.sum(axis=1), 1)


def test_language_id(spark):
    lines = {"en": "the house of the thing with that", "de": "und der schöne nicht über die straße", "fr": "le château été où être ça"}
    rows = [(i, f"{lines[n]} {i}", n) for i, n in enumerate(list(lines) * 20)]
    model = language_id.fit(spark.createDataFrame(rows, "id bigint, text string, lang string"))
    asked = [(1, "the thing of that"), (2, "der schöne und die"), (3, "le château où"), (4, None), (5, "12 34"), (6, "")]
    df = spark.createDataFrame(asked, "doc_id bigint, text string")
    got = {r.doc_id: r for r in language_id.predict_languages(df, model).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["en", "de", "fr", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in got.values())


def test_block_max_search_is_exact():
    draw = np.random.default_rng(3)
    entries, dense = [], []
    for i in range(700):
        ids = np.sort(draw.choice(40, size=draw.integers(1, 6), replace=False)).astype("<u4")
        w = draw.random(len(ids)).astype("<f4")
        w /= np.linalg.norm(w)
        entries.append((ids.tobytes(), w.tobytes(), 1, 0, i))
    index = toxicity.BlockMaxIndex(entries)
    for e in sorted(entries):
        row = np.zeros(40)
        row[np.frombuffer(e[0], "<u4")] = np.frombuffer(e[1], "<f4")
        dense.append(row)
    dense = np.array(dense)
    for q in range(0, 700, 50):
        ids, w = np.flatnonzero(dense[q]), dense[q][dense[q] > 0]
        _, cosines = index.search(ids, w, 10)
        assert np.allclose(np.sort(cosines)[::-1], np.sort(dense @ dense[q])[::-1][:10], atol=1e-5)


def test_toxicity(spark):
    rows = [(i, f"clean words number {'abcdefgh'[i % 8] * 3} {'scum' if i % 4 == 0 else 'fine'}", int(i % 4 == 0)) for i in range(80)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    asked = spark.createDataFrame([(1, "you scum"), (2, "fine words"), (3, ""), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in toxicity.score_texts(asked, labelled).collect()}
    assert got[1] >= 0.9 and max(got[2], got[3], got[4]) < 0.3
    assert {r.score for r in toxicity.score_texts(asked, labelled.limit(0)).collect()} == {0.0}


def test_toxicity_searches_texts_without_telling_words(spark):
    # no word passes a bar of support or odds: each toxic text has words of its own
    rows = [(i, " ".join(f"{a}{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for a in ("rus", "tel", "mor", "vin")), int(i < 3)) for i in range(60)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    asked = spark.createDataFrame([(1, rows[1][1] + " xyz"), (2, rows[40][1])], "doc_id bigint, text string")
    got = {r.doc_id: r for r in toxicity.score_texts(asked, labelled, k=1).collect()}
    assert got[1].score >= 0.9 and list(got[1].evidence) == [1]
    assert got[2].score < 0.1 and list(got[2].evidence) == [40]


def _toxic_brute_force(texts, labels, asked, k):
    """Votes by comparing everything with everything, and nearest examples' places."""
    share = lambda n, m: (n + 0.5) / (m + 1)
    held = [toxicity.term_counts(t) for t in texts]
    n, pos = len(texts), sum(labels)
    df, good = Counter(), Counter()
    for v, y in zip(held, labels):
        df.update(v.keys())
        good.update(v.keys() if y else ())
    weight = {
        t: math.log(1 + n / c) * (1 + max(math.log(share(good[t], pos)) - math.log(share(c - good[t], n - pos)), 0))
        for t, c in df.items()
        if c <= max(n / 10, 10) or share(good[t], pos) > share(c - good[t], n - pos) * math.exp(0.5)
    }
    vec = lambda c: {t: (1 + math.log(x)) * weight[t] for t, x in c.items() if t in weight}
    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))
    base = [vec(c) for c in held]
    out = []
    for text in asked:
        v = vec(toxicity.term_counts(text))
        if not v:
            bare = [y for u, y in zip(base, labels) if not u]
            out.append(sum(bare) / max(len(bare), 1))
            continue
        near = sorted(
            (-sum(w * u.get(t, 0.0) for t, w in v.items()) / norm(v) / norm(u), y) for u, y in zip(base, labels) if u
        )[:k]
        votes = [(1 / (1.05 + c), y) for c, y in near if c < 0]
        out.append((pos / n + sum(w for w, y in votes if y)) / (1 + sum(w for w, _ in votes)))
    return out


def _drawn_texts(n, seed=5):
    draw = np.random.default_rng(seed)
    names = [a + b + c for a in "bcdfg" for b in "aeiou" for c in "klmnp"]
    return [" ".join(draw.choice(names, size=draw.integers(2, 30))) for _ in range(n)]


def test_toxicity_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    texts = _drawn_texts(150)
    labels = [int(i % 5 == 0) for i in range(100)]
    rows = list(zip(range(100), texts, labels))
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in toxicity.score_texts(asked, labelled, k=7).collect()}
    for i, want in enumerate(_toxic_brute_force(texts[:100], labels, texts, 7)):
        assert got[i] == pytest.approx(want, abs=1e-4)


def test_block_max_search_skips_blocks():
    draw = np.random.default_rng(4)
    entries = []
    for i in range(1024):  # eight kinds of texts with few terms in common
        ids = np.unique(np.append(draw.choice(40, size=12) + 40 * (i % 8), 320)).astype("<u4")
        w = np.ones(len(ids), "<f4")
        entries.append((ids.tobytes(), (w / np.linalg.norm(w)).astype("<f4").tobytes(), 1, 0, i))
    index = toxicity.BlockMaxIndex(entries)
    dense = np.zeros((1024, 321))
    for row, e in zip(dense, entries):
        row[np.frombuffer(e[0], "<u4")] = np.frombuffer(e[1], "<f4")
    for q in range(0, 1024, 16):
        found, cosines = index.search(np.flatnonzero(dense[q]), dense[q][dense[q] > 0], 10)
        assert np.allclose(cosines, np.sort(dense @ dense[q])[::-1][:10], atol=1e-5)
        assert np.allclose(dense[[index.example[e] for e in found]] @ dense[q], cosines, atol=1e-5)
    assert index.scored < 0.3 * 64 * index.blocks


def test_search_reads_short_lists_whole(monkeypatch):
    draw = np.random.default_rng(5)
    entries = []
    for i in range(900):  # some two postings of a term in a block
        ids = np.sort(draw.choice(600, size=20, replace=False)).astype("<u4")
        w = draw.random(20)
        entries.append((ids.tobytes(), (w / np.linalg.norm(w)).astype("<f4").tobytes(), 1, 0, i))
    index = toxicity.BlockMaxIndex(entries)
    queries = [(np.frombuffer(e[0], "<u4"), np.frombuffer(e[1], "<f4")) for e in entries[::30]]
    monkeypatch.setattr(toxicity, "WHOLE", math.inf)
    cut = [index.search(*q, 10) for q in queries]
    monkeypatch.undo()
    monkeypatch.setattr(toxicity.BlockMaxIndex, "_add", None)  # no list is cut
    for q, (found, cosines) in zip(queries, cut):
        whole = index.search(*q, 10)
        assert (whole[0] == found).all() and (whole[1] == cosines).all()


def test_words_are_not_remembered():
    terms = toxicity.Terms(["gone", "gone*", "goner*"], np.ones(3))
    held = {name: len(x) for name, x in vars(terms).items()}
    text = "Gone goners gones goner gon " + " ".join("x" + "abcdefghij"[i % 10] * (i // 10 + 3) for i in range(500))
    want = {terms.number[t]: n for t, n in toxicity.term_counts(text).items() if t in terms.number}
    assert terms.counts(text) == want == {0: 1, 1: 3, 2: 1}
    assert {name: len(x) for name, x in vars(terms).items()} == held


def test_scored_texts_are_not_kept(spark):
    """Copies are told by a digest, so a task does not hold thousands of texts."""
    import tracemalloc
    from types import SimpleNamespace

    terms = toxicity.Terms(["word"], np.ones(1))
    index = toxicity.BlockMaxIndex([(np.zeros(1, "<u4").tobytes(), np.ones(1, "<f4").tobytes(), 1, 0, 7)])
    run = toxicity._score(SimpleNamespace(value=terms), SimpleNamespace(value=index), 0.5, 0.25, None, 5, [])

    def batches():
        for i in range(20):
            texts = [f"word {i} {j} " * 300 for j in range(50)]
            yield pa.RecordBatch.from_arrays([pa.array([*texts, None, texts[0]], pa.string())], names=["_text"])

    tracemalloc.start()
    try:
        scores = [x for part in run(batches()) for x in part["score"].to_pylist()]
        out = run(batches())
        before = tracemalloc.get_traced_memory()[0]
        for _ in range(20):
            next(out)
        grown = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert len(scores) == 20 * 52 and scores[50] == 0.25 and scores[51] == scores[0] != 0.25
    assert grown < 1_500_000  # 1,000 texts of some 3,000 characters, less the last batch


def test_toxicity_is_calibrated(spark):
    # a third of the rows that hold telling words carry label 1, none of the others
    texts = _drawn_texts(400, 8)
    rows = [(i, t + (" scum trash moron" * 9 if i % 2 else ""), int(i % 6 == 1)) for i, t in enumerate(texts)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    asked = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    scorer = toxicity.Scorer(labelled)
    votes, shares = scorer.shares
    assert all(a <= b for a, b in zip(shares, shares[1:])) and all(a < b for a, b in zip(votes, votes[1:]))
    got = {r.row.doc_id: r.score for r in scorer.rows(asked, "text").collect()}
    telling = np.mean([got[i] for i in range(1, 400, 2)])
    assert 0.2 < telling < 0.45 and np.mean([got[i] for i in range(0, 400, 2)]) < 0.05


def test_isotonic_pools_falling_neighbours():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 2, 1, 4]), np.array([4.0, 4, 4, 4]), 0.0)
    assert np.allclose(x, [0.1, 0.25, 0.4]) and np.allclose(y, [0, 3 / 9, 4 / 5])


def test_toxicity_examples_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "EXAMPLES", 40)
    texts = _drawn_texts(120)
    for ids in (range(120), [1] * 120, [None] * 120):  # each row twice: one entry of two
        rows = [(i, t, int(t < "g")) for i, t in zip(ids, texts)] * 2
        scorer = toxicity.Scorer(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
        assert scorer.index.value.size == 40 and scorer.index.value.votes.sum() == 80


def test_toxicity_rows_of_any_shape(spark):
    rows = [(i, f"{'vile' if i % 2 else 'kind'} words here", i % 2) for i in range(20)] + [(99, None, 0), (100, "", 1)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    scorer = toxicity.Scorer(labelled)
    asked = spark.createDataFrame(
        [(1, "vile", 7, "x"), (1, "vile", 7, "x"), (None, "kind " * 200_000, None, None), (2, None, 1, "y"), (3, "", 1, "z")],
        "doc_id bigint, text string, score int, evidence string",
    )
    got = scorer.rows(asked, "text").collect()
    assert len(got) == 5
    by = {(r.row.doc_id, r.row.score): r for r in got}
    assert by[1, 7].score > 0.5 and by[1, 7].row.evidence == "x"
    assert by[None, None].score < 0.5 and len(by[None, None].row.text) == 1_000_000
    assert by[2, 1].score == by[3, 1].score == 0.5 and list(by[3, 1].evidence) == []
    assert scorer.rows(asked.limit(0), "text").collect() == []


def test_leaks_with_other_numbers(spark):
    item = "A train leaves Paris at 9 o'clock with 120 people and meets another train of 120 people near the old bridge."
    copy = item.replace("120", "340").replace("9 o", "7 o")
    mixed = item.replace("120 people and", "340 people and")  # one value of the item stands for two
    items = spark.createDataFrame([(7, item), (8, ""), (9, None)], "item_id bigint, text string")
    asked = [(1, f"Intro here. {item} And more."), (2, f"So. {copy}"), (3, "nothing of it"), (4, mixed), (5, None), (6, "")]
    df = spark.createDataFrame(asked, "doc_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.find_leaks(df, items).collect()}
    assert set(got) == {1, 2, 4} and {r.item_id for r in got.values()} == {7}
    assert got[1].consistent and got[1].changed == 0 and got[2].consistent and got[2].changed > 0
    assert not got[4].consistent


def test_pii_spans_and_disclosing_terms(spark, docs):
    got = {r.doc_id: r for r in pii.find_spans(docs, "text").collect()}
    text = TEXTS[11]
    mail, ip, card, phone = text.index("a.b@"), text.index("10.0.0.25 "), text.index("4111"), text.index("+1")
    assert f"email:{mail}:{mail + 17}" in got[11].base_spans and f"ip:{ip}:{ip + 9}" in got[11].base_spans
    assert "10.0.0.256" not in [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in got[11].base_spans.split(","))]
    assert f"phone:{phone}:{phone + 17}" in got[11].base_spans and got[6].base_spans == ""
    rows = [(i, f"w{chr(97 + i)}x quorvane x{chr(97 + i)}y me@site.example.com z{chr(97 + i)}") for i in range(8)]
    rows += [(100 + i, f"plain{i} you{i}@other{i}.example.com the end") for i in range(800)]
    rows.append((999, "the quorvane again"))
    people = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(people, "text").collect()}
    assert "quorvane" not in clean[0] + clean[999] and "<EMAIL>" in clean[0] and clean[100].endswith("the end")


def test_disclosing_terms_as_by_brute_force(spark):
    name = lambda i: f"w{chr(97 + i % 16)}{chr(97 + i % 5)}x"
    people = [f"{name(i)} quorvane the me{i % 80}@site.example.com zed ulmic{chr(97 + i % 7)}" for i in range(400)]
    people += [f"the {name(i)} again number {i} here" for i in range(100)] + [None, "", people[0]]
    got = pii.disclosing_terms(spark.createDataFrame([(t,) for t in people], "text string").repartition(5), "text")
    near = {r for t in people if t for r in pii.terms_near(t, pii.pattern_spans(t))}
    texts = [set(pii.RUN.findall(t.lower())) for t in set(people) if t]
    joint, total = Counter((e, t) for e, t, _ in near), len({c for *_, c in near})
    entity = Counter(e for e, _ in {(e, c) for e, _, c in near})
    want: dict = {}
    for (e, t), n in joint.items():
        share = min(1.0, n / sum(t in held for held in texts))
        bits = math.log2(share * total / entity[e])
        if n >= pii.CONTEXTS and share >= pii.SHARE and bits >= pii.BITS:
            want[t] = max(want.get(t, (0.0, 0.0)), (bits, share))
    assert 0 < len(want) < 80 and max(s for _, s in want.values()) < 1
    assert {r.term: (round(r.bits, 9), r.share) for r in got.collect()} == {
        t: (round(b, 9), s) for t, (b, s) in want.items()
    }


def test_url_filter(spark):
    urls = ["https://a.example.com/en/1", "http://WWW.example.com/en/2?x", "http://b.net/es/", "http://c.org/p?x=1",
            "https://www.c.org/p/", "http://d.org/q", None, "no scheme", ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    listed = url_filter.stored_list(pages, "url")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, "url", URL_RULES, listed).collect()}
    assert [got[i].verdict for i in range(9)] == ["block", "allow", "block", "block", "block", "allow", "allow", "allow", "allow"]
    assert got[1].rule == "www.example.com/en/" and got[7].host == "" and got[6].path == ""


def test_quality(spark, docs):
    got = {r.doc_id: r for r in quality.judge_quality(docs, "text").collect()}
    for i, t in enumerate(TEXTS):
        w = WORD.findall(t or "")
        grams = [tuple(w[j : j + 8]) for j in range(len(w) - 7)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        covered = {j + k for j, g in enumerate(grams) if g in twice for k in range(8)}
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert got[i].base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
    assert not got[10].kept and not got[6].kept


def test_fold_is_crc32(spark):
    from dimwright.llm.common import fold

    got = spark.range(200).select("id", fold(F.col("id"), 7).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 7 for r in got)


def test_sanitise_keeps_columns_with_clashing_names(spark):
    names = ["base_spans", "term_spans", "_maybe", "_row", "row", "body", "doc_id"]
    schema = ", ".join(f"{n} string" for n in names) + ", text string"
    df = spark.createDataFrame([(*names, "mail a.b@c.example.com now"), (*names, None), (*names, "")], schema)
    got = pii.sanitise(df, "text")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(*names, "mail <EMAIL> now"), (*names, None), (*names, "")], key=str
    )
    assert pii.sanitise(df.limit(0), "text").collect() == []


COPIES = [
    (1, BASE), (1, BASE), (None, BASE), (2, BASE.replace("word59", "other")), (2, "quite another text"),
    (3, None), (3, None), (4, ""), (5, "Quite Another  text"), (None, "alone without an id"),
]


def test_one_document_of_each_group_stays_by_row(spark):
    import corpus_pipeline

    rows = [(i, t, "en", "s", n, "x") for n, (i, t) in enumerate(COPIES)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, df, None)
    assert got.columns == df.columns
    # brute force: link all pairs, then the least id of each component, NULL last
    sets = [shingles(t) for _, t in COPIES]
    group = list(range(len(COPIES)))
    for _ in COPIES:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    want = {}
    for i, (key, text) in enumerate(COPIES):
        want.setdefault(group[i], []).append((key is None, key or 0, text))
    best = sorted(min((none, key) for none, key, _ in members) for members in want.values())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == best
    texts_left = [r.text for r in got.collect()]
    assert "quite another text" in texts_left and texts_left.count(None) == 2 and texts_left.count("") == 1
    assert corpus_pipeline.drop_near_copies(spark, df.limit(0), None).count() == 0


def test_leaks_go_by_row(spark):
    import corpus_pipeline

    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first()["text"]
    rows = [(1, f"before {item} after"), (1, "clean text of the same id"), (None, f"x {item} y"), (None, "no id"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.drop_leaks(spark, df, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert 100 < out.count() < 200 and {"ids", "decoded_sha256"} <= set(out.columns)
