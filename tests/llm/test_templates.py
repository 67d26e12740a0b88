"""Benchmark leaks by templates: re-parameterised questions, and brute force."""

import random

import pytest

from dimwright.llm import decontaminate
from dimwright.llm.decontaminate import CLOSING, COVERAGE, DRIFT, EDGE, LEAST, LITERALS, NUMBER, UNITS, WINDOW

STORY = (
    "Every morning Peter buys 12 apples from the market, then he gives 5 of them to Tom and walks 3 km home, "
    "where Peter finds that 2 apples were bad. How many apples does he still have after lunch with Tom?"
)
PLAIN = (
    "the old miller keeps seven grey cats in his barn because the mice eat all of the corn that he "
    "wants to sell"
)


def read_slowly(text, opens=True):
    """Template tokens, word by word."""
    tokens, after_number, joins = [], False, False
    for word in text.replace("\n", " ").split(" "):
        core = word.strip(EDGE)
        ends = word.rstrip(CLOSING)[-1:] in (".", "!", "?", "…") and word != ""
        if not core:
            opens, joins = opens or ends, joins
            continue
        found = NUMBER.fullmatch(core)
        unit = (found[2] or "").lower() if found else ""
        was_number, after_number = after_number, False
        if found and (not unit or unit in UNITS):
            tokens.append(("#num", found[1]))
            if unit:
                tokens.append(("#unit", unit))
            after_number, joins = not unit, False
        elif was_number and core.lower() in UNITS:
            tokens.append(("#unit", core.lower()))
            joins = False
        elif not opens and core[0].isupper() and not core.isupper():
            if joins:
                tokens[-1] = ("#name", f"{tokens[-1][1]} {core.lower()}")
            else:
                tokens.append(("#name", core.lower()))
            joins = word[-1] not in EDGE
        else:
            tokens.append(("", core.lower()))
            joins = False
        opens = ends
    return tokens


def windows_slowly(tokens, size):
    for i in range(len(tokens) - size + 1):
        part = tokens[i : i + size]
        plain = sum(k == "" for k, _ in part)
        key = tuple(k or v for k, v in part) if plain >= min(LITERALS, size) else ("by value", *(v for _, v in part))
        yield i, key, [f"{k}:{v}" for k, v in part if k]


def leaks_slowly(docs, items):
    out = {}
    for doc_id, text in docs:
        read = read_slowly(text or "")
        for item_id, item in items:
            for opens in (True, False):
                asked = read_slowly(item or "", opens)
                if not asked:
                    continue
                size = min(WINDOW, len(asked))
                mine = list(windows_slowly(asked, size))
                hits = [
                    (i, j, size, s, t) for i, k, s in windows_slowly(read, size) for j, other, t in mine if k == other
                ]
                chain = decontaminate.best_chain(hits, len(asked), max(COVERAGE * len(asked), min(LEAST, len(asked))))
                if chain:
                    got = (chain.consistent, chain.matched, -chain.start, chain.n_slots, chain.changed, len(asked))
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), got), got)
    return out


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string, digest string").repartition(3)
    return decontaminate.find_leaks(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()


def rows_of(texts):
    return [(i, t, "clash", "clash") for i, t in texts]


def test_reparameterised_questions_are_found(spark):
    items = [(1, "What is 12 * 3?"), (2, STORY), (3, PLAIN)]
    renamed = STORY.replace("Peter", "Mary Ann").replace("Tom", "Jean Luc").replace("12", "40").replace("3 km", "7km")
    words = PLAIN.split()
    inserted = " ".join([*words[:6], "very", *words[6:12], "often", *words[12:17], "really", *words[17:]])
    docs = rows_of([
        (1, "Some talk before. What is 12 * 3? Some after."), (2, "ask them what is 15 * 4 now"), (3, renamed),
        (4, f"and so {inserted} and more"), (5, "the old miller keeps seven dogs and nothing else happens in his yard"),
        (6, "He met Peter and Tom at the market, and nobody had apples."), (7, None), (8, ""), (9, "#what #is 12 * 3 #tags"),
    ])
    got = {(r.doc_id, r.item_id): r for r in found(spark, docs, items)}
    assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 3)}
    assert all(r.consistent for r in got.values())
    assert got[1, 1].changed == 0 and got[2, 1].changed == 2 and got[3, 2].changed == 4
    assert got[4, 3].coverage == 1.0


def test_one_value_for_two_is_not_consistent(spark):
    # the first of two equal values is replaced, the second is not
    item = "the farmer sells 120 sheep to the king and then buys 120 sheep back from the poor king"
    other = item.replace("120", "7", 1)
    got = {r.doc_id: r for r in found(spark, rows_of([(1, other), (2, f"{other}. {item}"), (2, "short")]), [(5, item)])}
    assert not got[1].consistent and got[2].consistent


def test_leaks_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "Paul", "Ann", "km", "12", "5kg", "7%", "x.", "y,", "-", "...", "Z!", "ça", "Été", "(Tom)", "kg"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 5, 9, 14, 25]))) for i in range(12)] + [(50, None), (51, ""), (52, "... !")]
    docs = [(i, text(rng.randrange(1, 60))) for i in range(30)]
    docs += [(100 + i, f"{text(7)} {items[i][1]} {text(4)}") for i in range(12)] + [(200, None), (201, ""), (100, docs[0][1])]
    want: dict = {}
    for doc in docs:
        for key, value in leaks_slowly([doc], items).items():
            want[key] = max(want.get(key, value), value)
    got = {(r.doc_id, r.item_id): (r.consistent, r.n_matched, r.n_slots, r.changed, r.n_tokens) for r in
           found(spark, rows_of([*docs, docs[3], docs[3]]), items)}
    assert len(want) > 12 and got == {k: (c, m, n, ch, t) for k, (c, m, _, n, ch, t) in want.items()}


def test_readings_equal_the_slow_ones():
    hard = [STORY, PLAIN, "Mr. X met Ann Lee (Tom) ... And 5 kg, 6kg. 7% İstanbul ßß", "", " - ... ", "# #num #name 5",
            "x \u00c9t\u00e9 \u00c9T\u00c9 \u00d7\u00c9a a\u00f7 na\u00efve, (\u00c0vila) \u00dcber. \u00df!? \u0391\u03b8\u03ae\u03bd\u03b1 I am A Ab"]
    for text in hard:
        for opens in (True, False):
            assert decontaminate.template(text, opens) == read_slowly(text, opens)


def test_chains_equal_all_subsets():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(6, 16)
        hits = {(rng.randrange(20), rng.randrange(n - 2)) for _ in range(rng.randrange(1, 7))}
        runs = decontaminate.best_chain([(d, i, 3, [], []) for d, i in hits], n, 1)
        best = 0
        order = sorted(hits)
        for mask in range(1, 1 << len(order)):
            part = [h for k, h in enumerate(order) if mask >> k & 1]
            total = 3
            for (e, j), (d, i) in zip(part, part[1:]):
                gain = min(3, d - e, i - j)
                if gain <= 0 or abs((d - i) - (e - j)) > DRIFT:
                    break
                total += gain
            else:
                best = max(best, total)
        assert runs.matched == best


@pytest.mark.parametrize("docs, items", [([], [(1, PLAIN)]), ([(1, PLAIN)], []), ([], [])])
def test_empty_tables_give_no_leaks(spark, docs, items):
    assert found(spark, rows_of(docs), items) == []


def test_very_long_texts_are_read_whole(spark):
    long = " ".join(f"w{i % 5003}" for i in range(400_000))  # beyond one chunk
    got = found(spark, rows_of([(1, f"{long} {PLAIN}"), (2, f"{PLAIN} {long}"), (3, long)]), [(4, PLAIN)])
    assert sorted((r.doc_id, r.coverage) for r in got) == [(1, 1.0), (2, 1.0)]
