"""Quality filter by weak supervision.

Each rule votes on a text (good 1, bad 0) or abstains. How far to trust a rule
is not set by hand: expectation-maximisation over the vote patterns of all
texts estimates how often each rule is right, and a text is kept when its
posterior probability of good quality reaches a bar.

Texts are reduced to their vote pattern first, so the iterations run on a
table of at most 3 ** rules rows whatever the corpus holds. Every step is a
built-in expression; nothing leaves the engine but two numbers per rule.

Defined results: a NULL text has no words, fails the base rule and is not
kept; so does an empty one. Repeated rows count each for itself. An empty table gives
no rows. Columns of the input beside id and text are kept; one that has the
name of a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.session import materialise

WINDOW = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more in the array."""

    def of_sorted(ranked: Column) -> Column:
        n = F.size(ranked)

        def twin(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(ranked, i - 1)["h"] == x["h"])
            after = F.when(i < n - 1, F.get(ranked, i + 1)["h"] == x["h"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        places = F.array_sort(F.transform(F.filter(ranked, twin), lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    ranked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(ranked, of_sorted)


def text_measures(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the counts the rules look at. Two plain steps keep the
    word array and the window array from being computed per use."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(" \t\n\x0b\f\r"))
    split = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )
    words = docs.withColumn("_words", split)
    hashed = F.transform("_words", lambda w: F.xxhash64(w))
    windows = _let(
        hashed,
        lambda h: F.when(
            F.size(h) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - WINDOW),
                lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(WINDOW))),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    repeats = _let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _covered(w)).otherwise(
            F.lit(0).cast("long")
        ),
    )

    def count_of(*marks: str) -> Column:
        gone = body
        for mark in marks:
            gone = F.replace(gone, F.lit(mark), F.lit(""))
        return (F.length(body) - F.length(gone)).cast("long")

    return words.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.length(F.regexp_replace(body, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(body, r"\P{L}+", "")).cast("long").alias("n_letters"),
        count_of("!", "?").alias("n_marks"),
        count_of(".").alias("n_stops"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def votes() -> dict[str, Column]:
    """1 good, 0 bad, -1 abstains. Bars are on ratios, so length alone decides nothing."""
    n = F.greatest(F.col("n_words"), F.lit(1))

    def bad_above(part: str, whole: Column, bar: float) -> Column:
        return F.when((F.col("n_words") >= 20) & (F.col(part) / whole > bar), 0).otherwise(-1)

    mean = F.col("word_chars") / n
    letters = F.greatest(F.col("n_letters"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    plain = F.col("n_letters") - F.col("n_upper")
    return {
        "symbols": bad_above("n_symbols", n, 0.10),
        "lines": bad_above("n_dup_lines", lines, 0.30),
        "repeats": bad_above("n_repeat_words", n, 0.20),
        "capitals": bad_above("n_upper", letters, 0.30),
        "marks": bad_above("n_marks", n, 0.20),
        "letters": F.when(F.col("n_letters") < 0.75 * chars, 0).otherwise(-1),
        "word_length": F.when((mean < 2.5) | (mean > 12), 0).otherwise(-1),
        "plain": F.when(F.col("n_words") < 20, -1)
        .when(plain < 0.75 * chars, 0)
        .when(plain >= 0.88 * chars, 1)
        .otherwise(-1),
        "sentences": F.when(F.col("n_words") < 50, -1)
        .when(F.col("n_stops") == 0, 0)
        .when(F.col("n_stops") * 60 >= n, 1)
        .otherwise(-1),
    }


def posterior(names: list[str], prior: float, trust: dict[str, float]) -> Column:
    """Probability of good quality given the votes; an abstention says nothing."""
    odds = F.log(F.lit(prior / (1 - prior)))
    for name in names:
        weight = F.log(F.lit(trust[name] / (1 - trust[name])))
        odds = odds + F.when(F.col(name) == 1, weight).when(F.col(name) == 0, -weight).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def fit(
    patterns: DataFrame, names: list[str], rounds: int = 25, settle: float = 1e-6
) -> tuple[float, dict[str, float]]:
    """Share of good texts and accuracy of each rule, by expectation-maximisation
    over the pattern table (votes and ``n``).

    Starts from even odds and rules right three times in four. A rule is held
    to be better than chance, which also fixes which class is the good one."""
    prior, trust = 0.5, dict.fromkeys(names, 0.75)
    for _ in range(rounds):
        weighed = patterns.withColumn("_p", posterior(names, prior, trust))
        sums = [F.sum("n").alias("all"), F.sum(F.col("n") * F.col("_p")).alias("good")]
        for name in names:
            right = F.when(F.col(name) == 1, F.col("_p")).when(F.col(name) == 0, 1 - F.col("_p"))
            sums.append(F.sum(F.when(F.col(name) >= 0, F.col("n")).otherwise(0)).alias(f"{name}:cast"))
            sums.append(F.coalesce(F.sum(F.col("n") * right), F.lit(0.0)).alias(f"{name}:right"))
        row = weighed.agg(*sums).first()
        if not row["all"]:
            break
        updated = (row["good"] + 1) / (row["all"] + 2)
        trust = {
            name: min(max((row[f"{name}:right"] + 3) / (row[f"{name}:cast"] + 4), 0.55), 0.99)
            for name in names
        }
        moved, prior = abs(updated - prior), min(max(updated, 0.05), 0.95)
        if moved < settle:
            break
    return prior, trust


def judge_quality(docs: DataFrame, text: str, bar: float = 0.5) -> DataFrame:
    """``docs`` with the measures, one ``vote_*`` column per rule, the
    posterior ``quality``, ``base_failed`` and ``kept``.

    The measured table is stored once: the patterns and the verdicts read it."""
    rules = votes()
    names = [f"vote_{name}" for name in rules]
    made = {
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_upper",
        "n_letters", "n_marks", "n_stops", "quality", "base_failed", "kept", "_words", *names,
    }
    body = docs.withColumn("_text", F.col(text))
    kept = [c for c in docs.columns if c.lower() not in made and c != text]
    measured = text_measures(body.select(*kept, "_text"), "_text").drop("_text")
    voted = measured.select("*", *(v.cast("int").alias(f"vote_{k}") for k, v in rules.items()))
    stored = materialise(voted, "quality-votes")
    patterns = materialise(
        stored.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "quality-patterns"
    )
    prior, trust = fit(patterns, names)
    judged = stored.withColumn("quality", posterior(names, prior, trust))
    return judged.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= bar)
    )
