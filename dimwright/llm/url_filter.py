"""URL filter: prefix rules, then a blocked Bloom filter in front of an exact join.

The Bloom filter is a table of ``blocks`` rows of four 64-bit words, so its
size is fixed by a parameter and may be broadcast whatever the list holds.
A URL picks one block and sets one bit in each word. URLs whose bits are all
set go to an exact hash join with the list, which removes false positives;
the others never leave their task. Everything is built-in expressions.

Defined results: a NULL URL, or one without ``://``, has empty host and path,
matches no rule, no list entry, and is allowed. Repeated rows are judged each
for itself. An empty table gives no rows, an empty list blocks nothing.
Columns of the input beside the URL are kept; a column of the input that has
the name of a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import lower_az
from dimwright.session import materialise

LANES = 4
# Parts of an address that do not change the page it names.
MIRRORS = r"^(www|m)\."
ENDINGS = r"(/index)?(\.html?)?/*$"

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_az(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Address without scheme, query, fragment, mirror names, ending; NULL without a host."""
    plain = F.concat(F.regexp_replace(host, MIRRORS, ""), F.regexp_replace(path, ENDINGS, ""))
    return F.when(host != "", plain)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Longest rule that fits, as text and as verdict; NULL where none does.

    The rules are few and become one CASE, longest first."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name = verdict = None
    for what, rule_host, rule_path in ranked:
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path) if name is None else name.when(fits, rule_host + rule_path)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)).cast("int")


def _bit(key: Column, lane: int) -> Column:
    place = F.pmod(F.xxhash64(key, F.lit(lane)), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def blocked_bloom(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """At most ``blocks`` rows: block number and its words."""
    return (
        keys.filter(F.col(column).isNotNull())
        .groupBy(_block(F.col(column), blocks).alias("_block"))
        .agg(*(F.bit_or(_bit(F.col(column), i)).alias(f"_lane{i}") for i in range(LANES)))
    )


def listed_among(rows: DataFrame, key: str, listed: DataFrame, flag: str, blocks: int) -> DataFrame:
    """``rows`` with a flag that says whether ``key`` is one of ``listed`` (one
    column, any repeats)."""
    entries = listed.select(F.col(listed.columns[0]).alias("_entry")).distinct()
    bloom = F.broadcast(blocked_bloom(entries, "_entry", blocks))  # blocks x 5 numbers at most
    tested = rows.withColumn("_block", _block(F.col(key), blocks)).join(bloom, "_block", "left")
    may = reduce(
        lambda a, b: a & b,
        [F.col(f"_lane{i}").bitwiseAND(_bit(F.col(key), i)) != 0 for i in range(LANES)],
    )
    probed = tested.withColumn("_may", F.coalesce(may, F.lit(False)))
    # only possible hits are dealt out by key; the rest stay where they are
    missed = probed.filter(~F.col("_may")).select(*rows.columns, F.lit(False).alias(flag))
    possible = probed.filter("_may")
    checked = possible.join(entries, possible[key] == F.col("_entry"), "left")
    return missed.unionByName(checked.select(*rows.columns, F.col("_entry").isNotNull().alias(flag)))


def judge_urls(
    pages: DataFrame, url: str, rules: Sequence[Rule], listed: DataFrame, blocks: int = 1 << 14
) -> DataFrame:
    """``pages`` with host, path, canonical, rule, listed and verdict.

    The longest fitting rule decides; without one, a URL whose canonical form
    is among ``listed`` is blocked."""
    added = ["host", "path", "canonical", "rule", "listed", "verdict"]
    kept = [F.col(c) for c in pages.columns if c.lower() not in added]
    taken = F.col(url)
    parts = pages.select(
        *kept, host_of(taken).alias("host"), path_of(taken).alias("path")
    )
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select(
        "*",
        canonical(F.col("host"), F.col("path")).alias("canonical"),
        name.alias("rule"),
        verdict.alias("_ruled"),
    )
    seen = listed_among(ruled, "canonical", listed, "listed", blocks)
    final = F.coalesce("_ruled", F.when(F.col("listed"), "block").otherwise("allow"))
    return seen.withColumn("verdict", final).drop("_ruled")


def repeated_addresses(pages: DataFrame, url: str) -> DataFrame:
    """Canonical addresses fetched under two or more different URLs: traps that
    serve one page under many names. Counted over all pages."""
    found = pages.select(
        canonical(host_of(F.col(url)), path_of(F.col(url))).alias("canonical"), F.col(url).alias("_url")
    ).filter(F.col("canonical").isNotNull())
    return (
        found.groupBy("canonical")
        .agg(F.min("_url").alias("_low"), F.max("_url").alias("_high"))
        .filter(F.col("_low") != F.col("_high"))
        .select("canonical")
    )


def stored_list(pages: DataFrame, url: str) -> DataFrame:
    """The list of ``repeated_addresses``, written once for its several readers."""
    return materialise(repeated_addresses(pages, url), "listed-urls")
