"""Column expressions shared by the operators; all stay inside codegen."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain letters, position by position.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
PLAIN = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"

# The bands of the market index, whole market first.
TOTAL_BAND = "Total"
BANDS = (TOTAL_BAND, "1D", "2D", "3D", "4D")

# The JVM upper-cases this letter to two letters; the key keeps it as it is.
_SHARP_S = "ß"
_PLACEHOLDER = "\ue000"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A 64-bit hash is added up in three pieces of 22 bits.
_PIECE_BITS = 22


def hash_sums(row_hash: Column, weight: Column | None = None) -> list[Column]:
    """Sums of the pieces of a 64-bit hash, as plain long numbers: two sets of
    rows whose hashes add up alike have equal sums. A decimal sum would say the
    same, but is worked out row by row on objects. ``weight`` is 1 or -1."""
    pieces = [
        F.shiftright(row_hash, _PIECE_BITS * i).bitwiseAND(F.lit((1 << _PIECE_BITS) - 1).cast("long")) for i in range(3)
    ]
    return [F.sum(p if weight is None else p * weight) for p in pieces]


def fold_key(c: Column | str) -> Column:
    """Accent-free, trimmed, upper-case join key."""
    plain = F.translate(F.trim(_as_col(c)), ACCENTED + _SHARP_S, PLAIN + _PLACEHOLDER)
    return F.replace(F.upper(plain), F.lit(_PLACEHOLDER), F.lit(_SHARP_S))


def _latin_letters() -> dict[str, str]:
    """Letters and signs from the Latin blocks whose decomposition has an ASCII
    part, with that part (one or more characters)."""
    found = {}
    for code in [*range(0x80, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if base:
            found[chr(code)] = base
    return found


def fold_ascii(c: Column | str) -> Column:
    """Variant for index sheets: folds any Latin letter to its ASCII base
    letters, drops what is still outside ASCII, and trims last."""
    bases = _latin_letters()
    single = {k: v for k, v in bases.items() if len(v) == 1}
    plain = F.translate(_as_col(c), "".join(single), "".join(single.values()))
    for letter, base in bases.items():
        if len(base) > 1:
            plain = F.replace(plain, F.lit(letter), F.lit(base))
    return F.trim(F.upper(F.regexp_replace(plain, r"[^\x00-\x7F]", "")))


def date_key(c: Column | str) -> Column:
    """Smart integer key YYYYMMDD."""
    d = _as_col(c).cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_of_date_key(c: Column | str) -> Column:
    """First day of the month of a YYYYMMDD key, without a look-up."""
    k = _as_col(c)
    return F.make_date((k / 10000).cast("int"), ((k % 10000) / 100).cast("int"), F.lit(1))


def band_of(rooms: Column | str) -> Column:
    """1D..4D by room count, four or more in one band; none or unknown is the total."""
    r = _as_col(rooms)
    return F.when(r >= 1, F.concat(F.least(r, F.lit(4)).cast("string"), F.lit("D"))).otherwise(
        TOTAL_BAND
    )


def unit_price(value: Column | str, area: Column | str) -> Column:
    """Value per unit of area; NULL where the area is zero or unknown."""
    return _as_col(value).cast("double") / F.nullif(_as_col(area).cast("double"), F.lit(0.0))


def premium(own: Column | str, market: Column | str) -> Column:
    """How far a price lies above (+) or below (-) the market's; NULL without one."""
    return F.when(_as_col(market).isNotNull(), _as_col(own) / _as_col(market) - 1)


def parse_number(c: Column | str) -> Column:
    """Number in a sheet cell; any other text, also a type suffix or a name of
    a value that is not finite, is NULL."""
    cell = _as_col(c).cast("string")
    number = cell.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    value = F.when(number, cell.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def changed(pairs: Iterable[tuple[Column, Column]], null_safe: bool) -> Column:
    """True where any pair differs.

    Plain comparison treats NULL against a value as no change; the null-safe
    one treats it as a change.
    """
    tests = [~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False)) for a, b in pairs]
    return reduce(lambda x, y: x | y, tests, F.lit(False))
