from dimwright.functions.columns import (
    band_of,
    changed,
    date_key,
    fold_ascii,
    fold_key,
    hash_sums,
    month_of_date_key,
    parse_number,
    premium,
    unit_price,
)

__all__ = [
    "band_of",
    "changed",
    "date_key",
    "fold_ascii",
    "fold_key",
    "hash_sums",
    "month_of_date_key",
    "parse_number",
    "premium",
    "unit_price",
]
