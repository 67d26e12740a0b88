from datetime import date

import pytest
from pyspark.sql import functions as F

from dimwright.functions import (
    band_of,
    changed,
    date_key,
    fold_ascii,
    fold_key,
    month_of_date_key,
    parse_number,
    premium,
    unit_price,
)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


@pytest.mark.parametrize(
    "text, folded",
    [
        ("  São Paulo ", "SAO PAULO"),
        ("Vitória", "VITORIA"),
        ("ÁÀÂÃÄ çÇ üÜ", "AAAAA CC UU"),
        ("Logroño", "LOGROÑO"),  # outside the table: kept
        ("Straße", "STRAßE"),
        ("", ""),
    ],
)
def test_fold_key(spark, text, folded):
    assert one(spark, fold_key(F.lit(text))) == folded


def test_fold_ascii_folds_any_latin_letter_and_drops_the_rest(spark):
    assert one(spark, fold_ascii(F.lit(" Logroño Ťř ★"))) == "LOGRONO TR"


def test_fold_key_of_null_is_null(spark):
    assert one(spark, fold_key(F.lit(None).cast("string"))) is None


def test_date_key_and_its_month(spark):
    assert one(spark, date_key(F.lit(date(2025, 6, 15)))) == 20250615
    assert one(spark, month_of_date_key(F.lit(20250615))) == date(2025, 6, 1)


@pytest.mark.parametrize("rooms, band", [(0, "Total"), (None, "Total"), (1, "1D"), (4, "4D"), (9, "4D")])
def test_band(spark, rooms, band):
    assert one(spark, band_of(F.lit(rooms).cast("int"))) == band


def test_unit_price_of_zero_area_is_null(spark):
    assert one(spark, unit_price(F.lit(10.0), F.lit(0))) is None
    assert one(spark, unit_price(F.lit(722655.0), F.lit(47))) == 15375.63829787234


def test_premium(spark):
    assert one(spark, premium(F.lit(15375.63829787234), F.lit(13001.78))) == 0.18257948510683453
    assert one(spark, premium(F.lit(1.0), F.lit(None).cast("double"))) is None


def test_parse_number(spark):
    assert one(spark, parse_number(F.lit("."))) is None
    assert one(spark, parse_number(F.lit("12.5"))) == 12.5


def test_changed_null_rules(spark):
    null, value = F.lit(None).cast("string"), F.lit("a")
    assert one(spark, changed([(null, value)], null_safe=False)) is False
    assert one(spark, changed([(null, value)], null_safe=True)) is True
    assert one(spark, changed([(null, null)], null_safe=True)) is False
    assert one(spark, changed([(value, F.lit("b")), (null, value)], null_safe=False)) is True
