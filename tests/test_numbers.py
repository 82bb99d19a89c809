from decimal import Decimal

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from registra.functions import labels, numbers
from registra.plans import bank
from registra.operators import quality


def test_annuity_matches_published_payments(spark):
    # amount, yearly rate, months, payment
    published = [
        (724929, 22.2, 120, 15082.9),
        (4817698, 23.8, 24, 254236.32),
        (1457325, 15.7, 24, 71146.44),
        (316696, 18.1, 60, 8059.24),
        (2942403, 13.6, 24, 140717.88),
        (2901253, 17.5, 120, 51346.02),
        (4459910, 17.1, 120, 77795.02),
    ]
    credits = spark.createDataFrame(published, "amount bigint, interest_rate double, term_months int, expected double")
    for row in bank.annuities(credits).collect():
        assert row.monthly_payment == row.expected


def test_exact_rounding_goes_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (201, 200), (5, 0), (1, 3)], "a int, b int")
    got = [r[0] for r in df.select(numbers.exact_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("1.01"), None, Decimal("0.33")]


def test_digits_only_takes_the_whole_text(spark):
    texts = ["5", "0", "10", "5\n", "", "pass", "-1", "5.0", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").filter(numbers.digits_only(F.col("t")))
    assert [r.t for r in df.collect()] == ["5", "0", "10"]


def test_text_to_real(spark):
    df = spark.createDataFrame([("1,5",), ("",), ("x",)], "t string")
    fixed = numbers.comma_to_point(F.col("t"))
    lenient = df.select(numbers.text_to_real(fixed, strict=False)).collect()
    assert [r[0] for r in lenient] == [1.5, None, None]
    with pytest.raises(NumberFormatException):
        df.select(numbers.text_to_real(fixed)).collect()
    with pytest.raises(NumberFormatException):
        df.filter("t = ''").select(numbers.text_to_real(fixed, blank_is_null=False)).collect()


def test_labels_of_unknown_codes(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "code string")
    place = labels.code_position(F.col("code"))
    got = df.select(labels.education_level(place), labels.education_base(place), labels.payment_type(F.col("code"))).collect()
    assert [tuple(r) for r in got] == [
        ("бакалавриат", "бюджет", "бюджет"),
        ("магистратура", "контракт", "контракт"),
        ("иное", "иное", "3"),
        ("иное", "иное", None),
    ]


def test_capitalize_is_not_per_word(spark):
    df = spark.createDataFrame([("списание СРЕДСТВ",)], "t string")
    assert df.select(labels.capitalize(F.col("t"))).first()[0] == "Списание средств"


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "id int, name string")
    assert {(r.id, r.n_rows) for r in quality.key_violations(df, ["id"]).collect()} == {(1, 2), (None, 1)}
    parents = spark.createDataFrame([(1,)], "key int")
    assert [tuple(r) for r in quality.orphans(df, "id", parents, "key").collect()] == [(2, 1)]
    assert quality.null_rows(df, ["name"]).count() == 1
    assert [r.id for r in quality.outside_domain(df, "id", [1]).collect()] == [2]
    assert quality.with_defaults(df, {"name": F.lit("-")}).filter("id = 2").first().name == "-"
