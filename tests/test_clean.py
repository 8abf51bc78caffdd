import datetime as dt

import pytest
from pyspark.sql import functions as F

from custvalue import ClvParams
from custvalue.functions.dates import parse_day, parse_moment
from custvalue.operators import baseline, clean, features, metrics
from custvalue.sources import schemas

P = ClvParams(threshold_date="2011-08-08", predict_end="2011-12-12", max_monetary=15000.0)


def lines(spark, *rows):
    """Rows of (customer, date text, quantity, price)."""
    full = [("1", "s", None, qty, day, price, customer, "x") for customer, day, qty, price in rows]
    return spark.createDataFrame(full, schemas.TRANSACTIONS)


def good(customer):
    """Two qualifying days and a recent one."""
    return [
        (customer, "01/05/11 08:00", 2, 10.0),
        (customer, "03/05/11 09:30", 1, 20.0),
        (customer, "11/20/11 10:00", 3, 5.0),
    ]


def cleaned(spark, *rows, params=P):
    out = clean.clean_orders(lines(spark, *rows), params).collect()
    return {(r.customer_id, r.order_date): (r.order_value, r.order_qty_articles) for r in out}


@pytest.mark.parametrize(
    "text,day",
    [
        ("12/01/68", dt.date(2068, 12, 1)),
        ("12/01/69", dt.date(1969, 12, 1)),
        ("02/29/96", dt.date(1996, 2, 29)),
        ("02/29/00", dt.date(2000, 2, 29)),
        ("1/2/10", dt.date(2010, 1, 2)),
    ],
)
def test_two_digit_years(spark, text, day):
    row = spark.range(1).select(
        parse_day(F.lit(text)).alias("d"), parse_moment(F.lit(text + " 9:05")).alias("m")
    ).first()
    assert row.d == day
    assert row.m == dt.datetime.combine(day, dt.time(9, 5))


def test_null_customer_is_left_out(spark):
    got = cleaned(spark, *good("a"), *good(None))
    assert {c for c, _ in got} == {"a"}


def test_day_rollup_and_rounding(spark):
    rows = good("a") + [("a", "01/05/11 17:00", 3, 0.333), ("a", "01/05/11 18:00", 1, 0.006)]
    # 20 + 0.999 + 0.006 = 21.005, half away from zero.
    assert cleaned(spark, *rows)["a", dt.date(2011, 1, 5)] == (21.01, 6)


def test_differently_written_dates_are_one_day(spark):
    got = cleaned(spark, *good("a"), ("a", "1/5/11 7:00", 1, 1.0))
    assert got["a", dt.date(2011, 1, 5)] == (21.0, 3)


def test_one_positive_day_is_not_enough(spark):
    rows = [
        ("a", "01/05/11 08:00", 2, 10.0),
        ("a", "03/05/11 08:00", -1, 10.0),
        ("a", "11/20/11 08:00", 3, 5.0),
    ]
    assert cleaned(spark, *rows) == {}


def test_threshold_day_counts_for_features_only(spark):
    rows = [
        ("a", "01/05/11 08:00", 2, 10.0),
        ("a", "08/08/11 08:00", 1, 10.0),
        ("a", "11/20/11 08:00", 3, 5.0),
    ]
    assert cleaned(spark, *rows) == {}
    got = clean.clean_orders(lines(spark, *rows, ("a", "02/05/11 08:00", 1, 1.0)), P)
    row = features.features_rfm(got, P).first()
    assert row.cnt_orders == 3
    assert row.recency == (dt.date(2011, 8, 8) - dt.date(2011, 1, 5)).days


def test_inactive_customer_is_dropped_and_late_orders_pass(spark):
    quiet = [("q", d, 1, 10.0) for d in ("01/05/11 08:00", "02/05/11 08:00", "09/12/11 08:00")]
    edge = [("e", d, 1, 10.0) for d in ("01/05/11 08:00", "02/05/11 08:00", "09/13/11 08:00")]
    late = [("l", d, 1, 10.0) for d in ("01/05/11 08:00", "02/05/11 08:00", "01/01/12 08:00")]
    assert {c for c, _ in cleaned(spark, *quiet, *edge, *late)} == {"e", "l"}


def test_return_counts_for_activity_but_mixed_signs_go(spark):
    rows = [
        ("a", "01/05/11 08:00", 2, 10.0),
        ("a", "03/05/11 09:30", 1, 20.0),
        ("a", "05/05/11 09:30", 4, 0.0),
        ("a", "06/05/11 09:30", -1, 20.0),
        ("a", "11/20/11 10:00", -2, 0.0),
    ]
    days = {d for _, d in cleaned(spark, *rows)}
    assert days == {dt.date(2011, 1, 5), dt.date(2011, 3, 5), dt.date(2011, 6, 5)}


def test_small_value_counts_as_return(spark):
    got = clean.clean_orders(lines(spark, *good("a"), ("a", "04/05/11 08:00", 1, 0.5)), P)
    row = features.features_n_target(got, P).first()
    assert (row.cnt_returns, row.has_returned) == (1, 1)
    assert row.monetary_dnn == 40.5
    assert row.monetary_btyd == 20.5 / 2
    assert row.target_monetary == 55.5


def test_bad_dates(spark):
    rows = [*good("a"), ("a", "2011-01-05", 1, 1.0)]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|cannot be parsed|could not be parsed"):
        cleaned(spark, *rows)
    lenient = ClvParams("2011-08-08", "2011-12-12", 15000.0, bad_dates="null")
    assert len(cleaned(spark, *rows, params=lenient)) == 3


def test_empty_input(spark):
    none = clean.clean_orders(lines(spark), P)
    predicted = baseline.baseline_predictions(none, P)
    report = metrics.evaluation_report(predicted, "predicted_monetary", "target_monetary").first()
    assert report.n == 0 and report.rmse is None and report.r2 is None


def test_params_are_checked():
    assert P.time_days == 126 and P.time_months == 5
    with pytest.raises(ValueError):
        ClvParams("2011-08-08", "2011-12-12", 1.0, target_window="later")
    with pytest.raises(TypeError):
        ClvParams(20110808, "2011-12-12", 1.0)
