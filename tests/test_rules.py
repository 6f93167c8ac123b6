"""Rules at their boundaries and on null."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farekit.functions import rules, texts


def values(rows_of, kind, inputs, rule):
    return [row[0] for row in rows_of(f"x {kind}", [(v,) for v in inputs], rule(F.col("x")))]


DAYS = [0, 3, 4, 7, 8, 14, 15, 21, 22, 29, 30, 31, 60, 61, 90, None]


def test_booking_urgency(rows_of):
    expected = [5.0, 5.0, 3.5, 3.5, 2.0, 2.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.5, 0.5, 0.2, 0.2, 0.2]
    assert values(rows_of, "int", DAYS, rules.booking_urgency) == expected


def test_advance_factor(rows_of):
    expected = [1.5, 1.5, 1.3, 1.3, 1.15, 1.15, 1.0, 1.0, 1.0, 1.0, 1.0, 0.9, 0.9, 0.85, 0.85, 0.85]
    assert values(rows_of, "int", DAYS, rules.advance_factor) == expected


def test_booking_class(rows_of):
    found = dict(zip(DAYS, values(rows_of, "int", DAYS, rules.booking_class), strict=True))
    assert [found[d] for d in (0, 7)] == ["Last_Minute"] * 2
    assert [found[d] for d in (8, 14, 29)] == ["Normal"] * 3
    assert [found[d] for d in (30, 90)] == ["Advance"] * 2


def test_season_and_factor_for_every_month(rows_of):
    months = list(range(1, 13))
    assert values(rows_of, "int", months, rules.season) == (
        ["Winter"] * 2 + ["Summer"] * 3 + ["Monsoon"] * 4 + ["Post_Monsoon"] * 2 + ["Winter"]
    )
    assert values(rows_of, "int", months, rules.seasonal_factor) == [
        1.25, 1.05, 1.05, 1.2, 1.2, 1.2, 0.85, 0.85, 1.05, 1.3, 1.3, 1.25,
    ]
    assert values(rows_of, "int", months, rules.quarter_of) == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]


def test_weekday_rules(rows_of):
    week = [dt.date(2025, 6, 2) + dt.timedelta(days=i) for i in range(7)]  # Monday first
    assert values(rows_of, "date", week, rules.weekday_factor) == [1.1, 1.0, 1.0, 1.0, 1.2, 1.25, 1.25]
    assert values(rows_of, "date", week, rules.weekend_flag) == [0, 0, 0, 0, 0, 1, 1]
    assert values(rows_of, "date", week, rules.day_name)[::6] == ["Monday", "Sunday"]


def test_flags_give_values_for_null(rows_of):
    assert values(rows_of, "string", ["zero", "one", "two_or_more", "?", None], rules.stop_count) == [0, 1, 2, 2, 2]
    assert values(rows_of, "string", ["Morning", "Evening", "Night", None], rules.peak_flag) == [1, 1, 0, 0]
    assert values(rows_of, "string", ["Economy", "Premium_Economy", None], rules.class_flag) == [0.0, 1.0, 1.0]


def test_route_is_null_when_a_city_is(rows_of):
    rows = [("A", "B"), ("A", None), (None, "B")]
    key, label = rules.route_key(F.col("a"), F.col("b")), rules.route_label(F.col("a"), F.col("b"))
    assert rows_of("a string, b string", rows, key, label) == [("A-B", "A → B"), (None, None), (None, None)]


def test_truncate_goes_toward_zero(rows_of):
    assert values(rows_of, "double", [2.9, -2.9, 0.0, None], rules.truncate) == [2, -2, 0, None]


def test_round_to_tens_takes_even_on_ties(rows_of):
    assert values(rows_of, "double", [25.0, 35.0, 24.9, 35.1, None], rules.round_to_tens) == [20, 40, 20, 40, None]


def test_price_cap(rows_of):
    rows = [(1, "Economy"), (99999, "Economy"), (1, "Premium_Economy"), (99999, "Premium_Economy"),
            (1, "Business"), (99999, "Business"), (1, None), (9000, "Business"), (None, "Economy")]
    capped = rows_of("p int, c string", rows, rules.cap_price(F.col("p"), F.col("c")))
    assert [c for (c,) in capped] == [1500, 25000, 3000, 40000, 8000, 60000, 8000, 9000, None]


def test_clamp_keeps_null(rows_of):
    given = [0.1, 0.3, 1.0, 1.5, 2.0, None]
    assert values(rows_of, "double", given, rules.clamp_multiplier) == [0.3, 0.3, 1.0, 1.5, 1.5, None]


def test_ratio_of_zero_baseline_is_null(rows_of):
    ratio = rules.price_ratio(F.col("p"), F.col("b"))
    assert rows_of("p double, b double", [(6.0, 3.0), (1.0, 0.0), (1.0, None)], ratio) == [(2.0,), (None,), (None,)]


@pytest.mark.parametrize(
    ("text", "date"),
    [
        ("2025-02-03", dt.date(2025, 2, 3)),
        ("2025-2-3", dt.date(2025, 2, 3)),
        ("2025-13-01", None),
        ("2025-02-30", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_strict_date(rows_of, text, date):
    assert values(rows_of, "string", [text], rules.parse_date) == [date]


def test_insight_and_trend_bands(rows_of):
    both = rows_of("d int, p double", [(d, 1000.0) for d in DAYS[:-1]],
                   texts.booking_insight(F.col("d"), F.col("p")), texts.price_trend(F.col("d")))
    found = dict(zip(DAYS, both, strict=False))
    assert found[3][0] == "🔴 Last minute booking! Prices are 400 higher than average."
    assert found[4][0] == found[7][0] != found[8][0] == found[14][0] != found[15][0] == found[30][0]
    assert found[31][0] == found[60][0] != found[61][0] == found[90][0]
    assert found[7][1] != found[8][1] == found[21][1] != found[22][1]


def test_savings_tips(rows_of):
    rows = [("Business", 46, "Night"), ("Business", 10, "Morning"), ("Economy", 30, "Night"), ("Economy", 29, "Night")]
    tip = texts.savings_tip(F.col("c"), F.col("d"), F.col("s"))
    found = [t for (t,) in rows_of("c string, d int, s string", rows, tip)]
    assert found[0] == texts.TIP_BUSINESS
    assert found[1] == "💡 Booking 30+ days in advance could save ₹1000 | " + texts.TIP_PEAK
    assert found[2] is None
    assert found[3] == "💡 Booking 30+ days in advance could save ₹1950"


def test_confidence_and_display(rows_of):
    assert values(rows_of, "double", [0.91, 0.9, 0.81, 0.8, 0.1], texts.confidence) == [
        "Very High (R² > 0.9)", "High (R² > 0.8)", "High (R² > 0.8)", "Moderate", "Moderate",
    ]
    assert values(rows_of, "double", [7271.4, 1234567.5], texts.money) == ["₹7,271", "₹1,234,568"]
    assert values(rows_of, "double", [7271.4], texts.plain_money) == ["₹7271"]
    assert values(rows_of, "double", [0.123], texts.share) == ["12.3%"]
    assert values(rows_of, "string", ["two_or_more"], texts.clean_label) == ["two or more"]
