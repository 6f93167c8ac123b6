"""Advice and display texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farekit.functions.rules import PEAK_SLOTS, banded

# Insight by lead time; the first band also shows an amount.
LAST_MINUTE_LIMIT = 3
LAST_MINUTE_SHARE = 0.4
LAST_MINUTE_TEXT = "🔴 Last minute booking! Prices are %.0f higher than average."
INSIGHT_BANDS = (
    (7, "🟠 Booking within a week. Consider booking earlier for better prices."),
    (14, "🟡 Decent booking window. Prices are near average."),
    (30, "🟢 Good booking time! Prices are competitive."),
    (60, "🟢 Great! Early booking discount applied."),
)
INSIGHT_BEYOND = "🌟 Excellent! Maximum early bird discount (~15% off)."

# Price trend by lead time.
TREND_BANDS = (
    (7, "Prices will likely increase as departure approaches"),
    (21, "Prices are relatively stable in this booking window"),
)
TREND_BEYOND = "Book now to lock in lower prices before they rise"

# Savings tips.
TIP_EARLY = "💡 Booking 30+ days in advance could save ₹%d"
TIP_BUSINESS = "💡 Business class fares may drop 2-3 weeks before departure"
TIP_PEAK = "💡 Early morning or night flights are typically 10-15% cheaper"
TIP_SEPARATOR = " | "

# Confidence by r².
CONFIDENCE_TOP = (0.9, "Very High (R² > 0.9)")
CONFIDENCE_HIGH = (0.8, "High (R² > 0.8)")
CONFIDENCE_REST = "Moderate"


def booking_insight(days: Column, price: Column) -> Column:
    surcharge = F.format_string(LAST_MINUTE_TEXT, F.bround(price * LAST_MINUTE_SHARE))
    return F.when(days <= LAST_MINUTE_LIMIT, surcharge).otherwise(banded(days, INSIGHT_BANDS, INSIGHT_BEYOND))


def price_trend(days: Column) -> Column:
    return banded(days, TREND_BANDS, TREND_BEYOND)


def savings_tip(cabin: Column, days: Column, slot: Column) -> Column:
    """All tips that apply, joined; null when none does."""
    saved = (F.lit(500) + days * 50).cast("bigint")
    tips = F.concat_ws(
        TIP_SEPARATOR,
        F.when(days < 30, F.format_string(TIP_EARLY, saved)),
        F.when((cabin == "Business") & (days > 45), TIP_BUSINESS),
        F.when(slot.isin(*PEAK_SLOTS), TIP_PEAK),
    )
    return F.nullif(tips, F.lit(""))


def confidence(r2: Column) -> Column:
    return (
        F.when(r2 > CONFIDENCE_TOP[0], CONFIDENCE_TOP[1])
        .when(r2 > CONFIDENCE_HIGH[0], CONFIDENCE_HIGH[1])
        .otherwise(CONFIDENCE_REST)
    )


def money(amount: Column) -> Column:
    """Whole rupees with thousands separators, halves to even."""
    return F.concat(F.lit("₹"), F.format_number(F.bround(amount), 0))


def plain_money(amount: Column) -> Column:
    """Whole rupees without separators, halves to even."""
    return F.format_string("₹%.0f", F.bround(amount))


def share(fraction: Column) -> Column:
    """A fraction as a percentage with one decimal."""
    return F.format_string("%.1f%%", F.bround(fraction * 100, 1))


def clean_label(label: Column) -> Column:
    return F.translate(label, "_", " ")
