"""Numbers and rates (FN-3, FN-4, FN-19..FN-22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelspark.functions.text import strip

_DIGITS = r"\d+(_\d+)*"
NUMBER = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"


def to_double(text: Column) -> Column:
    """Number in the text, NULL when there is none (also for ``inf`` and ``nan``)."""
    text = strip(text)
    return F.when(text.rlike(NUMBER), F.translate(text, "_", "").try_cast("double"))


def to_int(text: Column) -> Column:
    """Like ``to_double``, cut towards zero; NULL beyond 32 bits."""
    return to_double(text).try_cast("int")


def rate(part: Column, whole: Column) -> Column:
    """part / whole to 4 places, rounded half up on exact decimals; NULL when whole is 0."""
    exact = F.try_divide(part.cast("decimal(20,0)"), whole.cast("decimal(20,0)"))
    return F.round(exact, 4).cast("double")


def rate_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(rate(part, whole), F.lit(0.0))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """Unrounded part / whole; 0 when whole is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """part / whole as a percentage to 2 places; 0 when whole is 0."""
    exact = F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)"))
    return F.coalesce(F.round(exact, 2).cast("double"), F.lit(0.0))


def clamp_score(score: Column) -> Column:
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0))


def share_score(good: Column, total: Column) -> Column:
    """good / total as a 0-100 score; an empty table scores 100."""
    return F.when(total == 0, F.lit(100.0)).otherwise(
        clamp_score(F.try_divide(good.cast("double"), total.cast("double")) * 100)
    )
