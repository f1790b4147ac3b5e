"""Calendar parts of a timestamp, as a name -> Column mapping for ``withColumns``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def calendar_parts(ts: Column, base: str) -> dict[str, Column]:
    """Year to hour, ISO week and three flags.

    A missing time gives NULL parts but 0 flags: a flag states "is known to be",
    and nothing is known of a missing time.
    """
    weekday, day = F.weekday(ts), F.dayofmonth(ts)
    flag = lambda condition: F.coalesce(condition.cast("int"), F.lit(0))
    return {
        f"{base}__year": F.year(ts),
        f"{base}__month": F.month(ts),
        f"{base}__day": day,
        f"{base}__dayofweek": weekday,
        f"{base}__hour": F.hour(ts),
        f"{base}__weekofyear": F.weekofyear(ts),
        f"{base}__is_weekend": flag(weekday >= 5),
        f"{base}__is_month_start": flag(day == 1),
        f"{base}__is_month_end": flag(day == F.dayofmonth(F.last_day(ts))),
    }


def short_date_parts(ts: Column, base: str) -> dict[str, Column]:
    """The five exploratory parts with their short names."""
    return {
        f"{base}_year": F.year(ts),
        f"{base}_month": F.month(ts),
        f"{base}_day": F.dayofmonth(ts),
        f"{base}_dow": F.weekday(ts),
        f"{base}_hour": F.hour(ts),
    }
