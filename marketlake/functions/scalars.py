"""Scalar functions over columns; all stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.fixed import PREFIX


def number(c: Column | str) -> Column:
    """A decimal string as double; NULL for what is no number, NaN included. A zero is a value."""
    d = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(~F.isnan(d), d)


def whole(c: Column | str) -> Column:
    """A text as bigint; NULL for what is no whole number."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("bigint")


def number_or_zero(c: Column | str) -> Column:
    return F.coalesce(number(c), F.lit(0.0))


def first_value(*cs: Column) -> Column:
    """The first non-NULL of numbers; zero counts."""
    return F.coalesce(*cs)


def first_text(*cs: Column | str) -> Column:
    """The first text that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cs])


def seconds_to_ms(c: Column) -> Column:
    return c * F.lit(1000).cast("long")


def ms_to_seconds(c: Column) -> Column:
    """Whole seconds, rounded down."""
    return F.floor(c / F.lit(1000)).cast("long")


def iso_to_ms(c: Column | str) -> Column:
    """ISO-8601 text as epoch milliseconds, cut off, never rounded; NULL if it is no time."""
    return F.unix_millis(F.try_to_timestamp(F.col(c) if isinstance(c, str) else c))


def day_to_ms(day: str) -> Column:
    """UTC midnight of a YYYY-MM-DD literal."""
    return F.unix_millis(F.to_timestamp(F.lit(f"{day}T00:00:00Z")))


def timestamp(ms: Column | str) -> Column:
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def year_of(ms: Column | str) -> Column:
    return F.year(timestamp(ms))


def month_of(ms: Column | str) -> Column:
    return F.month(timestamp(ms))


def year_month(ms: Column | str) -> Column:
    return F.date_format(timestamp(ms), "yyyy-MM")


def day_of(ms: Column | str) -> Column:
    return F.date_format(timestamp(ms), "yyyy-MM-dd")


def stripped(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"^\s+|\s+$", "")


def joined(c: Column | str, separator: str = ", ") -> Column:
    """An array's texts joined; '' for NULL."""
    return F.concat_ws(separator, c)


def spellings(series: Column | str) -> Column:
    """Both spellings of a series, its own first: with and without the prefix."""
    s = F.col(series) if isinstance(series, str) else series
    other = F.when(s.startswith(PREFIX), F.substring(s, len(PREFIX) + 1, 1 << 30)).otherwise(F.concat(F.lit(PREFIX), s))
    return F.when(s.startswith(PREFIX), F.array(s, other)).otherwise(F.array(other, s))


def series_of_market(ticker: Column | str, known: Iterable[str]) -> Column:
    """The known series that a market ticker belongs to (it, or it and a dash, begin the ticker), else the text before
    the first dash. Old spellings stay as they are."""
    t = F.col(ticker) if isinstance(ticker, str) else ticker
    hits = [F.when((t == s) | t.startswith(f"{s}-"), F.lit(s)) for s in known]
    return F.coalesce(*hits, F.split_part(t, F.lit("-"), F.lit(1)))


def series_of_event(event: Column | str) -> Column:
    """The series of an event ticker: without its last dash and what follows, in the newer spelling."""
    e = F.regexp_replace(F.col(event) if isinstance(event, str) else event, r"-[^-]*$", "")
    return F.when(e.startswith(PREFIX), e).otherwise(F.concat(F.lit(PREFIX), e))


def volume_text(c: Column | str) -> Column:
    """A volume for reports: whole numbers without decimals."""
    v = F.col(c) if isinstance(c, str) else c
    return F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(v.cast("string"))
