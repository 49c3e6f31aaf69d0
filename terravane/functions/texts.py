"""Text, time-key and score expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and the letters they fold to.
MARKED = "áàâäãéèêëíìîïóòôöõúùûüñç"
PLAIN = "aaaaaeeeeiiiiooooouuuunc"


def fold(value: Column) -> Column:
    """Lower case, without marks, runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.translate(F.lower(value), MARKED, PLAIN), r"\s+", " "))


def time_key(value: Column, upper: bool = False) -> Column:
    """yyyy-MM-ddTHH:mm:ss for a full or partial date; the start, or with upper the end, of the period it names.

    February ends on day 29 whatever the year, because keys are compared as strings. Null if it is no date.
    """
    text = F.trim(value)
    pattern = r"^(\d{4})(?:-(\d{2})(?:-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2}))?)?)?)?"
    parts = F.array(*(F.nullif(F.regexp_extract(text, pattern, i), F.lit("")) for i in range(1, 7)))

    def key(p: Column, month: Column, day: Column) -> Column:
        clock = [F.coalesce(p[i], F.lit(x)) for i, x in ((3, "23" if upper else "00"), (4, "59" if upper else "00"), (5, "59" if upper else "00"))]
        said = F.concat(p[0], F.lit("-"), month, F.lit("-"), day, F.lit("T"), clock[0], F.lit(":"), clock[1], F.lit(":"), clock[2])
        return F.when(month.between("01", "12") & day.between("01", "31"), said)

    def with_day(p: Column, month: Column) -> Column:
        last = F.when(month == "02", "29").when(month.isin("04", "06", "09", "11"), "30").otherwise("31")
        return once(F.coalesce(p[2], last if upper else F.lit("01")), lambda day: key(p, month, day))

    return once(parts, lambda p: once(F.coalesce(p[1], F.lit("12" if upper else "01")), lambda month: with_day(p, month)))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for each row however often body names it."""
    return F.transform(F.array(value), body)[0]


def band(value: Column, steps: list[tuple[float, str]], rest: str) -> Column:
    """The name of the first step that value reaches, steps from the highest down."""
    out = None
    for least, name in steps:
        out = F.when(value >= least, name) if out is None else out.when(value >= least, name)
    return out.otherwise(rest)


def reasons(*checks: tuple[Column, str]) -> Column:
    """The texts of all checks that hold, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(t)) for c, t in checks)))


def tokens(text: Column) -> Column:
    """A rough count of model tokens: a token for every four characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.char_length(text) / 4)).cast("long")


def hours(later: Column, earlier: Column) -> Column:
    """Hours from one timestamp to another, exact to the microsecond."""
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))).cast("double") / 3.6e9
