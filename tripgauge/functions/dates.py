"""Dates written by people, read by built-in expressions.

``lenient_time`` takes a text apart into a time of day, an offset, a weekday and what is
left, the date. The date is one to three numbers, one of which may be the name of a month.
Which number is what follows from its size and place: a number above 31 or of more than
two digits is a year; among the others the month comes first, unless it is above 12.
Parts that are missing are those of a given default day, at midnight.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of months and weekdays, by the letters that tell them apart.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
WEEKDAY = (
    "(mon(?:day)?|tue(?:s(?:day)?)?|wed(?:nesday)?|thu(?:rs(?:day)?)?|fri(?:day)?"
    "|sat(?:urday)?|sun(?:day)?)"
)
HALF = r"(?:\s*([ap])\.?m?\b\.?)"
CLOCK = rf"(?<![\d:.])(\d{{1,2}}):(\d{{2}})(?::(\d{{2}})(?:[.,](\d{{1,9}}))?)?(?![\d:]){HALF}?"
HOUR = rf"(?<![\d:./-])(\d{{1,2}}){HALF}"
OFFSET = r"(?<=[\dm.])\s*(?:(z|utc|gmt)|([+-])(\d{2}):?(\d{2})?)$"
# A two-digit year is the one nearest to the default day's, at most this far ahead.
YEARS_AHEAD = 50
# The last whole year that a timestamp can hold.
LAST_YEAR = 294_246


def _number(text: Column) -> Column:
    return text.try_cast("int")


def _nonempty(text: Column) -> Column:
    return F.when(text != "", text)


def _word(name: str) -> str:
    return rf"(?<![a-z]){name}(?![a-z])"


def _full_year(year: Column, digits: Column, default: Column) -> Column:
    """Two digits stand for the year within fifty of the default's."""
    this = F.year(default)
    near = year + (this - this % 100)
    nearest = (
        F.when(near >= this + YEARS_AHEAD, near - 100).when(near < this - YEARS_AHEAD, near + 100).otherwise(near)
    )
    return F.when(digits > 2, year).otherwise(nearest)


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _offset(text: Column) -> Column:
    """``offset``, the microseconds ahead of UTC or null, and the text without it as ``rest``."""
    sign = F.when(F.regexp_extract(text, OFFSET, 2) == "-", -1).otherwise(1)
    hours, minutes = (F.coalesce(_number(F.regexp_extract(text, OFFSET, i)), F.lit(0)) for i in (3, 4))
    ahead = sign * (hours * 60 + minutes).cast("long") * 60_000_000
    stated = text.contains(":") & F.regexp_like(text, F.lit(OFFSET))
    return F.struct(
        F.when(stated, ahead).alias("offset"),
        F.when(stated, F.regexp_replace(text, OFFSET, "")).otherwise(text).alias("rest"),
    )


def _clock(text: Column) -> Column:
    """``micros`` since midnight, null where the time is none, ``timed`` where there is a time,
    and the text without it as ``rest``."""
    timed = F.regexp_like(text, F.lit(CLOCK))
    short = ~timed & F.regexp_like(text, F.lit(HOUR))

    def part(index: int) -> Column:
        return _nonempty(F.regexp_extract(text, CLOCK, index))

    fraction = F.coalesce(F.substring(F.rpad(part(4), 9, "0"), 1, 6).try_cast("long"), F.lit(0))
    read = F.struct(
        _number(F.when(short, F.regexp_extract(text, HOUR, 1)).otherwise(part(1))).alias("hour"),
        F.when(short, F.regexp_extract(text, HOUR, 2)).otherwise(part(5)).alias("half"),
        F.coalesce(_number(part(2)), F.lit(0)).alias("minute"),
        F.coalesce(_number(part(3)), F.lit(0)).alias("second"),
    )

    def of_day(r: Column) -> Column:
        hour = (
            # A bare "14pm" says the same twice; with minutes it is no time.
            F.when(r["half"].isNull() | short & (r["hour"] > 12), F.when(r["hour"] < 24, r["hour"]))
            .when(r["hour"] <= 12, r["hour"] % 12 + F.when(r["half"] == "p", 12).otherwise(0))
        )
        seconds = (hour.cast("long") * 60 + r["minute"]) * 60 + r["second"]
        return F.when((r["minute"] < 60) & (r["second"] < 60), seconds * 1_000_000 + fraction)

    rest = F.when(timed, F.regexp_replace(text, CLOCK, " ")).when(short, F.regexp_replace(text, HOUR, " "))
    return F.struct(
        F.when(timed | short, _with(read, of_day)).otherwise(F.lit(0)).alias("micros"),
        (timed | short).alias("timed"),
        F.coalesce(rest, text).alias("rest"),
    )


def _tokens(text: Column) -> Column:
    """The numbers of a date, how many of them come before the month's name, the name's month,
    and whether nothing else is left over."""
    named = F.substring(F.regexp_extract(text, _word(MONTH), 1), 1, 3)
    before = F.regexp_extract(text, rf"^(.*?){_word(MONTH)}", 1)
    left = F.regexp_replace(F.regexp_replace(text, _word(MONTH), " "), r"(\d)(?:st|nd|rd|th)(?![a-z])", "$1")
    left = F.regexp_replace(left, r"(?<![a-z])(?:of|at|on|and)(?![a-z])|[\d\s,;./-]", "")
    names = F.size(F.regexp_extract_all(text, F.lit(_word(MONTH)), F.lit(1)))
    numbers = F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))
    return F.struct(
        F.array_position(F.array(*[F.lit(m) for m in MONTHS]), named).cast("int").alias("named"),
        F.size(F.regexp_extract_all(before, F.lit(r"(\d+)"), F.lit(1))).alias("before"),
        F.transform(numbers, _number).alias("n"),
        F.transform(numbers, F.length).alias("digits"),
        ((left == "") & (names <= 1)).alias("clear"),
    )


def _fields(t: Column) -> Column:
    """Which number is the year, which the month and which the day; null where that is open."""
    n, digits = ([F.get(t[c], F.lit(i)) for i in range(3)] for c in ("n", "digits"))
    count = F.size(t["n"])
    none = F.lit(None).cast("int")

    def is_year(i: int) -> Column:
        return (digits[i] > 2) | (n[i] > 31)

    def fields(year: int | None, month: int | None, day: int | None) -> Column:
        return F.struct(
            (none if year is None else n[year]).alias("year"),
            (none if year is None else digits[year]).alias("digits"),
            (none if month is None else n[month]).alias("month"),
            (none if day is None else n[day]).alias("day"),
        )

    alone = F.when(is_year(0), fields(0, None, None)).otherwise(fields(None, None, 0))
    # "6 may 26" and "may 6 26" end in the year, "26 6 may" begins with it.
    leads = is_year(0) | (t["before"] == 2) & ~is_year(1)
    with_name = F.when(leads, fields(0, None, 1)).otherwise(fields(1, None, 0))
    two = (
        F.when(is_year(0), fields(0, 1, None))
        .when(is_year(1), fields(1, 0, None))
        .when(n[0] > 12, fields(None, 1, 0))
        .otherwise(fields(None, 0, 1))
    )
    three = (
        F.when(is_year(0) & (n[1] > 12), fields(0, 2, 1))
        .when(is_year(0), fields(0, 1, 2))
        .when(n[0] > 12, fields(2, 1, 0))
        .when(n[1] <= 31, fields(2, 0, 1))
    )
    return (
        F.when(count == 0, fields(None, None, None))
        .when(count == 1, alone)
        .when(count == 2, F.when(t["named"] > 0, with_name).otherwise(two))
        .when((count == 3) & (t["named"] == 0), three)
    )


def _date(tokens: Column, default: Column) -> Column:
    """The date, null where there is none, and ``day_given``."""

    def first_day(f: Column) -> Column:
        month = F.coalesce(F.when(tokens["named"] > 0, tokens["named"]), f["month"], F.month(default))
        year = F.coalesce(_full_year(f["year"], f["digits"], default), F.year(default))
        # Beyond it try_make_timestamp fails instead of giving null.
        held = F.when(year <= LAST_YEAR, year)
        first = F.try_make_timestamp(held, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date")
        return F.struct(first.alias("first"), f["day"].alias("day"), f.isNotNull().alias("known"))

    def whole(m: Column) -> Column:
        # The default's day gives way in a month that is too short for it; a given one doesn't.
        longest = F.dayofmonth(F.last_day(m["first"]))
        day = F.coalesce(m["day"], F.least(F.dayofmonth(default), longest))
        sound = tokens["clear"] & m["known"] & (day >= 1) & (day <= longest)
        return F.struct(
            F.when(sound, F.date_add(m["first"], day - 1)).alias("date"), m["day"].isNotNull().alias("day_given"))

    return _with(_fields(tokens), lambda f: _with(first_day(f), whole))


def _weekday(text: Column) -> Column:
    """``weekday`` from 1 for Monday, 0 without one, and the text without it as ``rest``."""
    name = F.substring(F.regexp_extract(text, _word(WEEKDAY), 1), 1, 3)
    rest = F.regexp_replace(text, _word(WEEKDAY) + r"\.?", " ")
    return F.struct(
        F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), name).cast("int").alias("weekday"),
        # Also without the letter between a date and its time.
        F.regexp_replace(rest, r"(?<=\d)t\s*$", " ").alias("rest"),
    )


def lenient_time(text: Column, default: Column) -> Column:
    """Timestamp from a date as people write it, null where it is none.

    Read are numeric dates by ``/``, ``-``, ``.`` or spaces, dates with an English month,
    ordinals, a weekday (the next such day, where no day is given), ``HH:MM[:SS[.ffffff]]``
    or a bare hour with am or pm, and a closing Z, UTC, GMT or ``+HH[:MM]`` after a time.
    Two-digit years lie within fifty of ``default``, whose day stands in for what is
    missing. Null, empty and undecipherable text give null, as do impossible dates and
    years beyond ``LAST_YEAR``."""

    def joined(o: Column, c: Column, w: Column, d: Column) -> Column:
        ahead = F.when((w["weekday"] > 0) & ~d["day_given"], (w["weekday"] + 6 - F.weekday(d["date"])) % 7)
        day = F.date_add(d["date"], F.coalesce(ahead, F.lit(0)))
        local = F.timestamp_micros(F.unix_micros(day.cast("timestamp")) + c["micros"])
        in_utc = F.timestamp_micros(F.unix_date(day).cast("long") * 86_400_000_000 + c["micros"] - o["offset"])
        something = c["timed"] | (w["weekday"] > 0) | F.regexp_like(w["rest"], F.lit(r"[a-z\d]"))
        return F.when(something, F.when(o["offset"].isNull(), local).otherwise(in_utc))

    return _with(F.lower(F.trim(text)), lambda clean: _with(_offset(clean), lambda o: _with(
        _clock(o["rest"]), lambda c: _with(_weekday(c["rest"]), lambda w: _with(
            _tokens(w["rest"]), lambda t: _with(_date(t, default), lambda d: joined(o, c, w, d)))))))
