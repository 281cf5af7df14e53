"""Date and time expressions over text (Column -> Column).

The same text is read three ways (they differ near midnight for offsets):

* ``parse_timestamp`` (X5): the instant, offset honoured, bad -> null.
* ``local_date`` (X6): the calendar date as written, in the value's own offset.
* ``utc_date`` (X7): the UTC date of the instant.
* ``comparison_date`` (X8): Excel serials 30000..70000, else ``local_date``, else a bare year.

ANSI mode is on, so everything uses ``try_`` forms. A text is brought to one
ISO form first (:func:`iso_text`) and then cast once. Most texts are ISO
already and cost one regex; the rewrites run for the others only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXCEL_EPOCH = "1899-12-30"
_MINUTE = r"([01]?\d|2[0-3]):[0-5]?\d"
_SECOND = r":[0-5]?\d(\.\d+)?"
_ZONE = r"\s*([zZ]|UTC|GMT|[+-]\d{1,2}(:?\d{2})?)"
# a time with an offset has its seconds, as the cast wants it
_ISO = rf"^\d{{4}}-\d{{1,2}}(-\d{{1,2}}([ T]{_MINUTE}({_SECOND}({_ZONE})?)?)?)?$"
# fixed values: month names as exports write them, their usual endings
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_ENDINGS = ("uary", "ruary", "ch", "il", "", "e", "y", "ust", "t(?:ember)?", "ober", "ember", "ember")
_NAME = "(?i:(" + "|".join(_MONTHS) + ")(?:" + "|".join(e for e in _ENDINGS if e) + r")?\.?)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _named_month(c: Column) -> Column:
    """``3 Mar 2026``, ``03-Mar-26`` and ``March 3, 2026`` with the month as a number, year first."""
    ordered = F.regexp_replace(c, rf"^{_NAME}[ -]+(\d{{1,2}}),?[ -]+(\d{{4}})(?!\d)", "$3-$1-$2")
    for year, form in ((r"(\d{4})", "$3-$2-$1"), (r"([0-5]\d|6[0-8])", "20$3-$2-$1"), (r"(\d{2})", "19$3-$2-$1")):
        ordered = F.regexp_replace(ordered, rf"^(\d{{1,2}})[-/ .]+{_NAME}[-/ .,]+{year}(?!\d)", form)
    months = F.array(*[F.lit(m) for m in _MONTHS])

    def numbered(text: Column) -> Column:
        number = F.array_position(months, F.lower(F.regexp_extract(text, r"^\d+-([A-Za-z]{3})-", 1)))
        named = F.concat(F.regexp_extract(text, r"^\d+-", 0), number.cast("string"), F.regexp_extract(text, r"-\d{1,2}(?=$|\D).*$", 0))
        return F.when(number > 0, named).otherwise(text)

    return _let(ordered, numbered)


def _year_first(c: Column) -> Column:
    """Compact, dotted and slashed dates as ``y-m-d``; month first where both readings are dates; years of two digits are 1969 to 2068."""
    steps = (
        (r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3"),
        (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})(?!\d)", "$1-$2-$3"),
        (r"^(1[3-9]|2\d|3[01])[-/.](\d{1,2})[-/.](\d{4}|\d{2})(?!\d)", "$3-$2-$1"),
        (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})(?!\d)", "$3-$1-$2"),
        (r"^([0-5]\d|6[0-8])-", "20$1-"),
        (r"^(\d{2})-", "19$1-"),
    )
    for pattern, form in steps:
        c = F.regexp_replace(c, pattern, form)
    return c


def _clock(c: Column) -> Column:
    """Compact and bare hours, and the twelve-hour clock, as ``h:mm[:ss]``."""
    c = F.regexp_replace(c, r"(?<=-\d{1,2}[T ])(\d{2})(\d{2})(\d{2})?(?=$|[zZ+-])", "$1:$2:$3")
    c = F.regexp_replace(c, r":(?=$|[zZ+-])", "")
    c = F.regexp_replace(c, r"(?<=-\d{1,2}[T ])(\d{1,2})(?=$|[zZ+-]|\s*[AaPp][Mm])", "$1:00")
    half = r"[T ](0?[1-9]|1[0-2])(:\d{1,2}(?::\d{1,2})?)\s*([AaPp])[Mm]"

    def full(text: Column) -> Column:
        hour = F.regexp_extract(text, half, 1).try_cast("int") % 12 + F.when(F.lower(F.regexp_extract(text, half, 3)) == "p", 12).otherwise(0)
        day, zone = F.regexp_extract(text, r"^[^T ]+", 0), F.regexp_extract(text, r"[AaPp][Mm](.*)$", 1)
        return F.when(text.rlike(half), F.concat(day, F.lit("T"), hour.cast("string"), F.regexp_extract(text, half, 2), zone)).otherwise(text)

    return F.regexp_replace(_let(c, full), rf"(?<=[T ]\d{{1,2}}:\d{{1,2}})(?={_ZONE}$)", ":00")


def iso_text(c: Column | str) -> Column:
    """The text of a date or date and time in ISO form, its own offset kept; null if the whole text is neither.

    Read are ISO forms (also compact, with slashes or dots, with the hour
    alone), day and month numbers in either order, month names, the
    twelve-hour clock, and offsets as numbers, Z, UTC or GMT.
    """
    c = F.trim(_c(c).cast("string"))
    rewritten = _let(_clock(_year_first(_named_month(c))), lambda text: F.when(text.rlike(_ISO), text))
    return F.when(c.rlike(_ISO), c).when(c.rlike(r"\d"), rewritten)


def parse_timestamp(c: Column | str) -> Column:
    """Text -> TIMESTAMP (instant); offsets like +0000 and -03:00 accepted; the whole text must be a date."""
    return iso_text(c).try_cast("timestamp")


def local_date(c: Column | str) -> Column:
    """The date as written (own offset kept), not via the UTC instant; null where the instant is."""
    return iso_text(c).try_cast("date")


def utc_date(c: Column | str) -> Column:
    """The UTC calendar date of the instant (session zone is UTC)."""
    return F.to_date(parse_timestamp(c))


def comparison_date(c: Column | str) -> Column:
    """Excel serial (30000..70000, fraction dropped) else the written date."""
    c = F.trim(_c(c).cast("string"))
    serial = F.when(c.rlike(r"^-?\d+(\.\d+)?$"), c.try_cast("double"))
    from_serial = F.when(serial.between(30000, 70000), F.date_add(F.lit(_EXCEL_EPOCH).cast("date"), F.floor(serial).cast("int")))
    year = F.when(c.rlike(r"^\d{4}$"), F.to_date(F.try_to_timestamp(c, F.lit("yyyy"))))
    return F.coalesce(from_serial, local_date(c), year)


def month_token(d: Column | str) -> Column:
    """``yyyy-MM``."""
    return F.date_format(_c(d), "yyyy-MM")


def one_month_back(d: Column | str) -> Column:
    """One calendar month back, day clamped to the month length."""
    return F.add_months(_c(d), -1)


def default_window(run_date: Column | str) -> tuple[Column, Column]:
    """X11: (from, to) = (one month before D-1, D-1) for a run date D."""
    to = F.date_sub(_c(run_date), 1)
    return one_month_back(to), to


def run_date_in_zone(ts: Column | str, zone: str) -> Column:
    """The local calendar date of a UTC instant in ``zone``."""
    return F.to_date(F.from_utc_timestamp(_c(ts), zone))
