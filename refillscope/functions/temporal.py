"""Date and time expressions (E1, S3, X1). All are built-in Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` refers to it.

    An expression holds a copy of each expression that it refers to. Many copies also make generated code too long
    for the JVM to compile, and it runs interpreted; a lambda's variable is a value.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def whole_days(start, end) -> Column:
    """Whole 24-hour spans from ``start`` to ``end`` (a timedelta's ``.days`` for end >= start).

    Counts elapsed days of 24 hours on the wall clock, so 23:00 to 01:00 two calendar days
    later is 1, where ``datediff`` would count 2 midnights. The two values are subtracted as
    TIMESTAMP_NTZ: no time zone is involved, and days on which clocks change have 24 hours.
    """
    elapsed = _col(end).cast("timestamp_ntz") - _col(start).cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), elapsed).cast("bigint")


_TIME = r"(?:[ T](\d{1,2}):(\d{1,2})(?::(\d{1,2}(?:\.\d{1,6})?))?)?"
_DAY_FIRST = rf"^(\d{{1,2}})([/.-])(\d{{1,2}})\2(\d{{4}}|\d{{2}}){_TIME}$"
_ISO = rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}}){_TIME}$"

# Year, month, day, hour, minute and second of either shape, each between separators. A line end, which a shape
# lets follow, stays behind the last one.
_DAY_FIRST_PARTS, _ISO_PARTS = ";$4;$3;$1;$5;$6;$7;", ";$1;$2;$3;$4;$5;$6;"

# Two-digit years from here on are in the 1900s, those before in the 2000s.
CENTURY_PIVOT = 69


def parse_day_first(c) -> Column:
    """Parse day-first text (``01/02/2022``, ``1-2-2022``, ``01.02.22``, optional ``H:m[:s]``) to TIMESTAMP_NTZ.

    ISO text (``2022-02-01[ 10:00:00]``) is accepted too. Unparseable text, a bare number or
    an impossible date gives NULL, so the ingest layer can route the row to the rejects. No
    time zone is involved: the wall-clock value is kept as written.
    """

    return computed_once(computed_once(F.trim(_col(c).cast("string")), lambda text: _parts(text, _day_first(text))), _moment)


def day_first_steps(c, name: str) -> list[dict[str, Column]]:
    """``parse_day_first`` into the column ``name`` by columns to be added one step after the other."""
    text, ordered, parts = (f"_{name}_{step}" for step in ("text", "ordered", "parts"))
    return [
        {text: F.trim(_col(c).cast("string"))},
        {ordered: _day_first(F.col(text))},
        {parts: _parts(F.col(text), F.col(ordered))},
        {name: _moment(F.col(parts))},
    ]


def _day_first(text: Column) -> Column:
    """The parts of day-first text between separators; other text is returned as it is."""
    return F.regexp_replace(text, _DAY_FIRST, _DAY_FIRST_PARTS)


def _parts(text: Column, ordered: Column) -> Column:
    """The parts as an array; no text that ``_day_first`` changes equals its parts, which begin with a separator."""
    iso = F.when(text.rlike(_ISO), F.split(F.regexp_replace(text, _ISO, _ISO_PARTS), ";"))
    return F.when(ordered != text, F.split(ordered, ";")).otherwise(iso)


def _moment(found: Column) -> Column:
    def part(i: int) -> Column:
        return F.when(F.get(found, F.lit(i)) != "", F.get(found, F.lit(i)))

    years = part(1).cast("int")
    century = F.when(years < CENTURY_PIVOT, 2000).otherwise(1900)
    return F.try_make_timestamp_ntz(
        years=F.when(F.length(part(1)) == 2, years + century).otherwise(years),
        months=part(2).cast("int"),
        days=part(3).cast("int"),
        hours=F.coalesce(part(4).cast("int"), F.lit(0)),
        mins=F.coalesce(part(5).cast("int"), F.lit(0)),
        secs=F.coalesce(part(6).cast("decimal(16,6)"), F.lit(0).cast("decimal(16,6)")),
    )


def format_day_first(c) -> Column:
    """Render a date/timestamp as ``dd/MM/yyyy`` for the export files (X1), without a time zone."""
    day = _col(c).cast("date")
    parts = (F.lpad(F.dayofmonth(day).cast("string"), 2, "0"), F.lpad(F.month(day).cast("string"), 2, "0"), F.lpad(F.year(day).cast("string"), 4, "0"))
    return F.when(day.isNotNull(), F.concat_ws("/", *parts))
