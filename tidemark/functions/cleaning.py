"""Cleaning expressions. Each takes and gives a Column; NULL in gives NULL out unless said."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DEL = "\x7f"
NOT_DIGIT = "[^0-9]"


def clean_text(x: Column) -> Column:
    """Trim spaces, drop the first DEL character, upper-case; empty becomes NULL."""
    bare = F.regexp_replace(F.trim(x), f"^([^{DEL}]*){DEL}", "$1")
    return F.nullif(F.upper(bare), F.lit(""))


def is_numeric(x: Column) -> Column:
    """True for digits with at most one decimal point after the first digit; NULL gives false."""
    return F.coalesce(clean_text(x).rlike(r"^[0-9]+[.]?[0-9]*\z"), F.lit(False))


def to_int(x: Column) -> Column:
    """Integer if the text is numeric; ``1.5`` gives NULL."""
    return F.when(is_numeric(x), clean_text(x).try_cast("int"))


def to_float(x: Column) -> Column:
    """Number made of the digits and points of the text."""
    return F.nullif(F.regexp_replace(x, "[^0-9.]", ""), F.lit("")).try_cast("double")


def to_real(x: Column) -> Column:
    return F.nullif(x, F.lit("")).try_cast("float")


def digits(x: Column) -> Column:
    return F.regexp_replace(x, NOT_DIGIT, "")


def parse_date(x: Column, formats: Sequence[str]) -> Column:
    """First format that parses."""
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)).cast("date") for f in formats])


def parse_date_two_ways(x: Column) -> Column:
    """Month first, else year first, with any of ``/ - .`` between the parts."""
    return parse_date(F.regexp_replace(x, r"[-.]", "/"), ["M/d/yyyy", "yyyy/M/d"])


def is_date(x: Column) -> Column:
    """Whether the text is a calendar date (``02/34/2017`` is not); NULL gives false."""
    slashed = F.regexp_replace(x, r"[-.]", "/")
    return parse_date(slashed, ["yyyy/M/d", "M/d/yyyy", "M/d/yy", "yyyyMMdd", "yyMMdd"]).isNotNull()


def _this_century_or_last(day: Column, ref_date: Column) -> Column:
    return F.when(F.year(day) > F.year(ref_date), F.add_months(day, -1200)).otherwise(day)


def fix_date(x: Column, ref_date: date | str) -> Column:
    """Date from month/day/year text.

    Six digits: a two-digit year not after ``ref_date``'s year. Eight digits: the date, unless it
    lies over 100 years before or after ``ref_date``. Anything else is NULL.
    """
    ref = F.lit(ref_date).cast("date")
    slashed = F.regexp_replace(F.trim(x), r"[-.]", "/")
    n = F.length(digits(x))
    short = F.regexp_replace(slashed, r"^([0-9]{2})([0-9]{2})([0-9]{2})$", "$1/$2/$3")
    two_digit = _this_century_or_last(parse_date(short, ["M/d/yy"]), ref)
    four_digit = parse_date(slashed, ["M/d/yyyy", "yyyy/M/d", "yyyyMMdd"])
    in_range = (F.year(four_digit) >= F.year(ref) - 100) & (four_digit <= ref)
    return (
        F.when(F.contains(x, F.lit("ý")), F.lit(None))
        .when(n == 6, F.coalesce(two_digit, F.when(in_range, four_digit)))
        .when((n == 8) & in_range, four_digit)
        .cast("date")
    )


def fix_and_check_date(x: Column) -> Column:
    """Month, day and year digits (6 or 8 of them) of a valid date, whatever stands between."""
    d = digits(x)
    ok = ~F.coalesce(F.contains(x, F.lit("ý")), F.lit(True)) & is_date(x)
    short = parse_date(d, ["MMddyy"])
    short = F.when(F.year(short) >= 2070, F.add_months(short, -1200)).otherwise(short)
    return F.when(ok & (F.length(d) == 8), parse_date(d, ["MMddyyyy"])).when(ok & (F.length(d) == 6), short)


def time_to_date(x: Column) -> Column:
    """Date of a timestamp with a four-digit year."""
    return F.when(F.year(x).between(1000, 9999), F.to_date(x))


def fix_time(x: Column) -> Column:
    """``HH:mm`` from the last six digits (or from exactly four)."""
    d = digits(x)
    tail = F.when(F.length(d) > 6, F.right(d, F.lit(6))).otherwise(d)
    return F.when(
        F.length(tail).isin(4, 6), F.date_format(F.try_to_timestamp(F.left(tail, F.lit(4)), F.lit("HHmm")), "HH:mm")
    )


def _choose(key: Column, values: Mapping) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out


def yes_no_words(x: Column) -> Column:
    return _choose(clean_text(x), {"Y": True, "YES": True, "N": False, "NO": False})


def yes_no(x: Column) -> Column:
    return _choose(clean_text(x), {"N": False, "Y": True})


def yes_no_int(x: Column) -> Column:
    return _choose(clean_text(x), {"N": 0, "Y": 1})


def by_prefix(x: Column, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]]) -> Column:
    """First rule ``(code, prefixes, exact values)`` that fits the cleaned text."""
    text = clean_text(x)
    out = None
    for code, prefixes, exact in rules:
        test = F.lit(False)
        for p in prefixes:
            test = test | text.startswith(p)
        if exact:
            test = test | text.isin(list(exact))
        out = F.when(test, code) if out is None else out.when(test, code)
    return out


# Code, prefixes, exact values, in order of precedence.
SEX_CODES = [("MALE", ["M"], []), ("FEMALE", ["F"], [])]
RACE_CODES = [
    ("I", ["AM"], ["I"]),
    ("A", ["AS"], ["A"]),
    ("B", ["B"], []),
    ("W", ["C", "W"], []),
    ("H", ["HI"], []),
    ("O", ["O"], []),
    ("P", ["NAT", "HA"], ["P"]),
]
UNKNOWN_ZIPS = ["00000", "99999"]


def fix_sex(x: Column) -> Column:
    return by_prefix(x, SEX_CODES)


def fix_race(x: Column) -> Column:
    return by_prefix(x, RACE_CODES)


def fix_zip(x: Column) -> Column:
    return F.when(~x.isin(UNKNOWN_ZIPS), x)


def zip_digits(x: Column) -> Column:
    return F.nullif(digits(x), F.lit(""))


def fix_age(x: Column, limit: int = 150) -> Column:
    n = to_int(x)
    return F.when(n < limit, n)


def strip_state_suffix(x: Column, state: str = "KS") -> Column:
    """Drop a trailing state such as `` KS``, ``, KS`` or `` KS.``."""
    return F.regexp_replace(x, rf",? +{state}\.?$", "")


def fix_state(x: Column, aliases: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Map short forms to the state code; a single blank is NULL."""
    out = F.when(x == " ", F.lit(None))
    for code, short in (aliases or {"KS": ["K", "KA"]}).items():
        out = out.when(x.isin(list(short)), code)
    return out.otherwise(x)


def is_resident(tract: Column, address: Column, tract_prefix: str) -> Column:
    """True inside the tract prefix, NULL where there is no address to look up, else false."""
    return F.when(tract.startswith(tract_prefix), True).when(address.isNull(), F.lit(None)).otherwise(False)


def substring_date(x: Column, start: int, length: int, fmt: str = "MM/dd/yyyy") -> Column:
    return F.try_to_timestamp(F.substring(x, start, length), F.lit(fmt)).cast("date")


def substring_timestamp(x: Column, start: int, length: int, fmt: str = "MM/dd/yyyy hh:mm a") -> Column:
    return F.try_to_timestamp(F.substring(x, start, length), F.lit(fmt))


def first_known(*columns: Column) -> Column:
    """First non-NULL in the given order; pass the columns reversed for the last one."""
    return F.coalesce(*columns)


def end_not_before(start: Column, end: Column) -> Column:
    """The end moved up to the start where it lies before it."""
    return F.when(end < start, start).otherwise(end)


def zero_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(0))


def replace_value(x: Column, bad, good=None) -> Column:
    """One known bad value replaced (by NULL unless given)."""
    return F.when(x == F.lit(bad), F.lit(good)).otherwise(x)


def hash_hex(x: Column) -> Column:
    return F.lower(F.hex(x))


def year_difference(later: Column, earlier: Column) -> Column:
    return F.year(later) - F.year(earlier)


def age_from_text(x: Column, suffix: str = " Years") -> Column:
    return F.replace(x, F.lit(suffix), F.lit("")).try_cast("int")


def same_value(a: Column, b: Column, same: str = "same", other: str = "not same") -> Column:
    """``other`` also where one side is NULL."""
    return F.when(a == b, same).otherwise(other)


def choose_date(*columns: Column) -> Column:
    """First non-empty text of the columns, in order of priority."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])
