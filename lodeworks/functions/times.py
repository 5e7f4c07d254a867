"""Date and time columns with a reason for every value refused."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

ORDERS = ("reject", "dmy", "mdy")


def _iso(text: Column) -> Column:
    """A date from canonical ISO text; null if there is no such day (or year 0)."""
    return F.when(text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & ~text.startswith("0000"), F.try_to_date(text, "yyyy-MM-dd"))


def _slash(text: Column, order: str, tail: str) -> Column:
    """The date of ``a/b/yyyy`` as ISO text."""
    pattern = rf"\A([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}){tail}\z"
    day, month = (1, 2) if order == "dmy" else (2, 1)
    part = lambda k: F.lpad(F.regexp_extract(text, pattern, k), 2, "0")
    return F.concat_ws("-", F.regexp_extract(text, pattern, 3), part(month), part(day))


def parse_date(c: Column, field: str, order: str = "reject") -> tuple[Column, Column]:
    """(date, reason): ISO or slash dates in the configured order."""
    if order not in ORDERS:
        raise ValueError("slash dates are rejected, dmy or mdy")
    text = strip(F.coalesce(c, F.lit("")))
    is_slash = text.rlike(r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z")
    value = _iso(text) if order == "reject" else F.when(is_slash, _iso(_slash(text, order, ""))).otherwise(_iso(text))
    reason = F.when(text == "", f"missing_{field}")
    if order == "reject":
        reason = reason.when(is_slash, f"unconfigured_slash_date_{field}")
    return value, reason.when(value.isNull(), f"invalid_{field}")


_CLOCK = r"([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?"
_OFFSET = r"(Z|[+-][0-9]{2}(?::?[0-9]{2})?)?"


def parse_timestamp(c: Column, field: str, order: str = "reject") -> tuple[Column, Column, Column]:
    """(time without zone, had an offset, reason).

    A time with an offset is converted to UTC before anything else is judged
    by it.  Fractions beyond microseconds are cut.
    """
    text = strip(F.coalesce(c, F.lit("")))
    iso = rf"\A([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})[ T]{_CLOCK}{_OFFSET}\z"
    tail = r"[ T]([0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?)"
    is_slash = text.rlike(rf"\A[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}{tail}\z")
    if order != "reject":
        clock = F.regexp_extract(text, tail + r"\z", 1)
        text_iso = F.when(is_slash, F.concat_ws("T", _slash(text, order, tail), clock)).otherwise(text)
    else:
        text_iso = text
    part = lambda k: F.regexp_extract(text_iso, iso, k)
    or_zero = lambda x: F.when(x == "", "00").otherwise(x)
    fraction = F.rpad(F.substring(part(5), 1, 6), 6, "0")
    plain = F.concat(part(1), F.lit(" "), part(2), F.lit(":"), or_zero(part(3)), F.lit(":"), or_zero(part(4)), F.lit("."), fraction)
    at = F.when(text_iso.rlike(iso) & ~text_iso.startswith("0000"), plain.try_cast("timestamp_ntz"))
    offset = part(6)
    minutes = F.when(offset.isin("", "Z"), 0).otherwise(
        F.concat(F.substring(offset, 1, 1), F.lit("1")).try_cast("int")
        * (F.substring(offset, 2, 2).try_cast("int") * 60 + F.coalesce(F.regexp_extract(offset, r"^...:?([0-9]{2})$", 1).try_cast("int"), F.lit(0))))
    value = at - F.make_dt_interval(mins=F.coalesce(minutes, F.lit(0)))
    reason = F.when(text == "", f"missing_{field}")
    if order == "reject":
        reason = reason.when(is_slash, f"unconfigured_slash_date_{field}")
    return value, at.isNotNull() & (offset != ""), reason.when(value.isNull(), f"invalid_{field}")


def format_timestamp(value: Column, had_offset: Column) -> Column:
    """ISO text; microseconds only where there are some, Z for converted times."""
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(value, "SSSSSS")
    return F.concat(whole, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""), F.when(had_offset, "Z").otherwise(""))


def completed_years(born: Column, at: Column) -> Column:
    """Age in whole years; a birthday on 29 February counts from 1 March in other years."""
    early = F.date_format(at, "MMdd") < F.date_format(born, "MMdd")
    return (F.year(at) - F.year(born) - early.cast("int")).cast("int")


def freshness(at: Column, now: Column, limit_seconds: int = 86_400) -> Column:
    """FRESH, STALE beyond the limit, INVALID if the time is ahead of now."""
    age = F.unix_timestamp(now) - F.unix_timestamp(at)
    return F.when(age < 0, "INVALID").when(age > limit_seconds, "STALE").otherwise("FRESH")
