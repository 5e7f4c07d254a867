"""Numbers: rates, Wilson bounds, bands, unit conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, unit_key

#: Fixed value: the normal quantile of the 95 % interval.
Z = 1.96


def rate_pct(positive: Column, total: Column) -> Column:
    """Percentage, half up to two places."""
    return F.round(F.lit(100.0) * positive / total, 2)


def wilson_pct(positive: Column, total: Column) -> tuple[Column, Column]:
    """Bounds of the Wilson 95 % interval in percent, two places."""
    n, p = total.cast("double"), positive / total
    scale = 1 + F.lit(Z * Z) / n
    centre = (p + F.lit(Z * Z / 2) / n) / scale
    margin = F.lit(Z) * F.sqrt(p * (1 - p) / n + F.lit(Z * Z / 4) / (n * n)) / scale
    return F.round(100 * (centre - margin), 2), F.round(100 * (centre + margin), 2)


def _bands(c: Column, bounds: list[tuple[int, str]], last: str) -> Column:
    out = None
    for top, name in bounds:
        out = F.when(c <= top, name) if out is None else out.when(c <= top, name)
    return F.when(c.isNotNull(), out.otherwise(last))


def age_band(c: Column) -> Column:
    return _bands(c, [(17, "00-17"), (34, "18-34"), (49, "35-49"), (64, "50-64"), (79, "65-79")], "80+")


def stay_band(c: Column) -> Column:
    return _bands(c, [(0, "0"), (3, "1-3"), (7, "4-7"), (14, "8-14")], "15+")


def prior_band(c: Column) -> Column:
    return _bands(c, [(0, "0"), (1, "1")], "2+")


#: Test aliases, and (test, unit) -> factor as text, canonical unit, label.
TEST_ALIASES = {"glucose": "glucose", "haemoglobin": "haemoglobin", "hemoglobin": "haemoglobin", "creatinine": "creatinine"}
CONVERSIONS = [
    ("glucose", "mg/dl", "1", "mg/dL", "none"),
    ("glucose", "mmol/l", "18.016", "mg/dL", "mmol/L_x_18.016"),
    ("haemoglobin", "g/dl", "1", "g/dL", "none"),
    ("haemoglobin", "g/l", "0.1", "g/dL", "g/L_div_10"),
    ("creatinine", "mg/dl", "1", "mg/dL", "none"),
    ("creatinine", "umol/l", "1/88.4", "mg/dL", "umol/L_div_88.4"),
]


def measured(c: Column) -> Column:
    """A finite number of zero or more, or null; larger than 18 digits is null."""
    text = strip(F.coalesce(c, F.lit("")))
    number = F.when(text.rlike(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"), text.try_cast("decimal(28,10)"))
    return F.when(number >= 0, number)


def convert_lab(test: Column, value: Column, unit: Column) -> dict[str, Column]:
    """test, value (decimal, 6 places), unit, label, and a reason if refused."""
    name = F.lower(strip(F.coalesce(test, F.lit(""))))
    canonical = F.when(F.lit(False), F.lit(None).cast("string"))
    for alias, known in TEST_ALIASES.items():
        canonical = canonical.when(name == alias, known)
    number, key = measured(value), unit_key(F.coalesce(unit, F.lit("")))
    out_value, out_unit, label = (F.when(F.lit(False), F.lit(None).cast(t)) for t in ("decimal(34,6)", "string", "string"))
    for known, known_unit, factor, target, applied in CONVERSIONS:
        hit = (canonical == known) & (key == known_unit)
        if factor == "1/88.4":
            scaled = number / F.lit("88.4").cast("decimal(3,1)")
        else:
            scaled = number * F.lit(factor).cast("decimal(5,3)")
        out_value = out_value.when(hit, F.round(scaled, 6).cast("decimal(34,6)"))
        out_unit, label = out_unit.when(hit, target), label.when(hit, applied)
    reason = (
        F.when(canonical.isNull(), "unsupported_test_name")
        .when(number.isNull(), "invalid_result_value")
        .when(label.isNull(), "unsupported_test_unit")
    )
    return {"test": canonical, "value": out_value, "unit": out_unit, "label": label, "reason": reason}


def plain_decimal(c: Column) -> Column:
    """A decimal as text without trailing zeros."""
    text = c.cast("string")
    return F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)
