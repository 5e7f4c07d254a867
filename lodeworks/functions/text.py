"""Text columns: trimming, folding, codes and keyed tokens."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip(c: Column) -> Column:
    """Without white space of any script at both ends.

    Most texts begin and end with a visible ASCII character and are left as
    they are without a pattern.
    """
    visible = [F.substring(c, at, 1).between("!", "~") for at in (1, -1)]
    return F.when(visible[0] & visible[1], c).otherwise(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def blank(c: Column) -> Column:
    """Is the text null or only white space?"""
    return F.coalesce(strip(c), F.lit("")) == ""


def sorted_codes(*conditions: tuple[Column, str]) -> Column:
    """The codes whose condition holds, sorted, without nulls."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in conditions])))


def listed_codes(*conditions: tuple[Column, str]) -> Column:
    """The codes whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in conditions]))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def phone(c: Column) -> Column:
    """Digits without the trunk zero of 11 or the country code of 13."""
    d = digits(F.coalesce(c, F.lit("")))
    return (
        F.when((F.length(d) == 11) & d.startswith("0"), F.substring(d, 2, 10))
        .when((F.length(d) == 13) & d.startswith("234"), F.substring(d, 4, 10))
        .otherwise(d)
    )


@F.pandas_udf(T.StringType())
def _fold_wide(s: pd.Series) -> pd.Series:
    """Compatibility decomposition to ASCII letters and digits."""
    folded = s.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii").str.casefold()
    return folded.str.replace(r"[^a-z0-9]", "", regex=True)


def fold(c: Column) -> Column:
    """Lower-case ASCII letters and digits of a text; null is blank.

    ASCII texts, the common case, never leave the JVM: the vectorised function
    sees nulls for them.
    """
    c = F.coalesce(c, F.lit(""))
    plain = c.rlike(r"\A[\x00-\x7F]*\z")
    return F.when(plain, fold_ascii(c)).otherwise(_fold_wide(F.when(~plain, c)))


def fold_ascii(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def one_edit(a: Column, b: Column) -> Column:
    """Are the texts, both not blank, one insertion, deletion or change apart?"""
    return (a != "") & (b != "") & (a != b) & (F.levenshtein(a, b, 1) == 1)


def icd10(c: Column) -> Column:
    """Diagnosis code with a dot after three characters; null if malformed."""
    compact = F.upper(F.regexp_replace(c, r"(?U)[.\s]", ""))
    dotted = F.when(F.length(compact) > 3, F.concat(F.substring(compact, 1, 3), F.lit("."), F.substring(compact, 4, 10))).otherwise(compact)
    return F.when(compact.rlike(r"\A[A-Z][0-9][0-9A-Z][0-9A-Z]{0,4}\z"), dotted)


def diagnosis_group(c: Column) -> Column:
    """The first three characters without dots; null if there are fewer."""
    compact = F.replace(c, F.lit("."), F.lit(""))
    return F.when(F.length(compact) >= 3, F.substring(compact, 1, 3))


def sex(c: Column, numeric: dict[str, str] | None = None) -> tuple[Column, Column]:
    """(M or F, reason) from words or configured numeric codes."""
    raw = strip(F.coalesce(c, F.lit("")))
    word = F.lower(raw)
    value = F.when(word.isin("m", "male"), "M").when(word.isin("f", "female"), "F")
    for code, meaning in (numeric or {}).items():
        value = value.when(raw == code, meaning)
    reason = F.when(value.isNull(), F.when(raw.rlike(r"\A[0-9]+\z"), "unmapped_numeric_sex_code").otherwise("invalid_sex"))
    return value, reason


def unit_key(c: Column) -> Column:
    """Unit in lower case, both micro signs as u."""
    return F.translate(F.lower(strip(c)), "μµ", "uu")


def _hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def token_in_plan(key: bytes, prefix: str, *values: Column, length: int = 20) -> Column:
    """Keyed token from built-in hashes.  The pads stand in the plan, and from
    pads a key follows: only for keys that need not stay secret, as in tests."""
    inner, outer = _hmac_pads(key)
    message = F.concat_ws("\x1f", F.lit(prefix), *values).cast("binary")
    first = F.unhex(F.sha2(F.concat(F.lit(bytearray(inner)), message), 256))
    return F.concat(F.lit(prefix + "-"), F.substring(F.upper(F.sha2(F.concat(F.lit(bytearray(outer)), first), 256)), 1, length))


def token(key: bytes, prefix: str, *values: Column, length: int = 20) -> Column:
    """Keyed token (HMAC-SHA-256, upper-case hex, cut to ``length``); the key
    travels in the function's closure and never shows in a plan or log."""
    if len(key) < 32:
        raise ValueError("the key must have at least 32 bytes")

    @F.pandas_udf(T.StringType())
    def run(message: pd.Series) -> pd.Series:
        import hashlib
        import hmac

        return message.map(lambda m: None if m is None else f"{prefix}-{hmac.new(key, m.encode(), hashlib.sha256).hexdigest().upper()[:length]}")

    return run(F.concat_ws("\x1f", F.lit(prefix), *values))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
