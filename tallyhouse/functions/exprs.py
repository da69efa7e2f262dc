"""Scalar expressions shared by staging, audit and marts.

All of them are plain ``Column`` expressions so Catalyst can fold, push down
and de-duplicate them (a ``try_num`` used three times in one projection is
evaluated once by subexpression elimination).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source project's for identical results.
# ---------------------------------------------------------------------------
ALLOWED_STATUSES = ("completed", "cancelled", "returned")
STATUS_ALIAS_COMPLETED = "kompletní"
ALLOWED_AGE_GROUPS = ("18-24", "25-34", "35-44", "45-54", "55+")
ALLOWED_COUNTRIES = ("CZ", "SK", "PL", "HU", "RO")
ALLOWED_CHANNELS = ("paid_search", "direct", "organic", "email", "social")
TRUE_WORDS = ("1", "true", "t", "yes", "y", "ano")
FALSE_WORDS = ("0", "false", "f", "no", "n", "ne")
# Word delimiters of the warehouse INITCAP (its documented default set).
INITCAP_DELIMITERS = " \t\n\r\f\v!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"
# ---------------------------------------------------------------------------

# A date string must be yyyy-m-d, alone or with a well-formed time of day and
# zone, before it is cast: Spark alone would also accept '2024' and '2024-01',
# and ignores whatever follows the day.
DATE_SHAPE = (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
              r"([ T]([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,9})?)?( ?(Z|UTC|[+-][0-9]{2}:?[0-9]{2}))?)?$")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """TRIM of spaces only (tabs and newlines are kept, as in the source SQL)."""
    return F.trim(_col(c))


def blank(c: Column | str) -> Column:
    """``NULLIF(TRIM(c), '')``: padded or empty text becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def try_num(c: Column | str, precision: int = 38, scale: int = 0) -> Column:
    """``TRY_CAST(NULLIF(TRIM(c), '') AS DECIMAL(p, s))``.

    NULL on junk and on overflow; fractions beyond ``scale`` round half-up, so
    a bare NUMBER (38, 0) turns '0.4' into 0 and '0.5' into 1.
    """
    return blank(c).try_cast(f"decimal({precision},{scale})")


def try_date(c: Column | str) -> Column:
    """Lenient-but-shaped date parse: NULL unless the text is ``yyyy-m-d`` with
    nothing but a time of day after it."""
    text = blank(c)
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("date"))


def flag(pred: Column) -> Column:
    """0/1 INT flag; a NULL (unknown) predicate yields 0, like ``CASE WHEN``."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0)).cast("int")


def status_norm(c: Column | str) -> Column:
    """Order status → completed / cancelled / returned, alias mapped, else NULL."""
    s = F.lower(F.trim(_col(c)))
    return (F.when(s == STATUS_ALIAS_COMPLETED, F.lit("completed"))
            .when(s.isin(*ALLOWED_STATUSES), s))


def parse_bool(c: Column | str) -> Column:
    """Localised boolean text → 1 / 0 / NULL (INT)."""
    s = F.lower(F.trim(_col(c).cast("string")))
    return (F.when(s.isin(*TRUE_WORDS), F.lit(1))
            .when(s.isin(*FALSE_WORDS), F.lit(0))).cast("int")


def code_or(c: Column | str, allowed: Iterable[str], case: str | None = None,
            default: Column | str | None = None) -> Column:
    """Normalise ``c`` (trim, optional upper/lower) and keep it only if it is in
    ``allowed``; otherwise return ``default`` (NULL when omitted)."""
    s = F.trim(_col(c))
    if case == "upper":
        s = F.upper(s)
    elif case == "lower":
        s = F.lower(s)
    fallback = F.lit(default) if isinstance(default, str) else (default if default is not None else F.lit(None))
    return F.when(s.isin(*allowed), s).otherwise(fallback.cast("string"))


def initcap_words(c: Column | str) -> Column:
    """Capitalise the first character after every delimiter of
    ``INITCAP_DELIMITERS`` (Spark's ``initcap`` only splits on spaces).

    The text is split with a zero-width look-behind so every piece keeps its
    trailing delimiter; each piece gets its first character upper-cased and
    the pieces are joined back. Pure built-ins, evaluated in the JVM.
    """
    klass = "".join("\\" + ch if ch in "\\^-[]" else ch for ch in INITCAP_DELIMITERS)
    klass = klass.replace("\t", "\\t").replace("\n", "\\n").replace("\r", "\\r")
    klass = klass.replace("\f", "\\f").replace("\v", "\\x0B")
    pieces = F.split(_col(c), f"(?<=[{klass}])")
    capped = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.array_join(capped, "")


def month_of(c: Column | str) -> Column:
    """First day of the month as a DATE (``trunc``; ``date_trunc`` would give a TIMESTAMP)."""
    return F.trunc(_col(c), "MM")


def month_index(c: Column | str) -> Column:
    """Months since year 0: ``year * 12 + month`` — differences give whole-month offsets."""
    return F.year(_col(c)) * 12 + F.month(_col(c))


def retention_pct(part: Column | str, whole: Column | str) -> Column:
    """``round(part / whole * 100, 2)`` with the float half-to-even rounding of
    numpy (scale by 100, ``rint``, divide back); NULL when ``whole`` is 0."""
    ratio = _col(part).cast("double") / _col(whole).cast("double") * F.lit(100.0)
    return F.when(_col(whole) != 0, F.rint(ratio * F.lit(100.0)) / F.lit(100.0))
