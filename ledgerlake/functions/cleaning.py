"""Column-level cleaning helpers (all JVM-side built-ins, codegen friendly).

``on_bad`` chooses how unparseable text is treated:

* ``"fail"`` (default, same as the reference under ANSI mode): a malformed
  date, timestamp, int or discount raises and fails the job.
* ``"null"``: the ``try_*`` forms turn malformed text into NULL so the row
  can be kept or routed to a rejects frame.

Prices always use the lenient form (bad prices become NULL and are filtered
out by the validity rule), as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import DATE_PATTERN, TIMESTAMP_PATTERN, UNKNOWN_CITY

_MODES = ("fail", "null")
# Texts of exactly a pattern's digits: a cast reads them as the pattern does, at
# a fraction of the cost. Year 0000, which only a cast knows, is left out.
_DATE_TEXT = r"(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"
PLAIN_TEXT = {DATE_PATTERN: rf"\A{_DATE_TEXT}\z",
              TIMESTAMP_PATTERN: rf"\A{_DATE_TEXT} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}\z"}


def _check(on_bad: str) -> None:
    if on_bad not in _MODES:
        raise ValueError(f"on_bad must be one of {_MODES}, got {on_bad!r}")


def empty_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """The empty string as NULL (a text of blanks stays)."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def trim_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Strip spaces (only spaces; tabs and newlines stay) in one projection."""
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def blank_to_default(c: str, default: str = UNKNOWN_CITY) -> Column:
    """P7: '' or NULL gives ``default``, anything else is title-cased."""
    col = F.col(c)
    return F.when((col == "") | col.isNull(), F.lit(default)).otherwise(F.initcap(col))


def _parsed(c: str, to: str, pattern: str, by_pattern: Column) -> Column:
    """``by_pattern``, which judges every text a plain cast doesn't take."""
    if pattern not in PLAIN_TEXT:
        return by_pattern
    return F.coalesce(F.when(F.col(c).rlike(PLAIN_TEXT[pattern]), F.col(c).try_cast(to)), by_pattern)


def to_date_col(c: str, on_bad: str = "fail", pattern: str = DATE_PATTERN) -> Column:
    """P8."""
    _check(on_bad)
    by_pattern = (F.to_date if on_bad == "fail" else F.try_to_date)(F.col(c), pattern)
    return _parsed(c, "date", pattern, by_pattern)


def to_timestamp_col(c: str, on_bad: str = "fail", pattern: str = TIMESTAMP_PATTERN) -> Column:
    """P9."""
    _check(on_bad)
    by_pattern = (F.to_timestamp(F.col(c), pattern) if on_bad == "fail"
                  else F.try_to_timestamp(F.col(c), F.lit(pattern)))
    return _parsed(c, "timestamp", pattern, by_pattern)


def cast_col(c: str, to: str, on_bad: str = "fail") -> Column:
    """Strict ``cast`` or lenient ``try_cast``."""
    _check(on_bad)
    col = F.col(c)
    return col.try_cast(to) if on_bad == "null" else col.cast(to)


def safe_decimal(c: str, precision: int = 12, scale: int = 2) -> Column:
    """Non-numeric or overflowing text gives NULL."""
    return F.col(c).try_cast(f"decimal({precision},{scale})")
