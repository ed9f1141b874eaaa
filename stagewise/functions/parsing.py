"""Text -> number conversions with the source's semantics.

* A numeric text parses to a whole number (decimal(38,0)); the fraction is
  rounded half away from zero, so ``59.6`` becomes 60 and fails ``< 60``.
* Unparseable text becomes NULL (``try_cast``) unless ``strict`` is set, in
  which case the ANSI cast raises.
* Threshold text is matched against the *whole* string, so the pattern is
  anchored here (Spark's ``rlike`` searches).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import THRESHOLD_STRIP_CHARS, THRESHOLD_TEXT_PATTERN

WHOLE_NUMBER = "decimal(38,0)"


def to_whole_number(c: Column, strict: bool = False) -> Column:
    return c.cast(WHOLE_NUMBER) if strict else c.try_cast(WHOLE_NUMBER)


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})\z")  # $ would also match before a final line break


def is_threshold_text(c: Column) -> Column:
    return full_match(c, THRESHOLD_TEXT_PATTERN)


def threshold_value(c: Column, strict: bool = False) -> Column:
    """Strip the comparison symbols and parse what is left."""
    return to_whole_number(F.translate(c, THRESHOLD_STRIP_CHARS, ""), strict)


def dx_number(code: Column) -> Column:
    """Diagnosis code -> 4-digit number: 4 characters keep the last three and
    append 0 (``N183`` -> 1830); 5 characters keep the last four."""
    n = F.length(code)
    return (F.when(n == 4, F.concat(F.right(code, F.lit(3)), F.lit("0")).cast(WHOLE_NUMBER))
             .when(n == 5, F.right(code, F.lit(4)).cast(WHOLE_NUMBER))
             .otherwise(F.lit(None).cast(WHOLE_NUMBER)))
