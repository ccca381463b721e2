"""Number parsing as column expressions.

Source numbers arrive as text (``5``, ``5.0``, ``1e3``). Parsing goes through a
double and narrows it to a 32-bit int: toward zero, saturating, NaN to 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that count as a number, the int range, the divisor
# that turns stored commissions into whole percent.
NUMBER_TEXT = (
    r"^[\x00-\x20]*[+-]?("
    r"NaN|Infinity"
    r"|0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?"
    r"|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?"
    r")[\x00-\x20]*\z"
)
INT_MIN = -2147483648.0
INT_MAX = 2147483647.0
COMMISSION_UNIT = 1000000


def _narrow(number: Column) -> Column:
    # least/greatest skip nulls, so callers pass a non-null double only.
    bounded = F.greatest(F.least(F.nanvl(number, F.lit(0.0)), F.lit(INT_MAX)), F.lit(INT_MIN))
    return bounded.cast("int")


def is_numeric(value: Column) -> Column:
    """True where the text parses as a number; false for null."""
    return F.coalesce(value.cast("string").rlike(NUMBER_TEXT), F.lit(False))


def _valid(text: Column, number: Column) -> Column:
    # Spark's cast also takes ``inf`` and ``nan``, so a result that is not finite
    # is held against the grammar; finite ones need no regular expression.
    return (F.abs(number) < F.lit(float("inf"))) | text.rlike(NUMBER_TEXT)


def trunc_int(value: Column, null: str = "error") -> Column:
    """Strict parse: text that is no number fails the job.

    ``null`` is ``"error"`` (fail) or ``"zero"``.
    """
    if null not in ("error", "zero"):
        raise ValueError(f"null must be 'error' or 'zero', not {null!r}")
    text = value.cast("string")
    number = text.try_cast("double")
    missing = (
        F.lit(0)
        if null == "zero"
        else F.raise_error(F.lit("number expected, found null")).cast("int")
    )
    junk = F.raise_error(F.concat(F.lit("number expected, found: "), text)).cast("int")
    return (
        F.when(text.isNull(), missing)
        .when(_valid(text, number), _narrow(number))
        .otherwise(junk)
    )


def checked_int(value: Column, missing: int | None = None) -> Column:
    """First half of a strict parse: null where the text is no number.

    Lets a number be parsed once per source row, before a join repeats it or
    drops it; ``required`` then fails for the rows that are left.
    """
    text = value.cast("string")
    number = text.try_cast("double")
    parsed = F.when(_valid(text, number), _narrow(number))
    return parsed if missing is None else F.when(text.isNull(), F.lit(missing)).otherwise(parsed)


def required(checked: Column, name: str) -> Column:
    """Second half of a strict parse: fail where ``checked_int`` found no number."""
    return F.coalesce(checked, F.raise_error(F.lit(f"number expected in {name}")).cast("int"))


def trunc_int_or_zero(value: Column) -> Column:
    """Lenient parse: null and text that is no number give 0."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER_TEXT), _narrow(text.try_cast("double"))).otherwise(F.lit(0))


def scaled_div(value: Column, unit: int = COMMISSION_UNIT) -> Column:
    """Strict parse, then whole-number division toward zero; null gives 0."""
    return scaled_int(trunc_int(value, null="zero"), unit)


def scaled_int(number: Column, unit: int = COMMISSION_UNIT) -> Column:
    """Whole-number division of an int, toward zero."""
    return F.call_function("div", number, F.lit(unit)).cast("int")
