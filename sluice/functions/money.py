"""Settlement amounts: transaction types and cents to decimal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report transaction type -> internal type
TRANSACTION_TYPES = {"Sale": "sale", "Credit": "refund"}
AMOUNT_TYPE = "decimal(38,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def transaction_type(c) -> Column:
    """``Sale`` -> ``sale``, ``Credit`` -> ``refund``, anything else -> null (see ``transaction_type_error``)."""
    c = _col(c)
    out = F.lit(None).cast("string")
    for k, v in reversed(list(TRANSACTION_TYPES.items())):
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def transaction_type_error(c) -> Column:
    c = _col(c)
    return F.when(transaction_type(c).isNull(),
                  F.concat(F.lit("Unknown transaction type: "), F.coalesce(c, F.lit("None"))))


def _amount_valid(a: Column) -> Column:
    # whole number of cents, optional sign, leading blanks allowed; '' means zero
    return a.rlike(r"^\s*[+-]?[0-9]*$")


def cents_to_decimal(amount, type_col) -> Column:
    """Whole cents as text -> exact ``decimal(38,2)``; refunds are negated.

    ``"5000"`` -> ``50.00``, ``""`` -> ``0.00``; non-integer text or an unknown
    transaction type gives null (see ``cents_error``). Cheap expressions are
    repeated rather than bound (repetition keeps whole-stage codegen).
    """
    a = _col(amount)
    t = transaction_type(type_col)
    digits = F.when(F.trim(a).rlike(r"^[+-]?$"), F.concat(F.trim(a), F.lit("0"))).otherwise(F.ltrim(a))
    value = (digits.try_cast("decimal(38,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(AMOUNT_TYPE)
    signed = F.when(t == "refund", -value).otherwise(value)
    return F.when(_amount_valid(a) & t.isNotNull(), signed)


def cents_error(amount, type_col) -> Column:
    a = _col(amount)
    return F.coalesce(
        transaction_type_error(type_col),
        F.when(a.isNull(), F.lit("Amount is missing")),
        F.when(~_amount_valid(a), F.concat(F.lit("Amount is not a whole number of cents: "), a)),
    )
