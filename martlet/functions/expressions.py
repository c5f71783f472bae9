"""Column expressions shared by the silver and gold models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values taken from the source system.
CANCELLED_STATUS = "CANCELADO"      # status name that removes an order
MISSING_PRODUCT_ID = 0              # product id that means "no product"
MISSING_KEY_PREFIX = "missing_"     # merge-key prefix for such lines
ACTIVE_FLAG = "A"                   # product situacao for an active product
KIT_FORMAT = "E"                    # product formato for a kit


def merge_key(product_id: Column, order_id: Column) -> Column:
    """product_id_for_merge: ``missing_<order>`` for product 0, else the id as text.

    A NULL product id gives a NULL key (CASE falls to ELSE, and the cast of NULL is NULL).
    """
    return (F.when(product_id == F.lit(MISSING_PRODUCT_ID),
                   F.concat(F.lit(MISSING_KEY_PREFIX), order_id.cast("string")))
            .otherwise(product_id.cast("string")))


def matchable_product_id(product_id: Column) -> Column:
    """Join key equal to ``product_id_for_merge = CAST(p.product_id AS STRING)``.

    The text key of product 0 (``missing_...``) and of a NULL product never
    matches a product, and any other key matches exactly its integer id, so the
    text join is an integer join on this column (hashing longs, not strings).
    """
    return F.when(product_id != F.lit(MISSING_PRODUCT_ID), product_id)


def not_cancelled(status_name: Column) -> Column:
    """``status_name != 'CANCELADO'`` with SQL NULL semantics: NULL or unknown status drops."""
    return status_name != F.lit(CANCELLED_STATUS)


def units_times(amount: Column, units: Column) -> Column:
    """amount * units with all nine decimals: (24, 9) * (13, 0) fits DECIMAL(38, 9)."""
    return amount.cast("decimal(24,9)") * units.cast("decimal(13,0)")


def money_plus(*terms: Column) -> Column:
    """Sum of amounts with all nine decimals; any NULL term gives NULL.

    A sum is one digit wider than its terms, so up to four terms of (35, 9) fit.
    """
    total = terms[0].cast("decimal(35,9)")
    for t in terms[1:]:
        total = total + t.cast("decimal(35,9)")
    return total


def money_minus(a: Column, b: Column) -> Column:
    """a - b with all nine decimals."""
    return a.cast("decimal(37,9)") - b.cast("decimal(37,9)")


def order_cost(shipping: Column, discount: Column, commission: Column, product_cost: Column) -> Column:
    """Freight + discount + commission + product cost; any NULL term gives NULL."""
    return money_plus(shipping, discount, commission, product_cost)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / NULLIF(denominator, 0), as DOUBLE; never raises on zero."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")
