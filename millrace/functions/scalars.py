"""Small column rules used by several facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"


def is_blank(value) -> Column:
    """True for null and for empty text."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value, F.lit("")) == ""


def money_product_text(count, price) -> Column:
    """Count times price in exact decimals, as text with four decimals."""
    return (count.try_cast(MONEY) * price.try_cast(MONEY)).cast("string")


def zero_if_null(amount) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.coalesce(amount, F.lit(0.0))


def added_quantity(change_type, new, old) -> Column:
    """Quantity a cart change adds: all of an insert, the growth of an update, null where nothing was added."""
    new_count, old_count = new.try_cast("int"), old.try_cast("int")
    return F.when(change_type == "insert", new).when(
        (change_type == "update") & (new_count > old_count), (new_count - old_count).cast("string")
    )


def keep_listed(data, listed) -> Column:
    """Entries of map ``data`` whose key is in the comma-separated text ``listed``."""
    names = F.split(listed, ",")
    return F.map_filter(data, lambda key, _: F.array_contains(names, key))
