"""Typed values from metadata text.

Metadata values are untyped text, so a plain ANSI cast can fail on a value that belongs to
another key. Everything here uses ``try_cast`` on the numeric head of the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import MONEY_TYPE, ORDER_KEY_PREFIX

# The part of a text that counts as a number, and the last second that MySQL's
# FROM_UNIXTIME accepts (3001-01-18 23:59:59 UTC; later ones are null there too).
UNSIGNED_HEAD = "^[ ]*([0-9]+)"
DECIMAL_HEAD = "^[ ]*([+-]?[0-9]*[.]?[0-9]+([eE][+-]?[0-9]+)?)"
LAST_UNIX_SECOND = 32536771199


def to_unsigned(text: Column) -> Column:
    """Leading digits as a long; 0 where there are none."""
    head = F.regexp_extract(text, UNSIGNED_HEAD, 1)
    return F.coalesce(head.try_cast("bigint"), F.lit(0).cast("bigint"))


def to_decimal(text: Column) -> Column:
    """Leading number as money; 0 where there is none.

    Most metadata doesn't begin like a number, which its first character tells: neither the pattern nor the
    cast, whose failure costs more than all else here, sees such a text.
    """
    first = F.substring(F.ltrim(text), 1, 1)
    head = F.regexp_extract(text, DECIMAL_HEAD, 1)
    number = F.when(first.between("+", "9"), F.nullif(head, F.lit("")).try_cast(MONEY_TYPE))
    return F.coalesce(number, F.lit(0).cast(MONEY_TYPE))


def from_unixtime(text: Column) -> Column:
    """Unix seconds at the head of a text, as a UTC timestamp without zone; null where there are none
    or they are out of range.

    Adds to a zoneless epoch, so the session time zone has no influence.
    """
    seconds = F.regexp_extract(text, UNSIGNED_HEAD, 1).try_cast("bigint")
    valid = F.when(seconds.between(0, LAST_UNIX_SECOND), seconds)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=valid.cast("decimal(18,6)"))


def yes_flag(text: Column) -> Column:
    return _flag(text, "yes")


def true_flag(text: Column) -> Column:
    return _flag(text, "true")


def _flag(text: Column, word: str) -> Column:
    return F.when(text == word, 1).otherwise(0)


def default_order_key(key: Column, order_id: Column) -> Column:
    return F.coalesce(key, F.concat(F.lit(ORDER_KEY_PREFIX), order_id.cast("string")))


def round_pct(part: Column, total: Column) -> Column:
    """Percentage with two decimals, as a double; null when the total is 0."""
    exact = part.cast("decimal(20,0)") * F.lit(100) / F.nullif(total, F.lit(0)).cast("decimal(20,0)")
    return F.round(exact, 2).cast("double")


def int_pct(part: Column, total: Column) -> Column:
    """Whole percentage, rounded down; null when the total is 0."""
    return F.call_function("div", part * F.lit(100), F.nullif(total, F.lit(0)))
