"""Exact amounts of any length, as text with two decimals.

Texts of up to ``SHORT`` characters without an exponent are parsed as decimals. Others are cut into sign, digits and exponent
and rounded digit by digit, so no amount is too large or has too many decimals to be exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# So many characters hold at most 18 digits before the point and 17 after it, which decimal(38,20) takes without rounding.
SHORT = 18
# Sign, integer digits without leading zeros, decimals, exponent. Exponents of more than four digits are not amounts.
NUMBER = r"^\s*([+-]?)(?=\.?\d)0*(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d{1,4}))?\s*$"


def _is_short(text: Column) -> Column:
    return (F.length(text) <= SHORT) & ~F.contains(F.lower(text), F.lit("e"))


def _short(text: Column) -> Column:
    return text.try_cast("decimal(38,20)")


def _named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(text: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a long number's minus, whole, decimals and exponent; NULL if the text is no number."""
    part = [F.regexp_extract(text, NUMBER, i) for i in (1, 2, 3, 4)]
    power = F.coalesce(part[3].try_cast("int"), F.lit(0))
    parts = F.struct((part[0] == "-").alias("minus"), part[1].alias("whole"), part[2].alias("decimals"), power.alias("power"))
    return F.when(text.rlike(NUMBER), _named(parts, body))


def sign(text: Column) -> Column:
    """-1, 0 or 1 of a number as text, before any rounding; NULL if it is none."""
    text = text.cast("string")

    def of(n: Column) -> Column:
        return F.when(F.concat(n["whole"], n["decimals"]).rlike("^0*$"), 0).when(n["minus"], -1).otherwise(1)

    return F.when(_is_short(text), F.signum(_short(text)).cast("int")).otherwise(_long(text, of))


def money(text: Column) -> Column:
    """A number as text to the same with two decimals, half-even, without its sign. What is no finite number gives NULL."""
    text = text.cast("string")
    short = F.abs(F.bround(_short(text), 2).cast("decimal(38,2)")).cast("string")
    return F.when(_is_short(text), short).otherwise(_long(text, _rounded))


def _rounded(n: Column) -> Column:
    digits = F.concat(n["whole"], n["decimals"])
    # How many of the digits are whole cents; more than there are means zeros follow.
    given = F.struct(digits.alias("digits"), (F.length(n["whole"]) + n["power"] + 2).alias("cents"))

    def cut(g: Column) -> Column:
        digits, cents = g["digits"], g["cents"]
        whole = F.greatest(cents, F.lit(0))
        kept = F.concat(F.substring(digits, F.lit(1), whole), F.repeat(F.lit("0"), F.greatest(cents - F.length(digits), F.lit(0))))
        rest = F.concat(F.repeat(F.lit("0"), F.greatest(-cents, F.lit(0))), F.substring(digits, whole + 1, F.length(digits)))
        return F.struct(kept.alias("kept"), rest.alias("rest"), F.regexp_extract(kept, "^(.*?)9*$", 1).alias("head"))

    def round_half_even(c: Column) -> Column:
        kept, rest, head = c["kept"], c["rest"], c["head"]
        odd = F.substring(kept, -1, 1).isin("1", "3", "5", "7", "9")
        up = rest.rlike("^[6-9]") | rest.rlike("^50*[1-9]") | (rest.rlike("^50*$") & odd)
        # One more: trailing nines become zeros and the digit before them grows.
        digit = F.coalesce(F.substring(head, -1, 1).try_cast("int"), F.lit(0)) + 1
        before = F.substring(head, F.lit(1), F.length(head) - 1)
        grown = F.concat(before, digit, F.repeat(F.lit("0"), F.length(kept) - F.length(head)))
        return F.regexp_replace(F.when(up, grown).otherwise(kept), "^0+", "")

    def pointed(found: Column) -> Column:
        return F.concat(F.substring(found, F.lit(1), F.length(found) - 2), F.lit("."), F.substring(found, -2, 2))

    def padded(found: Column) -> Column:
        return F.lpad(found, F.greatest(F.length(found), F.lit(3)), F.lit("0"))

    rounded = _named(_named(given, cut), round_half_even)
    return _named(_named(rounded, padded), pointed)


def size(amount: Column) -> Column:
    """A key that orders amounts made by ``money``: by length, then by digits."""
    return F.struct(F.length(amount).alias("length"), amount.alias("amount"))
