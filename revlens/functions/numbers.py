"""Number texts as the original loaders read them, from Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.text import java_trim

# The number texts that Java's double parser takes, decimal
# ("NaN" and "Infinity" in this spelling only) and hexadecimal.
DECIMAL_TEXT = r"^[+-]?(NaN|Infinity|((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)[fFdD]?)$"
HEX_TEXT = r"^([+-]?)0[xX](?:([0-9a-fA-F]+)\.?|([0-9a-fA-F]*)\.([0-9a-fA-F]+))[pP]([+-]?\d+)[fFdD]?$"
INT_LEAST, INT_MOST = -(1 << 31), (1 << 31) - 1


def java_double(text: Column) -> Column:
    """``Double.parseDouble`` of an already trimmed text; null where Java would raise.

    ``try_cast`` alone takes other spellings (``inf``) and no hexadecimal ones.
    """
    return F.coalesce(F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double")),
                      F.when(text.rlike(HEX_TEXT), _hex_double(text)))


def _hex_double(text: Column) -> Column:
    """Digits times a power of two, rounded to the nearest double.

    Sixty bits of the digits count exactly, later ones only whether they are
    zero; below 2**-1022 the last bit may be rounded twice.
    """
    part = lambda i: F.regexp_extract(text, HEX_TEXT, i)
    fraction = part(4)
    digits = F.ltrim(F.concat(part(2), part(3), fraction), F.lit("0"))
    later = F.substring(digits, 16, 1 << 30)
    whole = F.coalesce(F.conv(F.substring(digits, 1, 15), 16, 10).try_cast("bigint"), F.lit(0).cast("bigint"))
    whole = F.when(F.ltrim(later, F.lit("0")) != "", whole.bitwiseOR(F.lit(1).cast("bigint"))).otherwise(whole)
    # a power beyond these bounds is zero or infinite whatever the digits
    power = F.coalesce(part(5).try_cast("int"), F.when(part(5).startswith("-"), F.lit(INT_LEAST)).otherwise(F.lit(INT_MOST))).cast("bigint")
    power = F.greatest(F.lit(-2200), F.least(F.lit(2200), power - 4 * F.length(fraction) + 4 * F.length(later)))
    half = F.floor(power / 2)
    size = whole.cast("double") * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)
    return F.when(part(1) == "-", -size).otherwise(size)


def loaded_int(text: Column) -> Column:
    """The loader's integer: surrounding blanks don't count, a decimal text is truncated; else, or out of range, null."""
    value = java_double(java_trim(text))
    return F.when((value > INT_LEAST - 1.0) & (value < INT_MOST + 1.0), value.cast("int"))
