"""String expressions built from Spark built-ins (JVM side, codegen-friendly).

The source jobs ran on the JVM, so a few helpers reproduce Java string rules
that Spark's own functions handle differently: ``String.trim`` strips every
char <= U+0020 (Spark ``trim`` strips only spaces) and ``String.split`` with
no limit drops trailing empty fields (Spark ``split`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word delimiters of the original tokenizer are space,
# double quote, comma, open parenthesis, close parenthesis and star.
DEFAULT_TOKEN_DELIMITERS = ' ",()*'

# Same set plus tab, line feed, vertical tab, form feed and carriage return,
# for texts that span several lines.
WHITESPACE_TOKEN_DELIMITERS = ' \t\n\x0b\f\r",()*'

# Characters String.trim() removes: U+0000 to U+0020.
_CTRL_OR_SPACE = "".join(chr(i) for i in range(0x21))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """``String.trim()``: strip all leading/trailing chars <= U+0020.

    A character-set trim, no regex: cheap enough to run on every token.
    """
    return F.btrim(_col(c), F.lit(_CTRL_OR_SPACE))


def has_visible_char(c: Column | str) -> Column:
    """True when ``java_trim(c)`` is non-empty (null stays null).

    A text whose first byte is above U+0020 needs no trim: nearly every token.
    """
    c = _col(c)
    return (c >= "!") | (java_trim(c) != "")


def java_split(c: Column | str, pattern: str, limit: int = 0) -> Column:
    """``String.split(pattern, limit)``.

    ``limit > 0`` behaves like Spark's ``split``.  ``limit == 0`` also drops
    trailing empty fields: ``"1,2,"`` gives two fields and ``",,"`` none,
    while ``""`` stays one empty field.
    """
    c = _col(c)
    if limit > 0:
        return F.split(c, pattern, limit)
    if limit < 0:
        return F.split(c, pattern, -1)
    # \z, not $: in Java regex $ also matches before a final line terminator
    stripped = F.regexp_replace(c, f"(?:{pattern})+\\z", "")
    return (F.when(c == "", F.array(F.lit("")))
             .when(stripped == "", F.array().cast("array<string>"))
             .otherwise(F.split(stripped, pattern, -1)))


def delimiter_class(delimiters: str) -> str:
    """Regex matching one or more of the given delimiter characters."""
    body = "".join(_escape_class_char(ch) for ch in delimiters)
    return f"[{body}]+"


def _escape_class_char(ch: str) -> str:
    named = {"\t": r"\t", "\n": r"\n", "\x0b": r"\x0B", "\f": r"\f", "\r": r"\r"}
    if ch in named:
        return named[ch]
    if ch in "\\[]^-&":
        return "\\" + ch
    return ch
