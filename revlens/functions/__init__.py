"""Column expressions shared by the operators."""

from revlens.functions.fmt import bucket_line, gender_line, item_line, top_item_line
from revlens.functions.text import (DEFAULT_TOKEN_DELIMITERS, WHITESPACE_TOKEN_DELIMITERS,
                                    delimiter_class, has_visible_char, java_split,
                                    java_trim)

__all__ = [
    "DEFAULT_TOKEN_DELIMITERS", "WHITESPACE_TOKEN_DELIMITERS", "bucket_line",
    "delimiter_class", "gender_line", "has_visible_char", "item_line", "java_split",
    "java_trim", "top_item_line",
]
