"""Readers and writers."""

from revlens.sources.sinks import tsv_lines, write_tsv
from revlens.sources.text_tables import (REVIEW_SCHEMA, parse_items, parse_pairs, parse_quoted_reviews,
                                         parse_ratings, parse_reviews, parse_users, quoted_records,
                                         read_items, read_lines, read_pairs, read_ratings, read_reviews,
                                         read_users, read_word_list)

__all__ = ["REVIEW_SCHEMA", "read_items", "read_ratings", "read_reviews", "read_users",
           "read_word_list", "parse_items", "parse_ratings", "parse_reviews", "parse_users",
           "parse_pairs", "parse_quoted_reviews", "quoted_records", "read_lines", "read_pairs",
           "tsv_lines", "write_tsv"]
