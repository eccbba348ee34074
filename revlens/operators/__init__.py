"""DataFrame -> DataFrame operators."""

from revlens.operators import joins, ratings, reviews, topk

__all__ = ["joins", "ratings", "reviews", "topk"]
