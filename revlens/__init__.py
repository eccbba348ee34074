"""Ratings and review analytics as Spark DataFrame functions.

Example::

    from revlens.session import local_session
    from revlens.sources import read_ratings, read_items, read_reviews, read_word_list
    from revlens.operators import ratings as R, reviews as V

    spark = local_session()
    ratings = read_ratings(spark, ["r1.txt", "r2.txt"])
    items = read_items(spark, "items.txt")
    R.rating_avg_by_item(ratings, items).show()
    R.best_rated_item(ratings, items, min_count=5).show()

    reviews = read_reviews(spark, "reviews.csv")
    words = V.clean_words(reviews, read_word_list(spark, "stop.txt"))
    V.top_words(V.word_counts(words, ["category"]), k=5).show()

Every function takes and returns DataFrames; nothing is computed until an
action (a write, ``show``, ``count``) runs.
"""

__version__ = "0.1.0"
