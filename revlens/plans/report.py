"""Whole-lab runs: every output of a lab written as TSV under one folder.

``ratings_report`` writes the per-item lines plus the best-item line, the
(genre, rating) pairs, the per-genre lines and the per-gender and
per-age-group lines.  ``reviews_report`` writes the cleaned words and every
word / comment statistic.

The word statistics all derive from one pre-aggregate, the count per
(category, sentiment, word): frequencies are its sums over categories and
sentiments, per-category counts its sums over sentiments.  It is computed
once, written as a table in the shared checkpoint folder (so a lost
executor never forces the text to be tokenised again for the later outputs)
and read back for each output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions import fmt
from revlens.functions.text import DEFAULT_TOKEN_DELIMITERS
from revlens.operators import ratings as R
from revlens.operators import reviews as V
from revlens.session import ensure_checkpoint_dir
from revlens.sources.folders import remove_folder
from revlens.sources.sinks import write_tsv

# Output folder names.
RATINGS_OUTPUTS = ("item_averages", "genre_rating_pairs", "genre_averages",
                   "gender_averages", "age_group_averages")
REVIEWS_OUTPUTS = ("words", "word_freq_over", "count_by_category", "count_by_aspect",
                   "most_negative_aspect", "most_positive_aspect", "top_positive_words",
                   "top_negative_words", "top_related_words")


def item_report_lines(stats: DataFrame, items: DataFrame, min_count: int,
                      order_columns: bool = False) -> DataFrame:
    """``key, value``: one line per item of ``stats``, then the best-item line.

    The best item is picked on ``stats`` and only its own title looked up.

    With ``order_columns`` two more columns, ``_top`` (0 for items, 1 for
    the best-item line) and ``_id`` (item id text), give the original file
    order: items by id text, best-item line last.
    """
    lines = R.with_titles(stats, items).select(F.col("title").alias("key"),
                            fmt.item_line("avg_rating", "n_ratings").alias("value"),
                            F.lit(0).alias("_top"), F.col("item_id").cast("string").alias("_id"))
    best = R.best_titled(stats, items, min_count).select(
        F.lit(fmt.TOP_ITEM_KEY).alias("key"),
        fmt.top_item_line("title", "avg_rating", min_count).alias("value"),
        F.lit(1).alias("_top"), F.lit(None).cast("string").alias("_id"))
    lines = lines.unionByName(best)
    return lines if order_columns else lines.drop("_top", "_id")


def ratings_report(ratings: DataFrame, items: DataFrame, users: DataFrame, out_dir: str,
                   min_count: int = 5, age_bounds: Sequence[float] = (0, 18, 35, 50),
                   genre_separator: str = R.GENRE_SEPARATOR, mode: str = "overwrite",
                   single_file: bool = False, threads: int = 4) -> dict[str, str]:
    """Write the five rating outputs; returns ``{name: path}``.

    ``single_file`` holds for the aggregates; the (genre, rating) pairs grow
    with the ratings and stay in as many files as they have tasks.

    Three passes over the ratings instead of five: one (sum, count) row per
    item feeds the item lines, the best item and the genre averages; one
    join to the users feeds both the gender and the age-group averages; the
    (genre, rating) pairs are the third.  The two per-item results are
    written to the checkpoint folder, read back by their outputs and removed.
    Independent outputs are submitted from ``threads`` driver threads.
    """
    paths = {name: f"{out_dir}/{name}" for name in RATINGS_OUTPUTS}

    def out(name: str, df: DataFrame, order=None, hidden=()) -> None:
        # single-file outputs follow the original files' line order
        write_tsv(df, paths[name], mode, single_file,
                  order_by=order if single_file else None, hidden=hidden)

    ensure_checkpoint_dir(ratings.sparkSession)   # resolve once, before any thread
    genres = R.explode_genres(items, genre_separator)
    groups = R.age_group_names(age_bounds)
    people = R.age_groups(R.gender_sides(R.one_row_per_user(users)), age_bounds)
    rated = R.rate_by_people(ratings, people, "gender_side", "age_group")
    with Shared(ratings.sparkSession) as shared:
        run_concurrently(
            lambda: shared.store("sums", R.item_sums(ratings)),
            lambda: shared.store("groups", rated.groupBy("item_id").agg(
                *R.gender_average_columns(), *R.age_group_average_columns(age_bounds))),
            lambda: write_tsv(R.genre_rating_pairs(ratings, genres), paths["genre_rating_pairs"], mode),
            threads=threads)
        _item_outputs(shared, items, genres, groups, min_count, out, threads)
    return paths


def _item_outputs(shared: Shared, items: DataFrame, genres: DataFrame, groups: Sequence[tuple[str, str]],
                  min_count: int, out: Callable, threads: int) -> None:
    """The four outputs that follow from the per-item sums and user-group averages."""
    sums = shared["sums"]
    stats = sums.select("item_id", F.try_divide("s", "n").alias("avg_rating"),
                        F.col("n").alias("n_ratings"))
    by_genre = R.genre_averages(sums, genres)
    titled = R.with_titles(shared["groups"], items).withColumn(
        "_id", F.col("item_id").cast("string"))
    run_concurrently(
        lambda: out("item_averages",
                    item_report_lines(stats, items, min_count, True),
                    ["_top", "_id"], ["_top", "_id"]),
        lambda: out("genre_averages", by_genre.select(
            "genre", fmt.item_line("avg_rating", "n_ratings").alias("value")), ["genre"]),
        lambda: out("gender_averages", titled.select(
            "title", fmt.gender_line("male_avg", "female_avg").alias("value"), "_id"),
            ["_id"], ["_id"]),
        lambda: out("age_group_averages", titled.select(
            "title",
            fmt.bucket_line([g for g, _ in groups], [c for _, c in groups]).alias("value"),
            "_id"), ["_id"], ["_id"]),
        threads=threads)


def run_concurrently(*jobs: Callable[[], object], threads: int = 4) -> None:
    """Run independent Spark actions from a few driver threads.

    Each job is a small output that alone would leave most task slots idle;
    submitted together, the scheduler runs their stages side by side.  An
    exception in any job is re-raised.
    """
    if len(jobs) <= 1 or threads <= 1:
        for job in jobs:
            job()
        return
    with ThreadPoolExecutor(max_workers=min(threads, len(jobs))) as pool:
        for future in [pool.submit(job) for job in jobs]:
            future.result()


class Shared:
    """Intermediate tables of one run: parquet in the shared checkpoint folder, removed when the run ends, however it ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Shared:
        return self

    def store(self, name: str, df: DataFrame) -> None:
        self.paths[name] = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(self.paths[name])

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.paths[name])

    def __exit__(self, *failure) -> None:
        for path in self.paths.values():
            remove_folder(self.spark, path)


def reviews_report(reviews: DataFrame, stop_words: V.StopWords, out_dir: str,
                   threshold: int = 500, k: int = 5,
                   delimiters: str = DEFAULT_TOKEN_DELIMITERS, mode: str = "overwrite",
                   single_file: bool = False,
                   judgements: DataFrame | None = None, threads: int = 4) -> dict[str, str]:
    """Write the nine review outputs; returns ``{name: path}``.

    ``judgements`` (``rid, aspect``) feeds the per-aspect comment counts;
    it defaults to ``reviews``.  ``stop_words`` is a ``word`` table or an
    in-code list.

    The token relation itself is never stored as an intermediate: it is
    larger than the text, so writing and re-reading it on shared storage
    would cost more than tokenising twice (once for the ``words`` output,
    once for the shared counts); for its size it is never one file.  Independent outputs are submitted from
    ``threads`` driver threads so their small jobs overlap.
    """
    paths = {name: f"{out_dir}/{name}" for name in REVIEWS_OUTPUTS}

    def out(name: str, df: DataFrame, order=None) -> None:
        # single-file outputs follow the original files' line order
        write_tsv(df, paths[name], mode, single_file, order_by=order if single_file else None)

    top_order = ["category", F.desc("cnt"), "word"]
    ensure_checkpoint_dir(reviews.sparkSession)   # resolve once, before any thread
    words = V.clean_words(reviews, stop_words, delimiters)
    aspects = judgements if judgements is not None else reviews
    with Shared(reviews.sparkSession) as shared:
        run_concurrently(
            lambda: write_tsv(words, paths["words"], mode),
            lambda: shared.store("counts", V.word_counts(words, ["category", "sentiment"])),
            lambda: out("count_by_category", V.comment_counts(reviews, "category"), ["category"]),
            lambda: out("count_by_aspect", V.comment_counts(aspects, "aspect"), ["aspect"]),
            lambda: out("most_negative_aspect",
                        V.most_judged_aspect(reviews, "negative", "neg_count")),
            lambda: out("most_positive_aspect",
                        V.most_judged_aspect(reviews, "positive", "pos_count")),
            threads=threads)

        counts = shared["counts"]
        freq = counts.groupBy("word").agg(F.sum("cnt").alias("freq"))
        per_category = counts.groupBy("category", "word").agg(F.sum("cnt").alias("cnt"))
        run_concurrently(
            lambda: out("word_freq_over", freq.where(F.col("freq") > threshold), ["word"]),
            lambda: out("top_positive_words", V.top_words(counts, k, "positive"), top_order),
            lambda: out("top_negative_words", V.top_words(counts, k, "negative"), top_order),
            lambda: out("top_related_words", V.top_words(per_category, k), top_order),
            threads=threads)
    return paths


def run_ratings_files(spark: SparkSession, rating_paths: Sequence[str], items_path: str,
                      users_path: str, out_dir: str, **kw) -> dict[str, str]:
    """The rating lab on its original text inputs."""
    from revlens.sources.text_tables import read_items, read_ratings, read_users
    return ratings_report(read_ratings(spark, list(rating_paths)), read_items(spark, items_path, order=True),
                          read_users(spark, users_path, order=True), out_dir, **kw)


def run_reviews_files(spark: SparkSession, reviews_path: str, stop_words_path: str,
                      out_dir: str, quoting: bool = False, multiline: bool = False, **kw) -> dict[str, str]:
    """The review lab on its original text inputs."""
    from revlens.sources.text_tables import read_reviews, read_word_list
    return reviews_report(read_reviews(spark, reviews_path, quoting, multiline=multiline),
                          read_word_list(spark, stop_words_path), out_dir, **kw)
