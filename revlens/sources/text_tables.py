"""Readers for the header-less text inputs of the original jobs.

All readers take one path or a list of paths (several files read as one
input, duplicates kept) and return typed DataFrames of the data model.
They are plain scans: every file is split across tasks by Spark.

Comma-separated lines follow the original parsing: the line is trimmed
(Java rules), blank lines are skipped, fields are split on ``,\\s*`` and a
line with too few fields is skipped.  Without a split limit, trailing empty
fields do not count, so ``7,42,`` has two fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.numbers import java_double, loaded_int
from revlens.functions.text import java_trim

REVIEW_SCHEMA = T.StructType([
    T.StructField("rid", T.IntegerType()),
    T.StructField("review", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("aspect", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])

Paths = str | Sequence[str]


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


#: Where a line stands: the place of its path in the list, its file, the split's first byte, the line within the task.
ORDER = "line_order"


def read_lines(spark: SparkSession, paths: Paths, order: bool = False, line_sep: str | None = None) -> DataFrame:
    """``value``: the lines of all files; a path given twice is read twice.

    With ``order`` there is also ``line_order``, which rises from line to line
    and from path to path however the files are split: a split's lines are
    numbered by the task that reads it, in order.  Files of one folder are in
    the order of their names.  The scan drops a byte-order mark that opens a
    file; U+FEFF anywhere else stays.
    """
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    if not order and len(set(_paths(paths))) == len(_paths(paths)):
        return reader.text(_paths(paths))
    frames = []
    for i, path in enumerate(_paths(paths)):
        where = F.struct(F.lit(i).alias("input"), F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
        frames.append(reader.text(path).select("value", *([where.alias(ORDER)] if order else [])))
    return reduce(DataFrame.unionByName, frames)


def _order(lines: DataFrame) -> list[str]:
    return [ORDER] if ORDER in lines.columns else []


# Fixed value: what the separator swallows after a comma.
_BLANKS = " \t\n\x0b\f\r"


def _fields(lines: DataFrame, limit: int = -1) -> DataFrame:
    """``f``: the fields of each line of a ``value`` text column, cut at commas alone.

    Generated from an array of one, so that no later filter or projection
    evaluates the line again.
    """
    return lines.select(*_order(lines), F.explode(F.array(F.split(java_trim("value"), ",", limit))).alias("f"))


def _reaches(i: int) -> Column:
    """Whether field ``i`` is left when trailing empty fields are dropped."""
    return F.exists(F.slice("f", i + 1, F.size("f")), lambda x: F.ltrim(x, F.lit(_BLANKS)) != "")


def _field(i: int) -> Column:
    """Field ``i`` trimmed, or null when the line has fewer fields."""
    return java_trim(F.get(F.col("f"), i))


def _number(text: Column, on_error: str, what: str) -> Column:
    """A double; ``on_error='fail'`` raises on bad text, ``'null'`` yields null."""
    parsed = java_double(text)
    if on_error == "null":
        return parsed
    if on_error != "fail":
        raise ValueError("on_error must be 'fail' or 'null'")
    return F.when(text.isNotNull(), F.coalesce(parsed, F.raise_error(F.concat(F.lit(f"bad {what}: '"), text, F.lit("'"))).cast("double")))


def read_ratings(spark: SparkSession, paths: Paths, on_error: str = "fail", order: bool = False) -> DataFrame:
    """``user_id, item_id, rating, ts`` from ``user, item, rating[, timestamp]`` lines."""
    return parse_ratings(read_lines(spark, paths, order), on_error)


def parse_ratings(lines: DataFrame, on_error: str = "fail") -> DataFrame:
    """Rating rows from a ``value`` line column; a ``line_order`` column is kept.

    A bad rating fails the job by default (``on_error='null'`` keeps the row
    with a null rating).  The timestamp is optional and never required.
    """
    return (_fields(lines).where(_reaches(2))
            .select(_field(0).alias("user_id"), _field(1).alias("item_id"),
                    _number(_field(2), on_error, "rating").alias("rating"),
                    _field(3).try_cast("bigint").alias("ts"), *_order(lines)))


def read_items(spark: SparkSession, paths: Paths, order: bool = False) -> DataFrame:
    """``item_id, title, genres`` from ``id, title, genres`` lines.

    At most three fields, so a comma inside the genres text survives.  A
    line with only two fields still names its item (``genres`` is null).
    """
    return parse_items(read_lines(spark, paths, order))


def parse_items(lines: DataFrame) -> DataFrame:
    """Item rows from a ``value`` line column; a ``line_order`` column is kept."""
    return (_fields(lines, limit=3).where(F.size("f") >= 2)
            .select(_field(0).alias("item_id"), _field(1).alias("title"),
                    _field(2).alias("genres"), *_order(lines)))


def read_users(spark: SparkSession, paths: Paths, order: bool = False) -> DataFrame:
    """``user_id, gender, age, occupation, zip``; lines need id and gender."""
    return parse_users(read_lines(spark, paths, order))


def parse_users(lines: DataFrame) -> DataFrame:
    """User rows from a ``value`` line column; a ``line_order`` column is kept."""
    return (_fields(lines).where(_reaches(1))
            .select(_field(0).alias("user_id"), _field(1).alias("gender"),
                    _field(2).try_cast("int").alias("age"),
                    _field(3).try_cast("int").alias("occupation"),
                    F.when(_reaches(4), _field(4)).alias("zip"), *_order(lines)))


def read_pairs(spark: SparkSession, paths: Paths, on_error: str = "fail") -> DataFrame:
    """``genre, rating`` from stored ``genre<TAB>rating`` lines."""
    return parse_pairs(read_lines(spark, paths), on_error)


def parse_pairs(lines: DataFrame, on_error: str = "fail") -> DataFrame:
    """Pairs from a ``value`` line column: both fields trimmed, lines of fewer than two fields dropped, later fields ignored."""
    f = lines.select(F.explode(F.array(F.split("value", "\t", -1))).alias("f"))
    return (f.where(F.exists(F.slice("f", 2, F.size("f")), lambda x: x != ""))
            .select(_field(0).alias("genre"), _number(_field(1), on_error, "rating").alias("rating")))


def read_reviews(spark: SparkSession, paths: Paths, quoting: bool = False,
                 sep: str = ";", multiline: bool = False) -> DataFrame:
    """``rid, review, category, aspect, sentiment`` from delimited lines.

    With ``quoting=False`` a double quote is an ordinary character, so
    ``"a;b`` splits at the separator.  Short lines are padded with nulls,
    extra fields are dropped, however many, and a ``rid`` that isn't a number
    becomes null.  ``quoting=True`` honours double quotes (``parse_quoted_reviews``),
    and with ``multiline`` also line breaks between them (``quoted_records``).
    """
    if not quoting:
        return parse_reviews(read_lines(spark, paths), sep)
    if not multiline:
        return parse_quoted_reviews(read_lines(spark, paths), sep)
    return parse_quoted_reviews(quoted_records(read_lines(spark, paths, order=True, line_sep="\n"), sep), sep)


def _literal(sep: str) -> str:
    """``sep`` as a pattern; a plain character stays one, which splits without a regular expression."""
    return sep if len(sep) == 1 and sep not in ".$|()[{^?*+\\" else "\\Q" + sep + "\\E"


def _review_columns(fields: list[Column]) -> list[Column]:
    return [(loaded_int(c) if field.name == "rid" else c).alias(field.name) for c, field in zip(fields, REVIEW_SCHEMA)]


def parse_reviews(lines: DataFrame, sep: str = ";") -> DataFrame:
    """Review rows from a ``value`` line column, without quoting.

    An empty field is null; a blank line is a row of nulls.
    """
    f = lines.select(F.explode(F.array(F.split("value", _literal(sep), -1))).alias("f"))
    return f.select(*_review_columns([F.nullif(F.get("f", F.lit(i)), F.lit("")) for i in range(len(REVIEW_SCHEMA))]))


def _quoted_field(sep: str, closed: bool = False) -> str:
    """A pattern of one field: blanks, then a quoted part with doubled quotes and what follows it, or plain text.

    A quote that is never closed runs to the end, unless the field has to be
    ``closed``.  All parts are possessive: no text is too long.
    """
    plain = f"[^{sep}]*+"
    rest = f'"{plain}' if closed else f'(?:"{plain}|\\z)'
    return f'[ \\t]*+(?:"(?:[^"]++|"")*+{rest}|(?!"){plain})'


def _one_char(sep: str) -> str:
    if len(sep) != 1 or sep in '"^]\\- \t\r\n':
        raise ValueError("with quoting, the separator is one plain character")
    return sep


def parse_quoted_reviews(records: DataFrame, sep: str = ";") -> DataFrame:
    """Review rows from a ``value`` column of one record each, honouring double quotes.

    A field is quoted when its first character after blanks is a quote; a
    doubled quote in it is one quote, text after its end belongs to the field,
    and a quote that isn't closed takes the rest.  Other quotes are ordinary
    characters.  Only the record's first five fields are cut out, however many
    it has.  An empty plain field is null, an empty quoted one is empty; blank
    records are skipped.
    """
    field, n = _quoted_field(_one_char(sep)), len(REVIEW_SCHEMA)
    first = F.regexp_extract("value", f"^{field}(?:{sep}{field}){{0,{n - 1}}}+", 0)
    cut = (records.where(F.btrim(F.col("value"), F.lit(" \t\r")) != "")
           .select(F.explode(F.array(F.regexp_extract_all(F.concat(F.lit(sep), first), F.lit(f"{sep}({field})"), F.lit(1)))).alias("f")))

    def text(raw: Column) -> Column:
        inner = F.regexp_extract(raw, '^"((?:[^"]++|"")*+)', 1)
        return (F.when(raw.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), F.substr(raw, F.length(inner) + 3)))
                 .otherwise(F.nullif(raw, F.lit(""))))

    fields = cut.select(F.transform(F.slice("f", 1, n), lambda x: text(F.ltrim(x, F.lit(" \t")))).alias("f"))
    return fields.select(*_review_columns([F.get("f", F.lit(i)) for i in range(n)]))


def quoted_records(lines: DataFrame, sep: str = ";") -> DataFrame:
    """``value``: records, from lines with ``line_order``: a line that ends within quotes goes on in the next.

    Whether a line begins within quotes depends on all lines before it in its
    file.  But a line either fixes how it ends, keeps it, or turns it round, so
    each split comes down to one such step, and only the splits' steps meet, a
    row each; then every split's lines are settled by themselves.  A record's
    lines are brought together by its number.  No field or record has a limit
    but that of a text value.
    """
    sep = _one_char(sep)
    closed, inner = _quoted_field(sep, closed=True), '(?:[^"]++|"")*+'
    opens = f"(?:{sep}[ \\t]*+\"{inner})\\z"
    line = F.col("value")
    plain = lambda text: text.rlike(f"^(?:{closed}(?:{sep}{closed})*+)?{opens}|^[ \\t]*+\"{inner}\\z")
    after = F.regexp_extract(line, f'^{inner}"([^{sep}]*+)((?s:.*))$', 2)  # what follows the field that the quote ends
    within = line.rlike(f"^{inner}\\z") | (after.startswith(sep) & F.concat(F.lit("x"), after).rlike(f"^(?:x(?:{sep}{closed})*+)?{opens}"))
    split = ["input", "file", "start"]
    each = lines.select("value", "line_order.*").withColumn("from_out", plain(line)).withColumn("from_in", within)
    each = each.withColumn("fixed", F.when(F.col("from_out") == F.col("from_in"), F.col("from_out")))
    each = each.withColumn("turns", (F.col("from_out") & ~F.col("from_in")).cast("int"))
    upto = Window.partitionBy(*split).orderBy("line")
    turned = F.sum("turns").over(upto)
    stood = each.withColumn("turned", turned).withColumn("last", F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turned")), True).over(upto))

    def state(entry: Column) -> Column:
        """How a line ends, if its split begins within quotes or not."""
        begin = F.coalesce(F.col("last.fixed"), entry)
        return begin != (F.pmod(F.col("turned") - F.coalesce(F.col("last.turned"), F.lit(0)), F.lit(2)) == 1)

    ends = stood.groupBy(*split).agg(F.max_by(F.struct(state(F.lit(False)).alias("out"), state(F.lit(True)).alias("in")), "line").alias("end"))
    before = Window.partitionBy("input", "file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    steps = ends.withColumn("fixed", F.when(F.col("end.out") == F.col("end.in"), F.col("end.out")))
    steps = steps.withColumn("turned", F.coalesce(F.sum((F.col("end.out") & ~F.col("end.in")).cast("int")).over(before), F.lit(0)))
    known = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "after")), True).over(before)
    steps = steps.withColumn("after", F.col("turned") + (F.col("end.out") & ~F.col("end.in")).cast("int")).withColumn("known", known)
    entry = F.coalesce(F.col("known.fixed"), F.lit(False)) != (F.pmod(F.col("turned") - F.coalesce(F.col("known.after"), F.lit(0)), F.lit(2)) == 1)
    entered = steps.select(*split, entry.alias("entry"))
    settled = stood.join(entered, split).withColumn("open", state(F.col("entry")))
    begun = F.coalesce(F.lag("open").over(upto), F.col("entry"))
    # a record's name: the last line up to this one that doesn't begin within quotes; a split's first lines may belong to an earlier one
    own = F.last(F.when(~begun, F.struct("start", "line")), True).over(upto)
    named = settled.withColumn("own", own)
    heads = named.groupBy(*split).agg(F.max("own").alias("head"))
    earlier = heads.select(*split, F.last("head", True).over(before).alias("earlier"))
    records = named.join(earlier, split).withColumn("record", F.coalesce("own", "earlier"))
    parts = F.sort_array(F.collect_list(F.struct("start", "line", "value")))
    whole = records.groupBy("input", "file", "record").agg(F.transform(parts, lambda p: p["value"]).alias("p"))
    return whole.select(F.regexp_replace(F.array_join("p", "\n"), "\r\\z", "").alias("value"))


def read_word_list(spark: SparkSession, paths: Paths) -> DataFrame:
    """``word``: one entry per line, taken as is."""
    return read_lines(spark, paths).withColumnRenamed("value", "word")
