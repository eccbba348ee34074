"""Line order, quoted records, stored pairs, sinks, line numbers and number texts, on small files and small splits."""

import glob
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from revlens.functions.numbers import java_double, loaded_int
from revlens.operators import ratings as R
from revlens.operators.numbering import numbered
from revlens.plans.report import run_ratings_files
from revlens.sources import (parse_ratings, read_items, read_lines, read_pairs, read_ratings, read_reviews, read_users,
                             read_word_list, write_tsv)


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of a few bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "40b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "40"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_line_order_follows_lines_files_and_paths(spark, tmp_path, small_splits):
    b = put(tmp_path / "b.txt", "".join(f"b{i}\n" for i in range(60)))
    put(tmp_path / "a" / "2.txt", "".join(f"y{i}\n" for i in range(30)))
    put(tmp_path / "a" / "1.txt", "".join(f"x{i}\n" for i in range(30)))
    lines = read_lines(spark, [b, str(tmp_path / "a"), b], order=True)
    assert lines.select(F.spark_partition_id()).distinct().count() > 10
    got = [r.value for r in lines.orderBy("line_order").collect()]
    every = [f"b{i}" for i in range(60)]
    assert got == every + [f"x{i}" for i in range(30)] + [f"y{i}" for i in range(30)] + every
    assert read_lines(spark, [b, b]).count() == 120  # a path given twice is read twice


def test_last_line_of_an_item_and_user_wins(spark, tmp_path, small_splits):
    rng = random.Random(1)
    title, gender, files = {}, {}, ([], [])
    for part in range(2):
        items, users = "", ""
        for _ in range(200):
            i, word = str(rng.randrange(20)), rng.choice("klmnopqrstuvw") + str(rng.randrange(99))
            items += f"{i}, {word}, g\n"
            title[i] = word
            u, g = str(rng.randrange(30)), rng.choice("MFmfX")
            users += f"{u},{g}\n"
            gender[u] = g.upper()
        files[0].append(put(tmp_path / f"items{part}.txt", items))
        files[1].append(put(tmp_path / f"users{part}.txt", users))
    rated = [(str(rng.randrange(32)), str(rng.randrange(22)), float(rng.randrange(1, 6))) for _ in range(500)]
    ratings = spark.createDataFrame(rated, "user_id string, item_id string, rating double")
    got = R.rating_avg_by_gender(ratings, read_users(spark, files[1], order=True), read_items(spark, files[0], order=True))
    want = {}
    for u, i, r in rated:
        if u in gender:
            want.setdefault(i, {"M": [], "F": [], "X": []})[gender[u]].append(r)
    mean = lambda x: round(sum(x) / len(x), 9) if x else 0.0
    assert rows(got.select("item_id", "title", F.round("male_avg", 9), F.round("female_avg", 9))) == sorted(
        (i, title.get(i, i), mean(s["M"]), mean(s["F"])) for i, s in want.items())
    best = R.best_rated_item(ratings, read_items(spark, files[0], order=True), 1).first()
    assert best.title == title.get(best.item_id, best.item_id)


def test_files_run_takes_the_last_title(spark, tmp_path):
    ratings = put(tmp_path / "r.txt", "1,7,4\n1,8,3\n")
    items = put(tmp_path / "i.txt", "7, zebra, a\n8, only, b\n7, ant, a\n")
    users = put(tmp_path / "u.txt", "1,M,20\n1,F,20\n")
    out = run_ratings_files(spark, [ratings], items, users, str(tmp_path / "out"), min_count=1)
    assert rows(spark.read.text(out["gender_averages"])) == [("ant\tMale_Avg: 0.00, Female_Avg: 4.00",), ("only\tMale_Avg: 0.00, Female_Avg: 3.00",)]
    assert ("TOP_MOVIE\tant (Average: 4.00)",) in rows(spark.read.text(out["item_averages"]))


def test_a_table_without_line_order_keeps_the_largest(spark):
    ratings = spark.createDataFrame([("1", "7", 4.0)], "user_id string, item_id string, rating double")
    items = spark.createDataFrame([("7", "zebra"), ("7", "ant")], "item_id string, title string")
    assert R.rating_avg_by_item(ratings, items).first().title == "zebra"


# --------------------------------------------------------------- quoted records

def records_of(text, sep=";"):
    """A character-by-character model of quoted records; the break that ends a file's last line belongs to no field."""
    text = text.removesuffix("\n")
    out, fields, field, at = [], [], "", 0
    state = "start"  # start, plain, quoted, after
    quoted = False

    def close():
        nonlocal field, quoted, state
        fields.append(field if quoted or field else None)
        field, quoted, state = "", False, "start"

    while at < len(text):
        c = text[at]
        if state == "quoted":
            if c == '"' and text[at + 1:at + 2] == '"':
                field, at = field + '"', at + 1
            elif c == '"':
                state = "after"
            else:
                field += c
        elif c == "\n":
            if field.endswith("\r"):
                field = field[:-1]
            close()
            out.append(fields)
            fields = []
        elif c == sep:
            close()
        elif state == "start" and c in " \t":
            pass
        elif state == "start" and c == '"':
            state, quoted = "quoted", True
        else:
            field += c
            state = "plain" if state == "start" else state
        at += 1
    close()
    out.append(fields)
    out = [f for f in out if f != [None]]
    return [tuple((f + [None] * 5)[1:5]) for f in out]


def test_quoted_records_against_a_model(spark, tmp_path, small_splits):
    rng = random.Random(5)
    for trial in range(6):
        text = "".join(rng.choice(['a', 'b"', '"', '""', ';', ';"', '";', '\n', ' ', 'c\n"', '"\n', 'long words here']) for _ in range(250)) + "\n"
        path = put(tmp_path / f"{trial}.csv", text)
        got = read_reviews(spark, path, quoting=True, multiline=True)
        assert rows(got, "review", "category", "aspect", "sentiment") == sorted(records_of(text), key=lambda t: tuple(str(x) for x in t))


def test_quoted_records_of_several_files_and_ends_of_lines(spark, tmp_path):
    a = put(tmp_path / "a.csv", '1;"two\r\nlines";c;a;s\r\n2;x;y;z;w\r\n')
    b = put(tmp_path / "b.csv", '﻿3;"open;\nto the end')
    got = read_reviews(spark, [a, b], quoting=True, multiline=True)
    assert rows(got) == [(1, "two\r\nlines", "c", "a", "s"), (2, "x", "y", "z", "w"), (3, "open;\nto the end", None, None, None)]


def test_quoted_lines_have_no_field_limit(spark, tmp_path):
    path = put(tmp_path / "wide.csv", '1;"a""b;c";d;e;f' + ";" * 2_000_000 + "\n2;" + '"' + '""' * 100_000 + '";k\n\n  \n')
    got = rows(read_reviews(spark, path, quoting=True))
    assert got == [(1, 'a"b;c', "d", "e", "f"), (2, '"' * 100_000, "k", None, None)]


def test_quoted_lines_empty_and_short(spark, tmp_path):
    path = put(tmp_path / "q.csv", '"12.9";"";;a\n 3; "x"y ;z "q"\nn;"not closed;c\n')
    assert rows(read_reviews(spark, path, quoting=True)) == [(12, "", None, "a", None), (3, "xy ", 'z "q"', None, None), (None, "not closed;c", None, None, None)]
    with pytest.raises(ValueError):
        read_reviews(spark, path, quoting=True, sep="ab")


def test_byte_order_mark_goes_only_at_the_start_of_a_file(spark, tmp_path, small_splits):
    a = put(tmp_path / "a.csv", "﻿1;x\n﻿2;y\n" + "3;z\n" * 30 + "﻿4;w\n")
    b = put(tmp_path / "b.csv", "﻿5;v\n")
    got = [r.rid for r in read_reviews(spark, [a, b]).collect()]
    assert sorted(got, key=str) == sorted([1, None, *[3] * 30, None, 5], key=str)
    assert [r.word for r in read_word_list(spark, put(tmp_path / "w.txt", "﻿the\n﻿of\n")).collect()] == ["the", "﻿of"]


# ------------------------------------------------------------------ stored pairs

def test_pairs(spark, tmp_path):
    path = put(tmp_path / "pairs", " Drama \t 4.5\nCrime\t3\tmore\nalone\nx\t\n\t2\n\n\t\t\n")
    assert rows(read_pairs(spark, path)) == [("", 2.0), ("Crime", 3.0), ("Drama", 4.5)]
    bad = put(tmp_path / "bad", "a\tb\n")
    with pytest.raises(Exception, match="bad rating"):
        read_pairs(spark, bad).collect()
    assert rows(read_pairs(spark, bad, "null")) == [("a", None)]


# ------------------------------------------------------------------------- sinks

def lines_of(folder):
    return sorted(line for f in glob.glob(f"{folder}/part-*") for line in open(f).read().splitlines())


def test_refuse_and_replace(spark, tmp_path):
    out = str(tmp_path / "out")
    old, new = (spark.createDataFrame([(w, 1)], "k string, n int") for w in ("old", "new"))
    write_tsv(old, out)
    with pytest.raises(Exception, match="(?i)exists"):
        write_tsv(new, out)
    assert lines_of(out) == ["old\t1"]
    write_tsv(new, out, "overwrite")
    assert lines_of(out) == ["new\t1"] and os.listdir(tmp_path) == ["out"]


def test_a_failing_replacement_leaves_the_old_result(spark, tmp_path):
    out = str(tmp_path / "out")
    write_tsv(spark.createDataFrame([("old",)], "k string"), out, "overwrite")
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise("x").alias("k"))
    with pytest.raises(Exception, match="broken"):
        write_tsv(broken, out, "overwrite")
    assert lines_of(out) == ["old"] and os.listdir(tmp_path) == ["out"]


# ----------------------------------------------------------------------- numbers

def test_numbered(spark):
    n = 5000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("v"), F.lit("x").alias("line_no")).repartition(7)
    got = numbered(df, [F.desc("v")])
    assert got.columns == ["line", "v", "line_no"]
    assert rows(got, "line", "v") == sorted(((i + 1, n - 1 - i) for i in range(n)), key=lambda t: tuple(map(str, t)))
    assert numbered(spark.range(0), ["id"]).count() == 0
    ties = numbered(spark.createDataFrame([(None,), (1,), (1,)], "v int"), ["v"], "n", 0)
    assert sorted((r.n, r.v) for r in ties.collect() if r.n) == [(1, 1), (2, 1)]
    with pytest.raises(ValueError):
        numbered(spark.createDataFrame([(1,)], "line int"), ["line"])


TEXTS = {  # text: double, integer
    "12.7": (12.7, 12), " 3": (3.0, 3), "-12.7": (-12.7, -12), "+5": (5.0, 5), "2147483647": (2147483647.0, 2147483647),
    "2147483648": (2147483648.0, None), "-2147483648": (-2147483648.0, -2147483648), "-2147483648.5": (-2147483648.5, -2147483648),
    "2147483647.9": (2147483647.9, 2147483647), "-2147483649": (-2147483649.0, None), "1e3": (1000.0, 1000), "1e10": (1e10, None),
    ".5": (0.5, 0), "5.": (5.0, 5), "3f": (3.0, 3), "3D": (3.0, 3), "": (None, None), "x": (None, None), "1 2": (None, None),
    "inf": (None, None), "nan": (None, None), "Infinity": (float("inf"), None), "-Infinity": (float("-inf"), None), "1_0": (None, None),
    "0x10": (None, None), "0x1p0": (1.0, 1), "0x1.8p1": (3.0, 3), "-0X.8P+1d": (-1.0, -1), "0xAp-1f": (5.0, 5), "0x.p1": (None, None),
    "0x1.fffffffffffffp1023": (1.7976931348623157e308, None), "0x1p1024": (float("inf"), None), "0x1p-1074": (5e-324, 0), "0x1p-1076": (0.0, 0),
    "0x1.00000000000008p0": (1.0, 1), "0x1.00000000000008001p0": (1.0000000000000002, 1), "0x1.000000000000080000000001p0": (1.0000000000000002, 1),
    "0x1.00000000000018p0": (1.0000000000000004, 1), "0x0p5": (0.0, 0), "0x00000000000000000000000000001p3": (8.0, 8),
    "0x1p99999999999": (float("inf"), None), "0x1p-99999999999": (0.0, 0), None: (None, None)}


def test_number_texts(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    from revlens.functions.text import java_trim
    got = {r.t: (r.d, r.i) for r in df.select("t", java_double(java_trim("t")).alias("d"), loaded_int(F.col("t")).alias("i")).collect()}
    assert got == TEXTS


def test_hexadecimal_texts_against_python(spark):
    rng = random.Random(2)
    texts = [(rng.choice(["", "-", "+"]) + "0x" + "".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(1, 25)))
              + rng.choice(["", "." + "".join(rng.choice("0123456789ABCDEF") for _ in range(rng.randrange(25)))]) + f"p{rng.randrange(-900, 900)}") for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r.d == float.fromhex(r.t) for r in df.select("t", java_double(F.col("t")).alias("d")).collect())


def test_rating_lines_are_cut_once(spark):
    """No filter evaluates the line or a regular expression."""
    lines = spark.createDataFrame([("1, 2, 3",)], "value string").select(F.concat(F.col("value"), F.lit(" ")).alias("value"))
    plan = parse_ratings(lines)._jdf.queryExecution().optimizedPlan().toString()
    filters = [x for x in plan.splitlines() if "Filter" in x]
    assert filters and plan.count("concat(value") == 1 and "split(" in plan
    assert not any(word in f.lower() for f in filters for word in ("rlike", "regexp", "split(", "concat(", " trim("))


def test_several_rating_files(spark, tmp_path):
    a, b = put(tmp_path / "a", "1,2,3\n\n"), put(tmp_path / "b", "1,2,3\n4,5\n")
    assert rows(read_ratings(spark, [a, b, a], order=True).select("line_order.input", "user_id", "item_id", "rating")) == [
        (0, "1", "2", 3.0), (1, "1", "2", 3.0), (2, "1", "2", 3.0)]
