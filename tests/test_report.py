import os

from revlens.operators import reviews as V
from revlens.plans.report import run_ratings_files, run_reviews_files
from revlens.sources import read_reviews, read_word_list
from tests.conftest import rows


def lines(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as fh:
                out.extend(fh.read().splitlines())
    return sorted(out)


def test_ratings_report(spark, tmp_path):
    (tmp_path / "r1.txt").write_text("1, 10, 4.0, 1\n2, 10, 4.5, 2\n3, 20, 3.0, 3\n")
    (tmp_path / "r2.txt").write_text("1, 20, 5.0, 4\n4, 30, 2.0, 5\n")
    (tmp_path / "m.txt").write_text("10, Heat (1995), Action|Crime\n20, Up (2009), Family\n")
    (tmp_path / "u.txt").write_text("1, M, 17, 1, 111\n2, F, 35, 2, 222\n3, F, 50, 3, 333\n")
    out = str(tmp_path / "out")
    paths = run_ratings_files(spark, [str(tmp_path / "r1.txt"), str(tmp_path / "r2.txt")],
                              str(tmp_path / "m.txt"), str(tmp_path / "u.txt"), out,
                              min_count=2)
    assert lines(paths["item_averages"]) == sorted([
        "Heat (1995)\t4.25 (TotalRatings: 2)", "Up (2009)\t4.00 (TotalRatings: 2)",
        "30\t2.00 (TotalRatings: 1)", "TOP_MOVIE\tHeat (1995) (Average: 4.25)"])
    assert lines(paths["genre_rating_pairs"]) == sorted([
        "Action\t4.0", "Action\t4.5", "Crime\t4.0", "Crime\t4.5", "Family\t3.0", "Family\t5.0"])
    assert lines(paths["genre_averages"]) == sorted([
        "Action\t4.25 (TotalRatings: 2)", "Crime\t4.25 (TotalRatings: 2)",
        "Family\t4.00 (TotalRatings: 2)"])
    assert lines(paths["gender_averages"]) == sorted([
        "Heat (1995)\tMale_Avg: 4.00, Female_Avg: 4.50",
        "Up (2009)\tMale_Avg: 5.00, Female_Avg: 3.00"])
    assert lines(paths["age_group_averages"]) == sorted([
        "Heat (1995)\t[0-18: 4.00, 18-35: 0.00, 35-50: 4.50, 50+: 0.00]",
        "Up (2009)\t[0-18: 5.00, 18-35: 0.00, 35-50: 0.00, 50+: 3.00]"])


def test_ratings_report_without_qualifying_item(spark, tmp_path):
    (tmp_path / "r.txt").write_text("1, 10, 4.0\n")
    (tmp_path / "m.txt").write_text("10, Heat, Action\n")
    (tmp_path / "u.txt").write_text("1, M\n")
    paths = run_ratings_files(spark, [str(tmp_path / "r.txt")], str(tmp_path / "m.txt"),
                              str(tmp_path / "u.txt"), str(tmp_path / "o"))
    assert "TOP_MOVIE\tNo movie has at least 5 ratings." in lines(paths["item_averages"])


def test_reviews_report_matches_direct_operators(spark, tmp_path):
    text = "\n".join([
        "1;Phòng rất đẹp, sạch;GENERAL;ROOMS;positive",
        "1;Phòng rất đẹp, sạch;GENERAL;HOTEL;positive",
        "2;Phòng bẩn, đẹp;PRICES;ROOMS;negative",
        "3;nhân viên đẹp (tốt);PRICES;SERVICE;positive",
        "4;giá đẹp;PRICES;HOTEL;neutral",
    ]) + "\n"
    (tmp_path / "rv.csv").write_text(text, encoding="utf-8")
    (tmp_path / "stop.txt").write_text("rất\n", encoding="utf-8")
    paths = run_reviews_files(spark, str(tmp_path / "rv.csv"), str(tmp_path / "stop.txt"),
                              str(tmp_path / "out"), threshold=2, k=2)
    reviews = read_reviews(spark, str(tmp_path / "rv.csv"))
    words = V.clean_words(reviews, read_word_list(spark, str(tmp_path / "stop.txt")))
    assert lines(paths["word_freq_over"]) == \
        ["\t".join(map(str, r)) for r in rows(V.word_freq_over(words, 2))]
    assert lines(paths["word_freq_over"]) == ["phòng\t3", "đẹp\t5"]
    assert lines(paths["count_by_category"]) == ["GENERAL\t2\t1", "PRICES\t3\t3"]
    assert lines(paths["most_positive_aspect"]) == ["HOTEL\t1"]
    assert lines(paths["top_related_words"]) == sorted([
        "GENERAL\tphòng\t2", "GENERAL\tsạch\t2", "PRICES\tđẹp\t3", "PRICES\tbẩn\t1"])
    assert lines(paths["top_negative_words"]) == sorted(["PRICES\tbẩn\t1", "PRICES\tphòng\t1"])
    assert len(lines(paths["words"])) == words.count()


def test_single_file_reports_keep_the_original_line_order(spark, tmp_path):
    (tmp_path / "r.txt").write_text("".join(f"{u}, {i}, 4.0\n" for u, i in
                                            [("1", "9"), ("1", "10"), ("2", "10"), ("2", "2")]))
    (tmp_path / "m.txt").write_text("9, Nine, B\n10, Ten, A|B\n2, Two, C\n")
    (tmp_path / "u.txt").write_text("1, M, 20\n2, F, 40\n")
    paths = run_ratings_files(spark, [str(tmp_path / "r.txt")], str(tmp_path / "m.txt"),
                              str(tmp_path / "u.txt"), str(tmp_path / "o"), min_count=2,
                              single_file=True)

    def raw(path):
        names = [n for n in os.listdir(path) if n.startswith("part-")]
        assert len(names) == 1
        with open(os.path.join(path, names[0]), encoding="utf-8") as fh:
            return fh.read().splitlines()
    # ids in text order 10 < 2 < 9, best-item line last
    assert [ln.split("\t")[0] for ln in raw(paths["item_averages"])] == \
        ["Ten", "Two", "Nine", "TOP_MOVIE"]
    assert [ln.split("\t")[0] for ln in raw(paths["genre_averages"])] == ["A", "B", "C"]
    assert [ln.split("\t")[0] for ln in raw(paths["gender_averages"])] == ["Ten", "Two", "Nine"]
