import json
import os

from revlens.__main__ import main


def _lines(path):
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as fh:
                out.extend(fh.read().splitlines())
    return sorted(out)


def test_cli_ratings_and_reviews(spark, tmp_path, capsys):
    (tmp_path / "r1.txt").write_text("1, 10, 4.0, 1\n2, 10, 5.0, 2\n")
    (tmp_path / "r2.txt").write_text("1, 20, 3.0, 3\n")
    (tmp_path / "m.txt").write_text("10, Heat, Action|Crime\n20, Up, Family\n")
    (tmp_path / "u.txt").write_text("1, M, 20\n2, F, 40\n")
    main(["--local", "ratings", "--ratings", str(tmp_path / "r1.txt"), str(tmp_path / "r2.txt"),
          "--items", str(tmp_path / "m.txt"), "--users", str(tmp_path / "u.txt"),
          "--out", str(tmp_path / "out"), "--min-count", "2", "--single-file"])
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert "TOP_MOVIE\tHeat (Average: 4.50)" in _lines(paths["item_averages"])

    (tmp_path / "rv.csv").write_text("1;Rất đẹp;GENERAL;HOTEL;positive\n", encoding="utf-8")
    (tmp_path / "stop.txt").write_text("rất\n", encoding="utf-8")
    main(["--local", "reviews", "--reviews", str(tmp_path / "rv.csv"),
          "--stop-words", str(tmp_path / "stop.txt"), "--out", str(tmp_path / "rv"),
          "--threshold", "0"])
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert _lines(paths["word_freq_over"]) == ["đẹp\t1"]


def test_cli_registered_query(spark, tmp_path, capsys):
    main(["--local", "query", "count_by_aspect", "--sf-dir", "/root/testdata/sf0.001",
          "--out", str(tmp_path / "q")])
    lines = _lines(str(tmp_path / "q"))
    assert {ln.split("\t")[0] for ln in lines} == {"system", "user", "assistant"}


def test_cli_explain(spark, capsys):
    main(["--local", "explain", "top5_related_words", "--sf-dir", "/root/testdata/sf0.001",
          "--mode", "simple"])
    assert "WindowGroupLimit" in capsys.readouterr().out
