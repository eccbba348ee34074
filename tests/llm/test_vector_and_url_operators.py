"""Vector search, vector near-duplicates and URL rules against brute force."""

import random
import re

import numpy as np
import pytest

from revlens.llm import graph_dedup, rabitq, url_rules

BAD = [(901, None, 1), (902, [float("nan")] * 8, 1), (903, [0.0] * 8, 1), (904, [None] + [1.0] * 7, 1), (905, [float("inf")] + [0.0] * 7, 1),
       (906, [], 1), (907, [1.0, 2.0], 1)]


def vectors(spark, n=700, seed=3):
    r = np.random.default_rng(seed)
    centre = r.standard_normal(8)
    data = []
    for i in range(n):
        v = r.standard_normal(8) if i % 3 else centre + 0.12 * r.standard_normal(8)    # a third in one dense group
        if i % 10 == 9:
            v = np.array(data[-1][1])                                                  # equal vectors
        data.append((i, [float(x) for x in v], None if i % 50 == 7 else i % 4))
    schema = "vec_id long, embedding array<double>, label int, copies int, u string, cells string"
    return data, spark.createDataFrame([(*d, 1, "u", "c") for d in data + BAD], schema)


def test_search_equals_brute_force(spark):
    data, df = vectors(spark)
    got = {}
    for r in rabitq.search(df, every=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x, ids = np.array([d[1] for d in data]), np.array([d[0] for d in data])
    hits = 0
    for q in range(0, 700, 20):
        score = x @ x[q]
        score[q] = -np.inf
        want = ids[np.lexsort((ids, -np.round(score, 12)))[:20]].tolist()
        rows = sorted(got[q])
        assert [r[0] for r in rows] == list(range(1, 21)) and all(abs(s - score[v]) < 1e-9 for _, v, s in rows)
        hits += len(set(want) & {v for _, v, _ in rows})
    assert hits >= 0.99 * 35 * 20 and set(got) == set(range(0, 700, 20))


def test_search_on_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0])], schema)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in rabitq.search(one).collect()) == [(0, 1, 20), (0, 2, 3), (20, 1, 0), (20, 2, 3)]
    for rows in ([], [(0, None)], [(0, [0.0, 0.0])]):
        assert rabitq.search(spark.createDataFrame(rows, schema)).count() == 0


def test_estimates_stay_within_their_bounds():
    r = np.random.default_rng(2)
    x = r.standard_normal((3000, 64))
    codes = rabitq.fit(x[:500], 4)
    cell, bits, length, align = codes.encode(x)
    q = r.standard_normal((40, 64))
    mine = cell == 0
    est, err = codes.estimate(q, 0, bits[mine], length[mine], align[mine])
    assert (np.abs(est - q @ x[mine].T) <= err).mean() > 0.9999


def test_links_and_components_equal_brute_force(spark):
    data, df = vectors(spark)
    got = {r.vec_id: r for r in graph_dedup.near_vectors(df).collect()}
    x = np.array([d[1] for d in data])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    label = np.array([-1 if d[2] is None else d[2] for d in data])
    near = (u @ u.T >= 0.93 - 1e-12) & (label[:, None] == label) & (label >= 0)[:, None]
    np.fill_diagonal(near, False)
    root = list(range(len(data)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in zip(*np.nonzero(near)):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    true = near.sum(axis=1)
    assert sum(got[i].n_links for i in range(len(data))) >= 0.99 * true.sum()
    assert all(got[i].n_links <= true[i] for i in range(len(data)))
    assert [got[i].component_id for i in range(len(data))] == [find(i) for i in range(len(data))]
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i, _, _ in BAD)
    assert graph_dedup.audit_recall(df, graph_dedup.near_vectors(df)) >= 0.99


def test_blocks_of_a_large_shard_count_each_pair_once(spark, monkeypatch):
    data, df = vectors(spark)
    whole = sorted(map(tuple, graph_dedup.near_vectors(df).collect()), key=str)
    monkeypatch.setattr(graph_dedup, "BLOCK", 40)
    assert sorted(map(tuple, graph_dedup.near_vectors(df).collect()), key=str) == whole


def spread(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in points], "vec_id long, embedding array<double>, label int")


def test_a_star_and_a_chain_are_one_component_each(spark):
    r = np.random.default_rng(5)
    centre, leaves = np.eye(64)[0], np.linalg.qr(r.standard_normal((63, 40)))[0].T       # leaves: 0.95 to the centre, 0.90 to each other
    star = [(i, np.concatenate([[0.95], np.sqrt(1 - 0.95**2) * leaf])) for i, leaf in enumerate(leaves)] + [(500, centre)]
    got = {x.vec_id: x for x in graph_dedup.near_vectors(spread(spark, star)).collect()}
    assert {x.component_id for x in got.values()} == {0} and [i for i in got if got[i].kept] == [0]
    assert got[500].n_links == 40 and all(got[i].n_links == 1 for i in range(40))
    turn = np.arccos(0.95) * np.arange(12)                                               # each one is near the next only
    chain = list(zip(r.permutation(12).tolist(), np.stack([np.cos(turn), np.sin(turn)], axis=1)))
    got = {x.vec_id: x for x in graph_dedup.near_vectors(spread(spark, chain)).collect()}
    assert {x.component_id for x in got.values()} == {0} and sorted(x.n_links for x in got.values()) == [1, 1] + [2] * 10


@pytest.mark.parametrize("block", [100, 16384])
def test_links_across_many_cells_are_all_found(spark, monkeypatch, block):
    monkeypatch.setattr(graph_dedup, "PER_CELL", 5)
    monkeypatch.setattr(graph_dedup, "WIDE_BLOCK", block, raising=False)
    r = np.random.default_rng(8)
    x = r.standard_normal((300, 3))                                                      # cells narrower than the range
    x = np.concatenate([x, x[:20]])                                                      # copies
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    df = spread(spark, enumerate(x))
    out = graph_dedup.near_vectors(df)
    got = {row.vec_id: row for row in out.collect()}
    assert [got[i].n_links for i in range(len(x))] == near.sum(axis=1).tolist()
    assert graph_dedup.audit_recall(df, out) == 1.0
    name = np.arange(len(x))
    for a, b in zip(*np.nonzero(near)):
        graph_dedup.join(name, a, np.array([b]))
    assert [got[i].component_id for i in range(len(x))] == name.tolist()


def test_vectors_of_empty_and_unusable_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert graph_dedup.near_vectors(spark.createDataFrame([], schema)).count() == 0
    out = graph_dedup.near_vectors(spark.createDataFrame([(4, None, 1), (None, [1.0], 1), (5, [1.0], None)], schema)).collect()
    assert sorted(map(tuple, out), key=str) == sorted([(4, 0, 4, True), (None, 0, None, False), (5, 0, 5, True)], key=str)


# ------------------------------------------------------------------ URLs

def model(url):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host = "" if rest is None else re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = "" if rest is None else re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
    if rule is None:
        globs = ["".join(".*" if c == "*" else re.escape(c) for c in g) for g in url_rules.BLOCKED_HOSTS]
        verdict = "block" if any(re.fullmatch(g, host, re.S) for g in globs) else "allow"
    return host, path, rule, verdict


def test_urls_equal_a_model(spark):
    r = random.Random(6)
    parts = ["http", "://", "www.", "Example", ".net", ".com", ".org", "/", "/en/", "/de/", "/fr/", "?", "#", "casino", "ads.", "a.net", "free-bets", "É", "\n", "*", "-win.", ":80"]
    urls = [None, "", "no scheme", "http://" + "a" * 5000 + ".net/" + "b" * 50_000] + ["".join(r.choice(parts) for _ in range(r.randint(1, 9))) for _ in range(1500)]
    urls += ["http://" + "".join(r.choice(parts[2:]) for _ in range(r.randint(1, 6))) for _ in range(1500)]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_rules.judge_urls(df).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == model(u), u
    assert url_rules.judge_urls(df.limit(0)).count() == 0


@pytest.mark.parametrize("pattern, yes, no", [("a*b?c", ["abxc", "axxbbc"], ["abc", "xabxc"]), ("*", ["", "x"], []), (r"a\*b", ["a*b"], ["axb"]), ("", [""], ["a"]),
                                              ("x" * 130 + "*y", ["x" * 130 + "y", "x" * 140 + "zy"], ["x" * 129 + "y"])])
def test_globs_over_word_borders(pattern, yes, no):
    automaton = url_rules.ShiftAnd([url_rules.glob("pad*ding" * 9), url_rules.glob(pattern)])
    assert automaton.matches([u.encode() for u in yes + no])[:, 1].tolist() == [True] * len(yes) + [False] * len(no)
