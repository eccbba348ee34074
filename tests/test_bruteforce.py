"""Random small inputs: every operator against a plain-Python model."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from revlens.functions.text import DEFAULT_TOKEN_DELIMITERS
from revlens.operators import ratings as R
from revlens.operators import reviews as V

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ids = st.sampled_from(["1", "2", "3", "10", "20", "x"])
users_ids = st.sampled_from(["a", "b", "c", "d"])
rating_rows = st.lists(st.tuples(users_ids, ids, st.integers(1, 5).map(float)), max_size=30)
item_rows = st.lists(st.tuples(ids, st.sampled_from(["T1", "T2", "T3"]),
                               st.sampled_from(["A", "A|B", "B|B", "C|", "|A"])), max_size=6)
user_rows = st.lists(st.tuples(users_ids, st.sampled_from(["M", "f", "X"]),
                               st.sampled_from([-1.0, 0.0, 17.0, 18.0, 35.0, 49.0, 50.0])),
                     max_size=7)


def _genres(text):
    parts = text.split("|")
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    if parts == [""] and text:
        return []
    return [p.strip() for p in parts]


def _close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 1e-9)


@SETTINGS
@given(rating_rows, item_rows, user_rows)
def test_rating_operators_against_model(spark, ratings_data, items_data, users_data):
    ratings = spark.createDataFrame(ratings_data, "user_id string, item_id string, rating double")
    items = spark.createDataFrame(items_data, "item_id string, title string, genres string")
    users = spark.createDataFrame(users_data, "user_id string, gender string, age double")

    by_item = defaultdict(list)
    for _, i, r in ratings_data:
        by_item[i].append(r)
    title = {}
    for i, t, _ in items_data:
        title[i] = max(title.get(i, t), t)

    got = {r.item_id: r for r in R.rating_avg_by_item(ratings, items).collect()}
    assert set(got) == set(by_item)
    for i, rs in by_item.items():
        assert got[i].title == title.get(i, i)
        assert _close(got[i].avg_rating, sum(rs) / len(rs)) and got[i].n_ratings == len(rs)

    best = R.best_rated_item(ratings, items, 2).collect()[0]
    eligible = [(-sum(rs) / len(rs), i) for i, rs in by_item.items() if len(rs) >= 2]
    if eligible:
        _, want = min(eligible)
        assert best.item_id == want and best.title == title.get(want, want)
    else:
        assert best.item_id is None

    genre_sum = defaultdict(lambda: [0.0, 0])
    for i, _, g in items_data:
        for genre in _genres(g):
            for r in by_item.get(i, []):
                genre_sum[genre][0] += r
                genre_sum[genre][1] += 1
    genres = R.explode_genres(items)
    got_g = {r.genre: (r.avg_rating, r.n_ratings) for r in R.rating_avg_by_genre(ratings, genres).collect()}
    want_g = {g: (s / n, n) for g, (s, n) in genre_sum.items() if n}
    assert set(got_g) == set(want_g)
    for g, (a, n) in want_g.items():
        assert _close(got_g[g][0], a) and got_g[g][1] == n
    assert R.genre_rating_pairs(ratings, genres).count() == sum(n for _, n in genre_sum.values())

    user = {u: (g, a) for a, g, u in sorted((a, g, u) for u, g, a in users_data)}
    sides = defaultdict(lambda: {"M": [], "F": [], "any": [], "ages": defaultdict(list)})
    bounds = (0, 18, 35, 50)
    for u, i, r in ratings_data:
        if u not in user:
            continue
        g, age = user[u]
        sides[i]["any"].append(r)
        if g.upper() in ("M", "F"):
            sides[i][g.upper()].append(r)
        for k, lo in enumerate(bounds):
            hi = bounds[k + 1] if k + 1 < len(bounds) else float("inf")
            if lo <= age < hi:
                sides[i]["ages"][k].append(r)
    got_s = {r.item_id: r for r in R.rating_avg_by_gender(ratings, users, items).collect()}
    assert set(got_s) == set(sides)
    for i, s in sides.items():
        for side, col in (("M", "male_avg"), ("F", "female_avg")):
            want = sum(s[side]) / len(s[side]) if s[side] else 0.0
            assert _close(got_s[i][col], want)
    got_a = {r.item_id: r for r in R.rating_avg_by_age_group(ratings, users, items).collect()}
    assert set(got_a) == set(sides)
    for i, s in sides.items():
        for k, (_, col) in enumerate(R.age_group_names(bounds)):
            vals = s["ages"].get(k, [])
            assert _close(got_a[i][col], sum(vals) / len(vals) if vals else None)


words = st.sampled_from(["đẹp", "tệ", "Phòng", "phòng.", "the", "a*b", "(x)", '"q"', ",", " "])
review_rows = st.lists(st.tuples(
    st.one_of(st.none(), st.integers(1, 4)),
    st.lists(words, max_size=6).map(" ".join),
    st.sampled_from(["GENERAL", "general", "PRICES"]),
    st.sampled_from(["HOTEL", "rooms"]),
    st.sampled_from(["positive", "Negative", "neutral"])), max_size=12)


def _tokens(text):
    out, cur = [], ""
    for ch in text.lower():
        if ch in DEFAULT_TOKEN_DELIMITERS:
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += ch
    if cur:
        out.append(cur)
    return [t for t in out if t.strip()]


@SETTINGS
@given(review_rows)
def test_review_operators_against_model(spark, data):
    reviews = spark.createDataFrame(
        data, "rid int, review string, category string, aspect string, sentiment string")
    stops = {"the", "đẹp"}
    model = []
    for rid, text, cat, asp, sent in data:
        for t in _tokens(text):
            if t not in stops:
                model.append((rid, cat.upper(), asp.upper(), sent.lower(), t))
    words_df = V.clean_words(reviews, sorted(stops))
    assert sorted(map(tuple, words_df.collect()), key=str) == sorted(model, key=str)
    # the table form of the stop list gives the same rows
    table = V.stop_word_table(spark, sorted(stops))
    assert words_df.exceptAll(V.clean_words(reviews, table)).count() == 0

    freq = defaultdict(int)
    for rid, _, _, _, w in model:
        freq[w] += rid is not None
    got = {r.word: r.freq for r in V.word_freq_over(words_df, 1).collect()}
    assert got == {w: n for w, n in freq.items() if n > 1}

    counts = defaultdict(lambda: [0, set()])
    for rid, _, cat, _, _ in data:
        counts[cat][0] += rid is not None
        if rid is not None:
            counts[cat][1].add(rid)
    got_c = {r.category: (r.total_rows, r.distinct_comments)
             for r in V.comment_counts(reviews, "category").collect()}
    assert got_c == {c: (n, len(s)) for c, (n, s) in counts.items()}

    per_cat = defaultdict(int)
    for rid, cat, _, _, w in model:
        per_cat[(cat, w)] += rid is not None
    want_top = set()
    for cat in {c for c, _ in per_cat}:
        ranked = sorted(((-n, w.encode()), w) for (c, w), n in per_cat.items() if c == cat)
        want_top |= {(cat, w, -key[0]) for key, w in ranked[:2]}
    top = V.top_words(V.word_counts(words_df, ["category"]), 2)
    assert {tuple(r) for r in top.collect()} == want_top

    neg = defaultdict(int)
    for rid, _, _, asp, sent in data:
        if sent.lower() == "negative":
            neg[asp.upper()] += rid is not None
    got_n = V.most_judged_aspect(reviews, "negative", "neg_count").collect()
    if neg:
        want = min(neg.items(), key=lambda kv: (-kv[1], kv[0]))
        assert tuple(got_n[0]) == want
    else:
        assert got_n == []
