"""Hard negatives and whitening against brute force, byte-level BPE against the library."""

import base64
import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from revlens.llm import hard_negatives, queries, whitening, word_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark, rows):
    """(vec_id, embedding, label) with extra columns whose names the operators use themselves."""
    data = [(i, None if v is None else [None if c is None else float(c) for c in v], label, 1, "x") for i, v, label in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, block int, x string")


# ------------------------------------------------------------- hard negatives

@pytest.mark.parametrize("axes,bits", [(1, 4), (2, 4), (3, 3), (5, 2)])
def test_hilbert_index_visits_every_cell_by_single_steps(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    place = hard_negatives.hilbert_index(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_dots_are_exact():
    r = np.random.default_rng(0)
    x, a = r.integers(-300, 300, (50, 7)), r.integers(-300, 300, (9, 7))
    low, high = hard_negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    every = hard_negatives.dot(a, x)
    assert (every >= low).all() and (every <= high).all()
    big = np.array([[(1 << 29) + 1, 3]])
    assert hard_negatives.dot(big, big)[0, 0] == ((1 << 29) + 1) ** 2 + 9
    with pytest.raises(OverflowError):
        hard_negatives.dot(big * 8, big * 8)


def mined(rows, every=50, positives=5, negatives=3):
    """The contract, row by row."""
    use = [(i, [int(np.floor(256 * c)) for c in v], k) for i, v, k in rows
           if i is not None and k is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for at, (i, v, k) in enumerate(use):
        if i % every:
            continue
        score = sorted(((-sum(a * b for a, b in zip(v, w)), j, m) for n, (j, w, m) in enumerate(use) if n != at and len(w) == len(v)))
        for s, j, _ in [x for x in score if x[2] == k][:positives]:
            near = [x for x in score if x[2] != k and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(near)]
    return sorted(out)


def found(df, **how):
    return sorted(tuple(r) for r in hard_negatives.mine(df, **how).collect())


def test_hard_negatives_against_brute_force(spark):
    r = np.random.default_rng(4)
    centre = r.normal(size=(3, 6)) + 1
    rows = [(i, centre[i % 3] + r.normal(size=6) * (0.1 if i % 4 else 1.5), int(r.integers(0, 4))) for i in range(400)]
    rows += [(1000 + i, centre[0], 1) for i in range(150)]  # copies of one vector, with ties
    rows += [(50, [1, 2], 0), (51, [2, 2], 0), (52, [1.2, 1.3], 1), (100, centre[1], 2), (100, centre[1], 2)]  # another length, a repeated key
    rows += [(1, None, 0), (2, [1] * 6, None), (3, [1, None, 1, 1, 1, 1], 0), (4, [float("nan")] * 6, 0), (5, [], 0), (None, [1] * 6, 1), (150, [0] * 6, 3)]
    rows += [(200, -centre[0], 5), (201, centre[0], 5)]  # a positive with a negative score
    df = table(spark, rows)
    want = mined(rows)
    assert len(want) > 50
    got = found(df)
    assert [x for x in got if x not in want] == [x for x in want if x not in got] == []
    assert got == want
    assert found(df, block=16) == want
    assert found(df.repartition(5), block=7, every=10) == mined(rows, every=10)


def test_hard_negatives_of_nothing(spark):
    assert found(table(spark, [(50, None, 1)])) == []
    assert found(table(spark, [(50, [1.0], 1)])) == []
    assert found(table(spark, [(50, [1.0], 1), (51, [1.0], 1)])) == []  # a positive without negatives


def test_zone_maps_leave_blocks_out(spark):
    """Around far-apart centres most blocks need no look."""
    r = np.random.default_rng(6)
    rows = [(i, np.eye(8)[i % 8] * 20 + r.normal(size=8) * 0.05, i % 2) for i in range(1600)]
    usable = table(spark, rows).selectExpr("vec_id as id", "label", "transform(embedding, c -> bigint(floor(256 * c))) as x")
    blocks = hard_negatives.store_blocks(usable, 25)
    anchors = hard_negatives.store_anchors(blocks, 50)
    whole = anchors.selectExpr("chunk", "explode(sequence(0, size(ids) - 1)) as a", "0 as w", "bigint(20 * 20 * 256 * 256 / 2) as low", f"{hard_negatives.MOST} as high")
    asked = anchors.join(whole.groupBy("chunk").agg(hard_negatives.F.collect_list(hard_negatives.F.struct("a", "w", "low", "high")).alias("windows")), "chunk")
    picked = hard_negatives.choose_blocks(asked, blocks, True).selectExpr("sum(size(picks))").first()[0]
    assert picked < 0.2 * blocks.count() * 32


# ------------------------------------------------------------------ whitening

def test_minres_reaches_the_best_of_its_space():
    r = np.random.default_rng(0)
    a = r.normal(size=(20, 20))
    a, b = a + a.T, r.normal(size=(20, 2))
    none = [np.zeros((20, 0))] * 2
    t = whitening.corrections(lambda u: a @ u, np.array([0.3, -0.2]), none, b, 7)
    for i, value in enumerate((0.3, -0.2)):
        m, space = a - value * np.eye(20), [b[:, i]]
        for _ in range(6):
            space.append(m @ space[-1])
        q = np.linalg.qr(np.array(space).T)[0]
        best = np.linalg.norm(m @ q @ np.linalg.lstsq(m @ q, -b[:, i], rcond=None)[0] + b[:, i])
        assert np.linalg.norm(m @ t[:, i] + b[:, i]) == pytest.approx(best, rel=1e-9)


@pytest.mark.parametrize("shape,scale", [((2000, 40), 1.0), ((900, 150), 1.02), ((60, 3), 1.0), ((50, 1), 1.0), ((6, 12), 1.0)])
def test_leading_pairs_against_a_dense_solver(shape, scale):
    x = np.random.default_rng(2).normal(size=shape) * scale ** np.arange(shape[1])
    x = x - x.mean(axis=0)
    v = x.T @ x / len(x)
    values, vectors = whitening.leading_pairs(lambda u: x.T @ (x @ u) / len(x), shape[1], 4)
    want = np.linalg.eigvalsh(v)[::-1][:4]
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() <= 1e-13 * want[0] * np.sqrt(shape[1])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_whitening_against_numpy(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=9) * np.arange(1, 10), 0) for i in range(300)]
    rows += [(500 + i, rows[0][1], 0) for i in range(100)] + [(7, rows[7][1], 1), (None, rows[8][1], None)]  # copies count once in the fit
    odd = [(900, None, 0), (901, [1, None, 1, 1, 1, 1, 1, 1, 1], 0), (902, [float("inf")] * 9, 0), (903, [], 0)]
    two = [(950, [1, 5], 0), (951, [2, 7], 0), (952, [4, 1], 0)]
    got = whitening.whiten(table(spark, rows + odd + two)).collect()
    for part, d in ((rows, 9), (two, 2)):
        x = np.floor(256 * np.array([v for _, v, _ in part])).astype(np.int64)
        fit = np.unique(x, axis=0)
        n, s = len(fit), fit.sum(axis=0)
        values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
        values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
        ids = {i for i, _, _ in part}
        mine = [g for g in got if g.vec_id in ids]
        assert len(mine) == len(part) * min(4, d)
        of = {(g.vec_id, g.component): g for g in mine}  # rows of one key are equal here
        white = np.array([[of[i, k].whitened for k in range(1, min(4, d) + 1)] for i, _, _ in part])
        want = (x - s / n) @ vectors / np.sqrt(values)
        assert np.abs(white - want * np.sign((white * want).sum(axis=0))).max() < 1e-9
        assert [of[i, 1].deviation for i, _, _ in part] == [int(((n * v.astype(object) - s) ** 2).sum()) for v in x]
        assert {g.n for g in mine} == {n} and max(g.identity_error for g in mine) < 1e-9
        total = np.trace(np.cov(fit.T, bias=True))
        assert [of[part[0][0], k + 1].explained for k in range(min(4, d))] == pytest.approx(list(values / total), rel=1e-10)


def test_whitening_without_variance_or_rows(spark):
    got = whitening.whiten(table(spark, [(1, [1, 2, 3, 4, 5], 0), (2, [1, 2, 3, 4, 5], 0)])).collect()
    assert [(g.n, g.deviation, g.whitened, g.explained, g.identity_error) for g in got] == [(1, 0, 0.0, 0.0, 0.0)] * 8
    line = whitening.whiten(table(spark, [(i, [i, i, i, i, i], 0) for i in range(4)])).collect()
    assert {g.component: round(g.explained, 9) for g in line} == {1: 1.0, 2: 0.0, 3: 0.0, 4: 0.0}
    assert all(g.whitened == 0 for g in line if g.component > 1) and line[0].identity_error < 1e-9
    assert whitening.whiten(table(spark, [(1, None, 0)])).count() == 0


# --------------------------------------------------------------- byte-level BPE

def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PARTS = ["a", "Bc", "the", " the", "é", "'s", "'ll", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "　", " ", "1", "٣", ".", ",", "<|endoftext|>", "́", "日本", "🙂", "\x00"]


def test_every_character_is_split_as_in_the_library():
    lib, cut, ranks = library(), word_bpe.splitter(public_tokenizers.PATTERN), word_bpe.ranks_of(RANKS)
    for c in itertools.chain(range(0xD800), range(0xE000, 0x20000, 3)):
        text = f"a{chr(c)}1{chr(c)} {chr(c)}b {chr(c)}{chr(c)}"
        assert [i for w in cut(text) for i in ranks.encode(w)] == lib.encode_ordinary(text), hex(c)


def test_encode_and_decode(spark, docs_of):
    r, lib = random.Random(8), library()
    rows = [(1, None), (2, ""), (3, "twice"), (3, "twice"), (3, "another text of 3"), (None, "no key"), (None, None), (4, "x" * 300_000), (5, " " * 100_000 + "é" * 9999)]
    rows += [(100 + i, "".join(r.choice(PARTS) for _ in range(r.randrange(40)))) for i in range(400)]
    for slice_chars in (1 << 25, 300):
        out = word_bpe.decode(word_bpe.encode(docs_of(rows), "doc_id", "text", RANKS, slice_chars=slice_chars), "ids", RANKS)
        got = sorted(((x.doc_id, bytes(x.ids), bytes(x.decoded)) for x in out.collect()), key=str)
        assert got == sorted(((k, np.array(lib.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t in rows), key=str)


def test_encode_another_pattern_and_nothing(spark, docs_of):
    out = word_bpe.encode(docs_of([(1, "ab ab  cd"), (2, "éé x")]), "doc_id", "text", RANKS, pattern=r"\S+|\s+").collect()
    one = word_bpe.ranks_of(RANKS).encode
    assert {x.doc_id: np.frombuffer(x.ids, "<u4").tolist() for x in out} == {
        1: [i for w in ("ab", " ", "ab", "  ", "cd") for i in one(w)], 2: [i for w in ("éé", " ", "x") for i in one(w)]}
    assert word_bpe.encode(docs_of([(1, "a")]).where("false"), "doc_id", "text", RANKS).count() == 0


def test_decode_takes_any_ids(spark):
    ids = lambda *x: np.array(x, "<u4").tobytes()
    df = spark.createDataFrame([("a", ids(0, 1, 50255), 1), ("b", None, 2), ("c", b"", 3)], "k string, ids binary, tokens int")
    got = {x.k: x.decoded for x in word_bpe.decode(df, "ids", RANKS).collect()}
    assert got["b"] is None and bytes(got["c"]) == b"" and bytes(got["a"]) == library().decode_bytes([0, 1, 50255])
    with pytest.raises(Exception, match="no token"):
        word_bpe.decode(spark.createDataFrame([(ids(60000),)], "ids binary"), "ids", RANKS).collect()
    with pytest.raises(ValueError):
        word_bpe.decode(df.withColumnRenamed("tokens", "decoded"), "ids", RANKS)


def test_op13_digests(spark):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lib = library()
    for x in queries.op13_distinct_words(spark, sf).collect():
        ids = lib.encode_ordinary(text[x.doc_id])
        assert (x.n_tokens, x.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert x.decoded_sha256 == hashlib.sha256(text[x.doc_id].encode()).hexdigest()
