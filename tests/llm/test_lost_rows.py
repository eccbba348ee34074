"""Rows and links that an earlier version lost: vectors of two lengths, a key with two texts, rows that share a doc_id."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from revlens.llm import dart_minhash, graph_dedup, packing, rabitq, token_store
from revlens.llm.token_cache import CachedEncoder


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(c) for c in v], label) for i, v, label in rows], "vec_id long, embedding array<float>, label int")


def test_search_among_vectors_of_two_lengths(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=8), 0) for i in range(100)] + [(i, r.normal(size=4), 0) for i in (200, 201, 220)]
    got = {}
    for x in rabitq.search(vectors(spark, rows)).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    f32 = {i: v.astype(np.float32).astype(np.float64) for i, v, _ in rows}
    assert sorted(got) == [0, 20, 40, 60, 80, 200, 220]
    for q, found in got.items():
        near = sorted(((-(f32[i] @ f32[q]), i) for i in f32 if i != q and len(f32[i]) == len(f32[q])))[:20]
        assert [i for _, i, _ in sorted(found)] == [i for _, i in near]


def test_links_among_vectors_of_two_lengths(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=8), 1) for i in range(30)] + [(40, [1, 2, 3, 4], 2), (41, [1, 2, 3, 4], 2), (42, [1, 2, 3, 4.1], 2), (43, [1, 2, 3, 4], 1)]
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in graph_dedup.near_vectors(vectors(spark, rows)).collect()}
    assert len(got) == 34
    assert [got[i] for i in (40, 41, 42, 43)] == [(2, 40, True), (2, 40, False), (2, 40, False), (0, 43, True)]


WORDS = [f"w{i}" for i in range(60)]
A, B = " ".join(WORDS), " ".join(reversed(WORDS))


def test_a_key_with_two_texts_links_by_each(spark):
    docs = spark.createDataFrame([(1, A), (1, B), (2, B + " more"), (3, "quite another text of some words"), (4, A + " end")], "doc_id long, text string")
    got = dart_minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 3), (4, 1)]


def test_near_dedup_stage_takes_rows_apart(spark, docs_of):
    rows = [(7, A), (7, B), (7, A), (None, "some words without an id at all"), (None, "some words without an id at all"), (None, None), (9, B + " x"), (5, B), (11, "")]
    docs = docs_of(rows).selectExpr("*", "1 as __n", "doc_id as row")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(7, A), (5, B), (None, "some words without an id at all"), (None, None), (11, "")], key=str)


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_the_unchanged_tokenizer_has_them(spark, file):
    path = public_tokenizers.path(file)
    t = Tokenizer.from_file(path)
    texts = ["end<|endoftext|>start", "<|endoftext|>", "a <|startoftext|> b\n\nc", "x\x00y z", "plain text, only."]
    assert [np.frombuffer(x, "<u4").tolist() for x in CachedEncoder(path).encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    assert [np.frombuffer(x, "<u4").tolist() for x in CachedEncoder(path, added_as_text=True).encode(texts)] == [plain.encode(x, add_special_tokens=False).ids for x in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lengths = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in token_store.store_and_read(docs, "doc_id", "text", path).collect()} == lengths
    assert {r.doc_id: r.length for r in packing.pack_documents(docs, "doc_id", "text", path).collect()} == lengths


def test_encoder_cache_beyond_its_bound(monkeypatch):
    from revlens.llm import token_cache
    monkeypatch.setattr(token_cache, "CACHE_BYTES", 4000)
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, e = Tokenizer.from_file(path), CachedEncoder(path)
    for k in range(12):
        texts = [" ".join(f"word{(i * 7 + k * j) % 40}," for i in range(30)) + "\n" + "tail\n" * (j % 3) for j in range(5)]
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_full_groups_are_packed_where_they_are_cut(spark):
    r = np.random.default_rng(3)
    texts = [(i, "word " * int(r.integers(1, 300))) for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(2)
    out = packing.pack_documents(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), group=200).collect()
    assert len(out) == 900 and {x.sequence_id >= 0 for x in out} == {True, False}
    fill = {}
    for x in sorted(out, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == fill.get(x.sequence_id, 0) and len(x.ids) == 4 * x.length
        fill[x.sequence_id] = x.offset + x.length
    assert max(fill.values()) <= 1024
    assert len(fill) <= -(-sum(fill.values()) // 1024) + 6  # about a sequence a group more than the least
