"""The pipeline's stages on a small table, and the numbered queries against their SQL."""

import duckdb
import pytest

import corpus_pipeline
from revlens.llm import queries as Q
from tests.llm.conftest import SF

TABLES = "documents embeddings pages".split()


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, want = Q.queries()[name](spark, SF), con.sql(Q.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canon(df.columns, map(tuple, df.collect())) == canon(want.columns, want.fetchall())


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries() if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in Q.queries() and set(Q.oracle_sql()) <= set(Q.queries())


def test_stages_take_effect_and_keep_the_columns(spark, docs_of):
    text = " ".join(f"the word{i} and" for i in range(40))
    clean = " ".join(f"another sentence{i} with this" for i in range(40))
    rows = [(1, text), (2, text), (3, text + " end"), (4, clean), (5, None), (6, "1234 !!"), (7, clean + " token = 0123456789abcdef0123"), (8, "short the and"),
            (8, "short the and"), (None, "the key of this is missing")]
    docs = docs_of(rows)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, "")
    assert kept.columns == columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 8, 8]
    rest = stages["near_dedup"](spark, kept, "")
    assert rest.columns == columns and sorted(r.doc_id or 0 for r in rest.collect()) == [0, 1, 4, 8]
    secret = stages["secret_scan"](spark, docs, "")
    seven = next(r for r in secret.collect() if r.doc_id == 7)
    assert secret.columns == columns and seven.text == clean + " [assign]" and seven.n_chars == len(seven.text)
    assert secret.count() == len(rows)
    packed = stages["packing"](spark, rest, "")
    assert sorted({r.doc_id or 0 for r in packed.collect()}) == [0, 1, 4, 8]


def test_stages_on_an_empty_table(spark, docs_of):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs_of([]), "").count() == 0


def test_run_equals_its_stages_one_by_one(spark):
    from revlens.llm.dart_minhash import near_duplicates
    packed = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert packed == {r.doc_id for r in near_duplicates(docs).where("doc_id = class_id").collect()}
