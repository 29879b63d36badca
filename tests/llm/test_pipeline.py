from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from boreline.llm import decontam, linededup, minhash, toxicity
from boreline.llm.queries import ORACLE, QUERIES
from check import TABLES, rows_of, same_kind


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    mine = rows_of(df.collect(), [df.columns.index(c) for c in columns])
    cur = duck.execute(ORACLE[name])
    theirs = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    assert sorted(theirs) == columns
    assert mine == rows_of(cur.fetchall(), [theirs.index(c) for c in columns]) and mine
    assert all(same_kind(kind, kinds[c]) or (kind, kinds[c]) == ("timestamp_ntz", "TIMESTAMP") for c, kind in df.dtypes)


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def by_hand(spark, sf_dir, docs):
    """The same decisions, one document at a time, from what each operator says of its stage's input."""
    labels, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    left = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id] < 0.5}
    yield dict(left)

    def table():
        return spark.createDataFrame(list(left.items()), "doc_id bigint, text string")

    gone = {}
    for r in linededup.recurring_lines(table()).collect():
        gone.setdefault(r.doc, set()).add(r.line)
    for key, lines in gone.items():
        parts = left[key].split("\n")
        if len(lines) < sum(bool(p.strip(" \t\r")) for p in parts):
            left[key] = "\n".join(p for k, p in enumerate(parts) if k not in lines)
    yield dict(left)
    for r in minhash.near_duplicates(table()).collect():
        if not r.kept:
            del left[r.doc_id]
    yield dict(left)
    for key in {r.doc_id for r in decontam.contaminated(table(), bench).collect()}:
        del left[key]
    yield dict(left)


def test_stages_decide_like_their_operators(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    now, want = docs, by_hand(spark, sf_dir, docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == docs.columns and now.dtypes == docs.dtypes, name
        rows = now.collect()
        assert {r.doc_id: r.text for r in rows} == next(want), name
        assert all(r.n_chars == len(r.text) for r in rows)
        now = spark.createDataFrame(rows, docs.schema)
    assert 0 < len(rows) < docs.count()
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in whole} == {r.doc_id for r in rows} and sum(r.n_tokens for r in whole) > 0


def test_odd_rows_pass_every_stage(spark, docs, odd_rows, sf_dir):
    df = docs(odd_rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, sf_dir)
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())
    assert got == [(False, -8), (False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (False, 7), (True, 0)]
    assert corpus_pipeline.STAGES[-1][1](spark, df, sf_dir).count() == 8


def test_empty_table_passes_every_stage(spark, docs, sf_dir):
    df = docs([])
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, sf_dir)
    assert df.count() == 0


def test_long_lines_that_differ_in_words_are_boilerplate(spark, docs, sf_dir):
    long = " ".join(["this", "page", "was", "seen", "by", "{}", *(f"word{chr(97 + j)}" for j in range(25)), "{}"])
    df = docs([(k, f"{long.format('x' * (k + 1), 'y' * (k + 1))}\nown{'z' * k} text{'z' * k}") for k in range(12)])
    got = corpus_pipeline.drop_boilerplate(spark, df, sf_dir).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in got} == {(k, f"own{'z' * k} text{'z' * k}", len(f"own{'z' * k} text{'z' * k}")) for k in range(12)}
