"""The pipeline and the registered queries against brute force and DuckDB."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from vertexrank.llm import stages
from vertexrank.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) <= set(contract.queries()) and "pipeline" in contract.queries()
    assert set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r[c] for c in cols) for r in df.collect()) == key(tuple(r[names.index(c)] for c in cols) for r in want.fetchall())


def test_pipeline_equals_its_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF).collect()
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        if name != "mix":
            assert docs.columns == before.columns
        rows = docs.collect()
        now = {r["doc_id"]: r["text"] for r in rows}
        assert set(now) <= set(kept)
        if name in ("ngram_join", "decontaminate"):
            assert all(kept[i] == t for i, t in now.items())
            s = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()})((t or "").encode().lower().split())
        if name == "ngram_join":  # what went has a near copy, and none of those that stay are near
            sets = {i: s(t) for i, t in kept.items()}
            near = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            ids = sorted(now)
            assert not any(near(a, b) for k, a in enumerate(ids) for b in ids[:k])
            assert all(any(near(a, b) for b in kept if b != a) for a in set(kept) - set(now))
        if name == "decontaminate":
            items = [s(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            leak = lambda t: any(q and 100 * len(q & s(t)) >= 80 * len(q) for q in items)
            assert set(now) == {i for i, t in kept.items() if not leak(t)}
        kept, docs = now, spark.createDataFrame(rows, docs.schema)
    assert {(r["doc_id"], r["copies"]) for r in got} == {(r["doc_id"], r["copies"]) for r in docs.collect()}


def test_stages_keep_odd_rows_and_columns(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (None, "some text of a row without id", "en", "a"), (3, "some clean text here, and more of it.\nTwice.\nTwice.", "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    odd = ("size", "copies", "score", "predicted", "n_removed", "weight", "id", "__gone", "x.y")
    docs = docs.select("*", *[F.lit(c).alias(c) for c in odd])
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF)
        assert docs.count() >= 3
    assert {r["id"] for r in docs.collect()} == {"id"} and docs.where("doc_id = 3").head()["text"].count("Twice.") == 1
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
    assert stages.quality_filter(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).columns == empty.columns


def test_stages_judge_rows_by_id_and_text(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").head()["text"]
    say = lambda w: " ".join(f"{w}{i}" for i in range(60))
    rows = [(1, say("a")), (7, say("a") + " end"), (7, say("b")), (9, say("c")), (9, say("c")), (9, say("c")), (None, "so " + say("a")), (None, say("d")), (None, say("d")), (None, say("e")), (12, ""), (12, "")]
    docs = spark.createDataFrame([(*r, f"s{k}") for k, r in enumerate(rows)], "doc_id long, text string, source string")
    got = sorted(map(repr, map(tuple, stages.ngram_join(spark, docs, SF).collect())))
    assert got == sorted(map(repr, [(1, say("a"), "s0"), (7, say("b"), "s2"), (9, say("c"), "s3"), (None, say("d"), "s7"), (None, say("e"), "s9"), (12, "", "s10"), (12, "", "s11")]))
    rows = [(11, say("a") + " " + item), (11, say("b")), (None, item + " " + say("c")), (None, say("d"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, stages.decontaminate(spark, docs, SF).collect())) == Counter([rows[1], rows[3]])
