"""The pipeline against a brute-force version, and the registered queries against their SQL."""
import duckdb
import pandas as pd
import pyarrow as pa
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tools.oracle_check import rows_of
from turnstone.llm import toxicity
from turnstone.llm.queries import ORACLE_SQL, QUERIES
from turnstone.llm.shared import table

from .test_dedup import LOW, near_brute
from .test_text import leaks_brute

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    data = list(zip(docs.doc_id.tolist(), docs.text.tolist()))
    model = toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    score = model.scores(pa.array([t for _, t in data]))
    data = [x for x, s in zip(data, score) if s < 0.7]
    last = {}
    for i, t in data:
        key = (t or "").translate(LOW)
        last[key] = max(last.get(key, i), i)
    data = [(i, t) for i, t in data if last[(t or "").translate(LOW)] == i]
    kept = {r[0] for r in near_brute(data, 5) if r[3]}
    data = [x for x in data if x[0] in kept]
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    leaked = {r[0] for r in leaks_brute(data, list(zip(items.item_id.tolist(), items.text.tolist()))) if r[5]}
    want = {i for i, _ in data if i not in leaked}
    out = E.queries()["pipeline"](spark, SF).toPandas()
    assert set(out.doc_id) == want
    assert out.groupby("doc_id").length.sum().to_dict() == out.groupby("doc_id").doc_tokens.first().to_dict()


def test_stages_return_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs.limit(0), SF).columns == docs.columns


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(rel.columns)
    cols = sorted(got.columns)
    assert rows_of([r.asDict() for r in got.collect()], cols) == rows_of([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)


def test_all_are_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
