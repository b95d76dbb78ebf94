"""The registered corpus queries, against their SQL where there is one, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from rivalry.llm import queries
from rivalry.session import stored_so_far
from tests.llm.conftest import ODD
from tools.check_queries import TABLES, normal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, db, name):
    a = normal(queries.QUERIES[name](spark, SF).toPandas())
    b = normal(db.execute(queries.ORACLE[name]).df())
    assert list(a.columns) == list(b.columns) and a.equals(b)


@pytest.mark.parametrize("name", ["op2_chat", "op6_rules", "op7_pii"])
def test_no_python_workers(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_stages_take_effect(spark, db):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, counts = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == documents.columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0] < documents.count()
    texts = [r.text for r in docs.collect()]
    items = [r[0] for r in db.execute("select text from benchmark").fetchall()]
    assert not any(item in text for item in items for text in texts)
    assert not any("@mail1.example.com" in text for text in texts)
    result = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in result} == {r.doc_id for r in docs.collect()}
    assert all(r.exact and r.n_ids == len(r.ids) for r in result)


def test_unleaked_rows_stay_whatever_their_ids(documents, spark, tmp_path):
    item = "a passage of the benchmark that is long enough to be found"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [*ODD, (8, f"before. {item.upper()}!! after"), (8, "clean"), (None, f"and {item}"), (None, item)]
    docs = documents(rows)
    kept = corpus_pipeline.keep_unleaked(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    want = [*ODD, (8, "clean")]
    assert sorted(map(str, kept.collect())) == sorted(map(str, documents(want).collect()))


def test_texts_that_share_an_id_are_judged_apart(documents, spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [
        *ODD, (9, "one"), (5, long), (7, f"{long} more"), (7, "only here"), (7, "only here"), (7, "and this"),
        (None, f"{long} again"), (6, "two of one text"), (3, "two of one text"),
    ]
    docs = documents(rows)
    kept = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert kept.columns == docs.columns
    want = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "another text of the same id"),
        (None, "no id here"), (None, None), (5, long), (7, "only here"), (7, "and this"), (3, "two of one text"),
    ]
    assert sorted(map(str, kept.collect())) == sorted(map(str, documents(want).collect()))


def test_stages_leave_nothing_but_their_result(spark):
    """Of all that the stages store only the last result is left, for the lazy last stage."""
    before = stored_so_far()
    rows = corpus_pipeline.run(spark, SF).count()
    assert rows > 0 and stored_so_far() == before + 1
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(corpus_pipeline.BATCH)
