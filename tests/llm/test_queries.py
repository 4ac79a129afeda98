"""The corpus queries against their SQL, and the pipeline, on the smallest test tables."""

import os

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import queries
from tallyloom.llm.common import ready, stored
from tallyloom.llm.language_id import classify, train, training_rows
from tests.oracle import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    assert differences(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLE[name]) == []


def test_language_held_out(spark):
    """Held-out documents are recognised, though nothing was learned from them."""
    found = queries.QUERIES["op6_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert right >= 0.9 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)


def test_license_scan_rows(spark):
    found = queries.QUERIES["op9_license_scan"](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def _view(df, name, con):
    files = [f.removeprefix("file://") for f in df.inputFiles()]
    con.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet({files})")


def _ids(con, sql):
    return {r[0] for r in con.sql(sql).fetchall()}


def test_stages_keep_clean_rows_with_null_and_repeated_ids(spark):
    """Copies go by id and text; unrelated rows of the same id, and of none, stay. Languages are not lost for want of a label."""
    ready(spark)
    source = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prose = [t for _, t in sorted(source.items()) if t and len(t) > 400][:40]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(1, "one " + prose[0], "en"), (2, "one " + prose[0] + " end", "en"), (2, prose[1], None), (None, prose[2], "zh"), (None, prose[2] + " end", "zh"), (None, "a few words before " + item, None)]
    docs = spark.createDataFrame([(i, t, lang, f"src{k}", len(t)) for k, (i, t, lang) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    near = corpus_pipeline.near(spark, docs, SF)
    assert {(r["doc_id"], r["text"]) for r in near.collect()} >= {(1, rows[0][1]), (2, prose[1]), (None, rows[5][1])}
    assert (2, rows[1][1]) not in {(r["doc_id"], r["text"]) for r in near.collect()}
    leaks = corpus_pipeline.leaks(spark, docs, SF)
    assert sorted(r["text"] for r in leaks.collect()) == sorted(t for _, t, _ in rows[:5])
    langs = ["en", "it", None, "zh"]
    many = [(k, f"number {k} of them", langs[k % 4], "src1", 0) for k in range(400)]
    mixture = corpus_pipeline.mixture(spark, spark.createDataFrame(many, docs.schema), SF).collect()
    assert {r["lang"] for r in mixture} == {"en", "it", "zh", "(none)"}


def test_language_stage_fills_null_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    blank = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    out = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language(spark, blank, SF).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    filled = [i for i in out if i % 5 == 0]
    assert filled and sum(out[i] == truth[i] for i in filled) >= 0.8 * len(filled)
    assert all(out[i] == truth[i] for i in out if i % 5)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, name, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert stage(spark, docs, SF).collect() == []


def test_pipeline_against_brute_force(spark):
    """Each stage's rows from its own input: by the trained network one text at a time, and by SQL."""
    ready(spark)
    con, docs = connect(SF), spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, {}
    con.sql("DROP VIEW documents")
    _view(docs, "documents", con)
    languages, model = train(training_rows(docs, "doc_id", "text", "lang", 400, 0))
    clear = {i for i, t in con.sql("SELECT doc_id, text FROM documents").fetchall() if t and any(c.isalpha() for c in t) and classify(model, [t.encode()])[1][0] >= 0.35}
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    want = {
        "language": lambda: clear,
        "exact": lambda: _ids(con, f"SELECT max(doc_id) FROM documents GROUP BY {lower}"),
        "near": lambda: _ids(con, f"SELECT doc_id FROM ({queries.near_sql('documents', 5, 80)}) WHERE kept"),
        "leaks": lambda: _ids(con, "SELECT doc_id FROM documents") - _ids(con, f"SELECT doc_id FROM ({queries.ORACLE['op1_benchmark_decontamination']})"),
        "mixture": lambda: _ids(con, f"SELECT doc_id FROM ({queries.mix_sql()}) WHERE copies > 0"),
    }
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF), name)
        got = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(got) == len(set(got)) and set(got) == want[name](), name
        if name != "mixture":
            assert docs.columns == columns
            _view(docs, "documents", con)
    copies = dict(con.sql(f"SELECT doc_id, copies FROM ({queries.mix_sql()}) WHERE copies > 0").fetchall())
    assert {r["doc_id"]: r["copies"] for r in corpus_pipeline.run(spark, SF).collect()} == copies
