"""The pipeline's stages, one after the other, against what each must keep."""

import __spark_entry__ as registered
import corpus_pipeline
import duckdb
import pytest


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def test_stages_have_the_given_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language identification",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "secret scans",
        "best-fit packing",
    ]


def test_every_operator_has_one_query():
    names = [k for k in registered.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in registered.queries()


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty texts, repeated rows, other columns; and no rows at all."""
    line = "this is a plain line of words that no other document holds at all number "
    given = [
        (1, line + "one", "en", "s", 1, 1),
        (1, line + "one", "en", "s", 1, 1),
        (2, None, None, None, None, None),
        (3, "", "en", "s", 0, 2),
        (4, "token=abcdefghijklmnop and so forth", "en", None, 3, None),
        (None, line + "two", "en", "s", 4, 3),
        (6, "12 34", None, "s", 5, 4),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, bit int"
    docs = spark.createDataFrame(given, schema)
    spark.createDataFrame([(1, None), (2, "zz yy")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    for frame in (docs, docs.limit(0)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame, str(tmp_path))
            if number < 4:
                assert out.columns == docs.columns
                assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            out.collect()


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        out.append(docs)
    return out


def test_each_stage_works_on_what_is_left(spark, sf_dir, stages):
    documents = table(spark, sf_dir, "documents")
    languages, distinct, clean, hidden, packed = stages
    ids = [{r[0] for r in s.select("doc_id").distinct().collect()} for s in stages]
    assert ids[0] >= ids[1] >= ids[2] == ids[3] == ids[4]
    assert languages.count() >= 0.99 * documents.count()
    for stage in stages[:4]:
        assert stage.columns == documents.columns
    assert distinct.count() == len(ids[1])
    leaked = duckdb.sql(
        f"SELECT DISTINCT doc_id FROM '{sf_dir}/documents.parquet' d, '{sf_dir}/benchmark.parquet' b"
        " WHERE contains(d.text, b.text)"
    ).fetchall()
    assert leaked and not {x[0] for x in leaked} & ids[2]
    assert not hidden.where(r"text rlike 'AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}'").count()
    assert packed.where("n_tokens > 0 and bin_id is null").count() == 0


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    columns = ["doc_id", "piece", "n_tokens"]
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, stages[-1].select(columns).collect())
    )
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
