"""What the pipeline's tasks hold at a time: small batches, no second set of
Python workers, nothing of an operator that ran before."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tracelake.llm import common, packing, toxicity

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture()
def batch_rows(spark):
    """Rows a batch that Python workers get; the session's setting comes back."""
    before = spark.conf.get(BATCH, None)
    spark.conf.unset(BATCH)

    def most():
        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

        return spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long").agg(F.max("n"), F.sum("n")).first()

    yield most
    spark.conf.unset(BATCH)
    if before is not None:
        spark.conf.set(BATCH, before)


def test_stages_give_workers_small_batches(spark, batch_rows):
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    assert corpus_pipeline.pack_documents(spark, docs, "").count() == 3
    assert tuple(batch_rows()) == (corpus_pipeline.BATCH_ROWS, 5000)
    spark.conf.set(BATCH, 4000)  # what the session says holds
    corpus_pipeline.pack_documents(spark, docs, "")
    assert tuple(batch_rows()) == (4000, 5000)


def test_packing_steps_need_no_python_workers(spark, monkeypatch):
    made = []
    plain = type(spark).createDataFrame

    def noted(self, *args, **kwargs):
        made.append(plain(self, *args, **kwargs))
        return made[-1]

    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), F.col("id").cast("int")).alias("text"))
    found = packing.pieces(docs)
    monkeypatch.setattr(type(spark), "createDataFrame", noted)
    rows = packing.pack(found).collect()
    assert sum(r["length"] for r in rows) == sum(range(30)) + 30
    assert len(made) == 1 and made[0].count() > 0
    assert "PythonRDD" not in made[0]._jdf.queryExecution().toRdd().toDebugString()


class _Docs:
    """A frame that returns the function it would send to the workers."""

    columns = ["doc_id", "text"]
    schema = None

    @property
    def sparkSession(self):  # noqa: N802
        return self

    sparkContext = sparkSession  # noqa: N815

    def broadcast(self, value):
        return type("Shared", (), {"value": value})

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def test_toxicity_scores_small_parts_and_drops_what_packing_kept():
    model = toxicity.Model({f: 9.0 for f in toxicity.features_of("vermin")}, -5.0)
    texts = [None if i % 7 == 0 else "vermin" if i % 3 == 0 else f"word {i}" for i in range(2300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2300), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    common.kept(("packing", "x"), object)
    run = toxicity.keep_clean(_Docs(), model)
    got = list(run(iter([batch, batch.slice(0, 0)])))
    assert max(b.num_rows for b in got) <= toxicity.ROWS
    want = [i for i, t in enumerate(texts) if t != "vermin"]
    assert [i for b in got for i in b.column(0).to_pylist()] == want
    assert not common._KEPT


def test_one_object_is_kept_by_its_key():
    first = common.kept(("a",), object)
    assert common.kept(("a",), object) is first
    common.kept(("b",), object)
    assert common.kept(("a",), object) is not first
    common.forget()
    assert not common._KEPT
