from __future__ import annotations

from types import SimpleNamespace

import pytest

from firmscope.shared import BATCH_BYTES, new_folder, pin, shared_folder, small_batches


class Context(SimpleNamespace):
    """Stands for a Spark context with the given master and settings."""

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, **settings):
    context = Context(master=master, conf=settings, folder=None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default))


def test_the_cluster_names_the_folder():
    spark = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_folder(spark) == "hdfs:///shared/"
    assert spark.sparkContext.folder == "hdfs:///shared/"
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_a_folder_set_before_must_be_shared_too():
    spark = session("yarn")
    spark.sparkContext.setCheckpointDir("file:/tmp/here")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(spark)
    spark.sparkContext.setCheckpointDir("hdfs://nodes/there")
    assert shared_folder(spark) == "hdfs://nodes/there"


def test_one_machine_gets_a_folder_once():
    spark = session("local[2]")
    assert shared_folder(spark) == shared_folder(spark)


def test_pinned_rows_do_not_split_anew(spark):
    pinned = pin(spark.range(10))
    assert "Range" not in pinned._jdf.queryExecution().executedPlan().toString()
    assert pinned.count() == 10


def test_wide_rows_go_to_python_in_small_batches(spark):
    """About as many bytes at once as asked for, also where a batch of rows would hold far more; a user's choice stays."""
    import pyarrow as pa

    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    other = spark.newSession()
    corpus_pipeline._ready(other)
    sizes = other.range(0, 400, 1, 1).selectExpr("repeat('x', 100000) text").mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"size": [batch.nbytes]}) for batch in batches), "size long"
    )
    found = [row.size for row in sizes.collect()]
    assert sum(found) > 4e7
    assert max(found) <= BATCH_BYTES + 200_000
    chosen = spark.newSession()
    chosen.conf.set(name, "1m")
    small_batches(chosen)
    assert chosen.conf.get(name) == "1m"
