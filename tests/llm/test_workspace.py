"""What a step leaves on disk goes at once, and batches that go to Python are small."""

import time

from siftlode.llm import workspace


def test_shuffle_files_of_a_written_table_go_at_once(spark):
    """One collection left those of the last plan, which lay on disk beside the next step's."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: disk.getAllFiles().mkString(" ").count(".data")
    ws = workspace.Workspace(spark, "test")
    ws.settle()
    time.sleep(1)
    before = files()
    ws.write(spark.range(0, 10_000, 1, 3).repartition(5, "id"), "dealt")
    assert files() > before
    ws.settle()
    for _ in range(40):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before


def test_batches_are_small_unless_the_session_says_otherwise(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for told, kept in (("10000", str(workspace.BATCH)), ("77", "77")):
        spark.conf.set(key, told)
        workspace.small_batches(spark)
        assert spark.conf.get(key) == kept
    spark.conf.unset(key)
