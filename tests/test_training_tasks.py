"""Layout of the training rows."""

from pyspark.sql import functions as F

from pledgekit.plans import supervised


def test_training_tasks_are_bounded_by_rows(spark, featured, monkeypatch):
    whole = supervised.prepare_splits(featured)
    assert whole.tasks == 1
    monkeypatch.setattr(supervised, "TASK_ROWS", 50)
    ready = supervised.prepare_splits(featured)
    held = [r["count"] for r in ready.train.groupBy(F.spark_partition_id()).count().collect()]
    assert max(held) <= 60 and len(held) > 8
    columns = ["ID", "fold", "label", "pledged", "pledged_log"]
    assert sum(held) == whole.train.count()
    assert ready.train.select(*columns).exceptAll(whole.train.select(*columns)).isEmpty()
    first = [[r.ID for r in ready.train.collect()] for _ in range(2)]
    assert first[0] == first[1]
