from __future__ import annotations

import time

from pyspark.sql import functions as F

from eventloom.llm import common


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(common.CLEAN_UP)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    assert sorted(map(tuple, common.stored(rows, "counts").collect())) == sorted(map(tuple, rows.collect()))
    common.stored(rows, "counts")
    assert spark.conf.get(common.CLEAN_UP) == setting
    rows = rows.withColumn("n", F.col("n") + 1)
    between = shuffle_files(spark)
    common.stored(rows, "counts")
    assert shuffle_files(spark) <= between | before


def test_an_idle_worker_lets_go(monkeypatch):
    monkeypatch.setattr(common, "REST_S", 0.2)
    gone = []
    common.hold("kept", lambda: gone.append(1))
    common.rest()
    common.hold("kept", lambda: gone.append(2))  # the next task comes in time
    time.sleep(0.5)
    assert not gone
    common.rest()
    deadline = time.time() + 10
    while not gone and time.time() < deadline:
        time.sleep(0.05)
    assert gone == [1]
    common.hold("kept", lambda: gone.append(3))
    common.hold("other", lambda: None)
    assert gone == [1, 3]
    common.hold("none", lambda: None)
