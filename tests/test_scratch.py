"""Scratch folders go with their scope, results stay; shuffle files go with the write they served."""

import gc
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerspark.sources import files
from ledgerspark.sources.publish import publish_table
from ledgerspark.sources.scratch import scratch_path, scratch_scope, settled, settled_all, stable


def folders(spark):
    return set(files.names(spark, scratch_path(spark, "x").rsplit("/", 1)[0]))


def test_scope_deletes_what_was_made_inside(spark):
    outside = stable(spark.range(3))
    before = folders(spark)
    with scratch_scope(spark):
        first = stable(spark.range(5))
        with scratch_scope(spark):
            stable(first)
            assert len(folders(spark)) == len(before) + 2
        assert len(folders(spark)) == len(before) + 1 and first.count() == 5
        scratch_path(spark, "never-written")
    assert folders(spark) == before and outside.count() == 3


def test_scope_deletes_after_a_failure(spark):
    before = folders(spark)
    with pytest.raises(ValueError, match="broken"), scratch_scope(spark):
        stable(spark.range(5))
        raise ValueError("broken")
    assert folders(spark) == before


def test_settled_keeps_the_result_alone(spark):
    before = folders(spark)

    def chain(steps):
        if not steps:
            return spark.range(4).toDF("n")
        return settled(spark, lambda: stable(chain(steps - 1)).select((F.col("n") * 2).alias("n")))

    got = chain(3)
    assert sorted(r.n for r in got.collect()) == [0, 8, 16, 24]
    assert len(folders(spark) - before) == 1


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    def held():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {os.path.basename(str(f)) for f in disk.getAllFiles().mkString("|").split("|") if "shuffle_" in f}

    gc.disable()
    try:
        before = held()
        counted = spark.range(20_000).groupBy((F.col("id") % 500).alias("k")).agg(F.sum("id").alias("n"))
        first = stable(counted)
        kept = settled(spark, lambda: first.join(counted.withColumnRenamed("n", "m"), "k").repartition(3))
        publish_table(kept, f"{tmp_path}/t", ["k"])
        assert not held() - before
        # a frame that was written is computed again when it is asked again
        assert stable(counted).count() == counted.count() == kept.where("n = m").count() == 500
    finally:
        gc.enable()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_batches_to_python_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    texts = spark.range(0, 8_000, 1, 1).select(F.repeat(F.md5(F.col("id").cast("string")), 64).alias("text"))
    for kept in (stable(texts.mapInArrow(sizes, "rows long, bytes long")),
                 settled(spark, lambda: texts.mapInArrow(sizes, "rows long, bytes long"))):
        seen = kept.agg(F.sum("rows"), F.max("bytes")).first()
        assert seen[0] == 8_000 and seen[1] < 6 << 20


def test_settled_all_keeps_the_results_alone(spark):
    made = []

    def make():
        made.append(stable(spark.range(5)))
        return [made[0].where("id > 2"), made[0].where("id < 2"), made[0].limit(0)]

    kept = settled_all(spark, make)
    assert [sorted(r.id for r in df.collect()) for df in kept] == [[3, 4], [0, 1], []]
    with pytest.raises(Exception, match="exist"):
        made[0].count()
