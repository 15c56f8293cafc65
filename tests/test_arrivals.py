"""Frames that reach a stream one by one."""

import pytest
from pyspark.sql import functions as F

from checks import queries


@pytest.mark.parametrize("sizes", [(4000, 4000), (4000, 2, 0, 4000)])
def test_a_batch_is_one_frame_of_several_files(spark, tmp_path, sizes):
    wide = spark.range(0, 4000, 1, 5).select("id", F.lit("x").alias("text"))
    frames = [wide.filter(F.col("id") < n).withColumn("frame", F.lit(i)) for i, n in enumerate(sizes)]
    folder, each = queries.put_in_order(spark, frames)
    assert each == 5
    seen = []
    stream = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", each).parquet(folder)

    def process(batch, batch_id):
        seen.append([tuple(r) for r in batch.groupBy("frame").count().collect()])

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", str(tmp_path))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert seen == [[(i, n)] if n else [] for i, n in enumerate(sizes)]
