import os

from lakemart import session


def test_scratch_goes_when_cleared(spark):
    path = session.scratch_path(spark, "probe")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    session.remove_path(spark, path)
    assert not os.path.exists(local)
