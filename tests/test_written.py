"""Tables written to the shared folder."""

import time

from pyspark.sql import functions as F


def test_written_tables_leave_no_shuffle_files(spark):
    from tablesmith.llm.shared import saved
    from tablesmith.session import stored
    files = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().size()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key, None)
    for write in (stored, saved):
        before = files()
        out = write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
        for _ in range(50):
            if files() <= before:
                break
            time.sleep(0.1)
        assert files() <= before and out.count() == 7
        assert spark.conf.get(key, None) == setting
