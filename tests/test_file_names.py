"""Names of a table's files are made once a file, not once a row."""

import re

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from millrace.tables.table import VersionedTable


def test_paths_are_cut_as_the_groups_come_out(spark, tmp_path, monkeypatch):
    plans = []

    def listed(df, *args, own=DataFrame.toLocalIterator):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return own(df, *args)

    monkeypatch.setattr(DataFrame, "toLocalIterator", listed)
    table = VersionedTable(spark, str(tmp_path), "t")
    rows = spark.range(100).withColumn("v", F.lit(1))
    table.upsert(rows, ["id"])
    table.upsert(rows.where("id % 3 = 0").withColumn("v", F.lit(2)), ["id"])
    assert table.read().groupBy("v").count().sort("v").collect() == [(1, 66), (2, 34)]
    assert table.files_at().agg(F.sum("record_count")).first()[0] == 100
    cut = [p for p in plans if "split(" in p]
    assert len(cut) >= 3 and not [p for p in cut if re.search(r"Project \[.*split\(", p)]
