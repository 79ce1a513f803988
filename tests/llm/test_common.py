from __future__ import annotations

import pytest

from grantlens.llm import common


class Session:
    """A session that names no folder but Spark's own."""

    conf = sparkContext = property(lambda self: self)

    def __init__(self, folder, master):
        self.folder, self.master = folder, master

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.folder if key == "spark.sql.warehouse.dir" else default


def test_a_folder_of_one_machine_is_no_shared_folder(spark):
    assert common.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert common.shared_folder(Session("file:/x/w", "local[4]")) == "file:/x/w"
    assert common.shared_folder(Session("hdfs:///w/", "yarn")) == "hdfs:///w"
    for folder in ("file:/x/w", "/x/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_folder(Session(folder, "local-cluster[2,1,1024]"))


def test_stored_tables_are_listed(spark):
    before = len(common.written())
    assert common.saved(spark.range(3), "three").count() == 3
    (path,) = common.written()[before:]
    assert path.startswith(common.shared_folder(spark)) and spark.read.parquet(path).count() == 3


def test_broadcast_counts_rows_and_list_elements(spark):
    table = common.saved(spark.sql("SELECT 1 AS k, array(1, 2, 3) AS x, CAST(NULL AS array<int>) AS y"), "lists")
    hinted = lambda *a, limit: "broadcast" in common.broadcast_if_small(table, *a, limit=limit)._jdf.queryExecution().logical().toString()
    assert hinted(limit=1) and not hinted("x", "y", limit=3) and hinted("x", "y", limit=4) and not hinted(limit=0)


def test_questions_of_all_groups_are_asked_at_once():
    def steps(n):
        said = []
        for k in range(n):
            said.append((yield 10 * n + k))
        return said

    asked = []
    got = common.answered([steps(2), steps(0), steps(3)], lambda q: asked.append(q) or [-v for v in q])
    assert got == [[-20, -21], [], [-30, -31, -32]] and asked == [[20, 30], [21, 31], [32]]
