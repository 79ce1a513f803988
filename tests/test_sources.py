from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlens.plans import bronze, silver
from grantlens.plans.tables import table_specs
from grantlens.sources import readers, schemas, writers
from grantlens.sources.store import TableSpec, TableStore, shared_folder
from tests.helpers import column, day, frame, records

SMALL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("d", T.DateType()),
    ]
)


def write(path, text):
    path.mkdir()
    (path / "part.csv").write_text(text)
    return f"file:{path}"


def test_groups_align_by_name(spark, tmp_path):
    first = write(tmp_path / "y1", "id,name,n,d\n1,a,5,2025-01-01\n")
    second = write(tmp_path / "y2", "d,extra,n,id\n2025-02-01,x,6,2\n")
    scan = readers.read_csv_groups(spark, [first, second], SMALL)
    assert records(scan.rows, "id", "name", "n", "d") == [
        ("1", "a", 5, day("2025-01-01")),
        ("2", None, 6, day("2025-02-01")),
    ]
    assert scan.quarantine.count() == 0


def test_files_are_grouped_by_header(spark, tmp_path):
    one = write(tmp_path / "a", "id,name,n,d\n1,a,5,2025-01-01\n") + "/part.csv"
    two = write(tmp_path / "b", "name,id\nb,2\n") + "/part.csv"
    three = write(tmp_path / "c", "id,name,n,d\n3,c,7,\n") + "/part.csv"
    empty = write(tmp_path / "e", "") + "/part.csv"
    groups = readers.header_groups(spark, [one, two, three, empty])
    assert sorted(len(g) for g in groups) == [1, 2]
    rows = readers.read_csv_groups(spark, groups, SMALL).rows
    assert records(rows, "id", "name", "n") == [("1", "a", 5), ("2", "b", None), ("3", "c", 7)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_no_file_is_lost(spark, tmp_path, multi_line):
    """Blank first lines, quoted headers, many splits, only a header, nothing at all."""
    files = {
        "plain": "id,name,n,d\n1,a,5,2025-01-01\n",
        "blank": "\n  \nname,id\nb,2\n",
        "quoted": '"id","name","n","d"\n3,c,7,\n',
        "header": "id,name,n,d\n",
        "windows": "id,name\r\n4,d\r\n",
        "large": "name,id\n" + "e,5\n" * 50_000,
        "empty": "",
        "lines": "\n\n",
    }
    (tmp_path / "c").mkdir()
    for name, text in files.items():
        (tmp_path / "c" / f"{name}.csv").write_text(text, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = readers.read_csv_files(spark, f"file:{tmp_path}/c", SMALL, multi_line)
        got = scan.rows.groupBy("id", "name").count()
        assert records(got, "id", "name", "count") == [
            ("1", "a", 1), ("2", "b", 1), ("3", "c", 1), ("4", "d", 1), ("5", "e", 50_000),
        ]
        assert scan.quarantine.count() == 0
        assert sorted(r.file.rsplit("/", 1)[1] for r in scan.left_out.collect()) == ["lines.csv"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("multi_line", [True, False])
def test_rejected_rows_do_not_depend_on_the_columns_read(spark, tmp_path, multi_line):
    path = write(
        tmp_path / "c",
        "id,name,n,d\n1,ok,5,2025-01-01\n2,long,6,2025-01-01,more\n3,short\n4,bad,x,01/26/2025\n",
    )
    scan = readers.read_csv_checked(spark, path, SMALL, multi_line)
    assert scan.rows.count() == 2
    assert column(scan.rows.select("id"), "id") == ["1", "4"]
    assert column(scan.rows.select("name"), "name") == ["ok", "bad"]
    assert column(scan.rows, "d") == [day("2025-01-01"), None]
    assert scan.quarantine.count() == 2
    assert records(scan.quarantine, "id") == [("2",), ("3",)]
    assert records(scan.unreadable, "field", "value", "n") == [("d", "01/26/2025", 1), ("n", "x", 1)]


def test_a_folder_may_hold_files_of_any_column_order(spark, tmp_path):
    path = write(tmp_path / "c", "id,name,n,d\n1,a,5,2025-01-01\n")
    (tmp_path / "c" / "other.csv").write_text("name,id\nb,2\n")
    (tmp_path / "c" / "third.csv").write_text("id,name,n,d\n3,c,7,\n")
    rows = readers.read_csv_files(spark, path, SMALL, multi_line=False).rows
    assert records(rows, "id", "name", "n") == [("1", "a", 5), ("2", "b", None), ("3", "c", 7)]


def test_a_large_file_is_split(spark, tmp_path):
    path = write(tmp_path / "c", "grant_id,cfda_number\n" + "F1,47.050\n" * 200_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        rows = bronze.scan_usaspending(spark, [path]).rows
        assert rows.rdd.getNumPartitions() > 4 and rows.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_count_works_when_every_column_is_text(spark, tmp_path):
    path = write(tmp_path / "c", "grant_id,status\nF1,on\nF2\n")
    scan = bronze.scan_terminations(spark, path)
    assert scan.rows.count() == 1
    assert scan.quarantine.count() == 1
    assert scan.rows.columns == schemas.TERMINATIONS.names


def test_files_of_one_group_must_share_a_header(spark, tmp_path):
    path = write(tmp_path / "c", "id,name,n,d\n1,a,5,2025-01-01\n")
    (tmp_path / "c" / "other.csv").write_text("name,id,n,d\nb,2,6,2025-01-01\n")
    scan = readers.read_csv_checked(spark, path, SMALL)
    with pytest.raises(Exception, match="(?i)header"):
        scan.rows.collect()


def test_csv_round_trip_keeps_quotes_and_line_breaks(spark, tmp_path):
    rows = [{"grant_id": "F1", "abstract": 'a "b", c\nd', "reinstated": "true"}, {"grant_id": "F2"}]
    df = frame(spark, schemas.TERMINATIONS, rows)
    path = f"file:{tmp_path}/out"
    writers.write_csv(bronze.terminations(df), path)
    back = bronze.scan_terminations(spark, path).rows
    assert records(back, *back.columns) == records(df, *df.columns)


def test_compressed_csv_holds_the_same_rows(spark, tmp_path):
    rows = [{"grant_id": f"F{i}", "abstract": 'a "b", c ' * 9, "project_title": None if i % 3 else ""} for i in range(900)]
    df = frame(spark, schemas.TERMINATIONS, rows).repartition(3)
    backs, sizes = [], []
    for k, compression in enumerate(("none", "gzip")):
        writers.write_csv(df, f"file:{tmp_path}/{k}", compression=compression)
        scan = readers.read_csv_checked(spark, f"file:{tmp_path}/{k}", schemas.TERMINATIONS, multi_line=False)
        backs.append(sorted(records(scan.rows, "grant_id", "abstract", "project_title")))
        files = [f for f in (tmp_path / str(k)).iterdir() if f.name.startswith("part-")]
        sizes.append(sum(f.stat().st_size for f in files))
        assert len(files) == 3 and scan.quarantine.count() == 0
    assert backs[0] == backs[1] and len(backs[0]) == 900 and sizes[1] < sizes[0] / 5


def test_codes_stay_text(spark, tmp_path):
    path = write(tmp_path / "c", "cfda_number,action_date\n47.050,2025-01-01\n")
    rows = bronze.scan_usaspending(spark, [path]).rows
    assert column(rows, "cfda_number") == ["47.050"]


def test_append_reload_and_partition_reload(spark, tmp_path):
    df = frame(spark, "k int, y int", [{"k": i, "y": 2024 + i % 2} for i in range(6)])
    path = f"file:{tmp_path}/t"
    writers.write_parquet(df, path, partition_by="y")
    writers.write_parquet(df.filter("y = 2025"), path, partition_by="y", mode="append")
    assert spark.read.parquet(path).count() == 9
    writers.replace_partitions(df.filter("y = 2025 and k = 1"), path, "y")
    assert records(spark.read.parquet(path), "k", "y") == [(0, 2024), (1, 2025), (2, 2024), (4, 2024)]
    writers.write_parquet(df, path, partition_by="y")
    assert spark.read.parquet(path).count() == 6


def test_rows_that_stay_where_they_are_are_written_in_small_tasks(spark, tmp_path, monkeypatch):
    """Such tasks sort whole rows by folder, so their size bounds that sort."""
    monkeypatch.setattr(writers, "TASK_BYTES", "16k")
    keyed = spark.range(50_000).groupBy("id").count().withColumn("y", F.lit(2024))
    seen = writers.write_parquet(keyed, f"file:{tmp_path}/t", partition_by="y", rebalance=False)
    assert seen["rows"] == 50_000
    assert len(list((tmp_path / "t" / "y=2024").glob("*.parquet"))) == 8
    assert spark.conf.get(writers.ADVISORY, None) is None


def test_partitions_are_replaced_where_their_rows_are(spark, tmp_path):
    path = f"file:{tmp_path}/t"
    df = spark.range(0, 100, numPartitions=4).withColumn("y", F.lit(2024))
    writers.replace_partitions(df, path, "y", rebalance=False)
    writers.replace_partitions(df.filter("id < 60"), path, "y", rebalance=False)
    assert spark.read.parquet(path).count() == 60
    assert len(list((tmp_path / "t" / "y=2024").glob("*.parquet"))) == 3


def test_transactions_and_their_cube_are_written_without_a_further_shuffle():
    specs = table_specs(*[lambda _: None] * 3)
    assert not any(specs[n].rebalance for n in ("usaspending", "transactions", "monthly_cube"))


def test_parquet_is_zstd(spark, tmp_path):
    writers.write_parquet(frame(spark, "k int", [{"k": 1}]), f"file:{tmp_path}/t")
    assert [p for p in tmp_path.glob("t/*.zstd.parquet")]


def test_seed_skips_existing_keys(spark):
    seed = silver.agencies(spark)
    existing = seed.filter("agency_id <= 10").withColumn("agency_name", F.lit("kept"))
    fresh = writers.rows_to_seed(seed, existing, "agency_id")
    assert records(fresh, "agency_code") == [("NSF-OD",), ("NSF-OPP",)]


def test_missing_columns_are_added_as_typed_nulls(spark):
    old = frame(spark, "id string", [{"id": "1"}])
    new = writers.with_columns_of(old, SMALL)
    assert new.schema["n"].dataType == T.IntegerType()
    assert records(new, "id", "name", "n") == [("1", None, None)]


def test_store_computes_a_table_once(spark, tmp_path):
    calls = []

    def build(store):
        calls.append(1)
        return frame(spark, "k int, fiscal_year int", [])

    specs = {"t": TableSpec(build, partition_by="fiscal_year")}
    store = TableStore(spark, f"file:{tmp_path}", specs)
    assert store.table("t").count() == 0
    assert store.table("t").columns == ["k", "fiscal_year"]
    assert len(calls) == 1


def test_shared_folder_is_named_by_the_session(spark):
    assert shared_folder(spark).startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    spark.conf.set("spark.grantlens.warehouse", "file:/own/")
    try:
        assert shared_folder(spark).startswith("file:/own/grantlens/")
    finally:
        spark.conf.unset("spark.grantlens.warehouse")


class Session:
    """A session that names no folder but Spark's own."""

    conf = sparkContext = property(lambda self: self)
    applicationId = "app-1"

    def __init__(self, folder, master="yarn"):
        self.folder, self.master = folder, master

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.folder if key == "spark.sql.warehouse.dir" else default


def test_spark_names_the_folder_where_nothing_else_does():
    assert shared_folder(Session("hdfs:///warehouse")) == "hdfs:///warehouse/grantlens/app-1"
    assert shared_folder(Session("file:/home/x/w", "local[4]")) == "file:/home/x/w/grantlens/app-1"


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://host:7077"])
def test_a_folder_of_one_machine_is_no_shared_folder(master):
    for folder in ("file:/home/x/spark-warehouse", "/home/x/spark-warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(folder, master))


def test_seed_rows_that_repeat_a_key_count_once(spark):
    seed = silver.agencies(spark)
    fresh = writers.rows_to_seed(seed.union(seed), seed.limit(0), "agency_id")
    assert fresh.count() == 12
