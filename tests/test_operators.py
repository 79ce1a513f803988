from __future__ import annotations

import random
import statistics

from pyspark.sql import functions as F

from grantlens.operators import joins, quality
from grantlens.operators.boxplot import box_stats, outliers
from grantlens.operators.rows import in_window, keep_one, whole_row_order, with_surrogate_key
from grantlens.sources.writers import write_parquet
from tests.helpers import day, frame, plan, records


def test_keep_one_limits_groups_before_the_shuffle(spark):
    df = frame(
        spark,
        "k string, d date, v int",
        [
            {"k": "a", "d": day("2025-01-01"), "v": 2},
            {"k": "a", "d": day("2025-01-01"), "v": 1},
            {"k": "a", "v": 0},
            {"k": None, "v": 7},
        ],
    )
    kept = keep_one(df, ["k"], whole_row_order(df, ["d"]))
    assert records(kept, "k", "v") == [("a", 1), (None, 7)]
    text = plan(kept)
    assert text.index("Partial") > text.index("Exchange")  # printed top down
    assert "WindowGroupLimit" in text


def test_surrogate_keys_are_dense_also_over_copies(spark):
    rows = [{"a": "same", "b": None}] * 57 + [{"a": f"r{i}", "b": i} for i in range(40)]
    df = frame(spark, "a string, b int", rows)
    keyed = with_surrogate_key(df, "id", buckets=5, chunk=10)
    got = keyed.collect()
    assert sorted(r.id for r in got) == list(range(1, 98))
    assert sorted((r.a, r.b or 0) for r in got) == sorted((r["a"], r["b"] or 0) for r in rows)


def test_surrogate_keys_do_not_depend_on_partitioning(spark):
    rows = [{"a": f"r{i % 37}", "b": i % 11} for i in range(300)]
    df = frame(spark, "a string, b int", rows)
    one = records(with_surrogate_key(df.coalesce(1), "id"), "id", "a", "b")
    many = records(with_surrogate_key(df.repartition(7), "id"), "id", "a", "b")
    assert one == many


def test_date_windows_prune_fiscal_years(spark, tmp_path):
    df = frame(
        spark,
        "d date, fiscal_year int",
        [
            {"d": day("2024-09-30"), "fiscal_year": 2024},
            {"d": day("2024-10-01"), "fiscal_year": 2025},
            {"d": day("2025-04-01"), "fiscal_year": 2025},
            {"d": day("2025-10-01"), "fiscal_year": 2026},
        ],
    )
    path = f"file:{tmp_path}/t"
    write_parquet(df, path, partition_by="fiscal_year", sort_by=["d"])
    stored = spark.read.parquet(path)
    found = in_window(stored, "d", (day("2024-10-01"), day("2025-04-01")))
    assert records(found, "d") == [(day("2024-10-01"),)]
    assert "PartitionFilters: [isnotnull(fiscal_year" in plan(found)


def test_fanout_join_equals_a_left_join(spark):
    left = frame(spark, "k string, v int", [{"k": k, "v": i} for i, k in enumerate("abc")])
    right = frame(
        spark, "k string, w int", [{"k": "a", "w": i} for i in range(5)] + [{"w": 9}]
    )
    got = joins.left_join_fanout(left, right, "k")
    assert records(got, "k", "v", "w") == records(left.join(right, "k", "left"), "k", "v", "w")


def test_unmatched_keys_become_null_and_rows_stay(spark):
    df = frame(spark, "k string, v int", [{"k": "a", "v": 1}, {"k": "x", "v": 2}, {"v": 3}])
    known = frame(spark, "k string", [{"k": "a"}, {"k": "a"}, {}])
    got = joins.null_unmatched(df, "k", known)
    assert records(got, "v", "k") == [(1, "a"), (2, None), (3, None)]


def test_list_overlap_uses_raw_and_trimmed_entries(spark):
    df = frame(
        spark,
        "id int, codes string",
        [
            {"id": 1, "codes": "1.0, 2.0"},
            {"id": 2, "codes": "3.0,4.0"},
            {"id": 3},
            {"id": 4, "codes": " 5.0"},
        ],
    )
    values = frame(spark, "c string", [{"c": "2.0"}, {"c": " 5.0"}, {}])
    got = joins.flag_list_overlap(df, "id", "codes", values, "c", "hit")
    assert records(got, "id", "hit") == [(1, True), (2, False), (3, False), (4, True)]
    assert "NestedLoop" not in plan(got)


def brute_force_box(values):
    x = sorted(values)
    n = len(x)
    depth = ((n + 3) // 2) / 2

    def at(rank):
        return (x[int(rank // 1) - 1] + x[int(-(-rank // 1)) - 1]) / 2

    q1, q3 = at(depth), at(n + 1 - depth)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [v for v in x if low <= v <= high]
    return (n, inside[0], q1, statistics.median(x), q3, inside[-1]), [
        v for v in x if not low <= v <= high
    ]


def test_box_stats_on_known_values(spark):
    groups = {"a": [1, 2, 3, 4, 10, 11], "b": [1, 2, 3, 4, 50], "c": [1, 2]}
    df = frame(spark, "g string, v int", [{"g": g, "v": v} for g, vs in groups.items() for v in vs])
    stats = box_stats(df, "g", "v", 3, 1.5)
    got = {r.g: (r.q1, r.median, r.q3, r.low, r.high) for r in stats.collect()}
    assert got == {"a": (2.0, 3.5, 10.0, 1.0, 11.0), "b": (2.0, 3.0, 4.0, 1.0, 4.0)}
    assert records(outliers(df, stats, "g", "v"), "g", "v") == [("b", 50)]


def test_box_stats_against_brute_force(spark):
    rng = random.Random(7)
    groups = {f"g{n}": [rng.choice([3, 5, rng.randint(0, 400)]) for _ in range(n)] for n in range(3, 40)}
    df = frame(spark, "g string, v int", [{"g": g, "v": v} for g, vs in groups.items() for v in vs])
    stats = box_stats(df, "g", "v", 3, 1.5)
    beyond = {}
    for r in outliers(df, stats, "g", "v").collect():
        beyond.setdefault(r.g, []).append(r.v)
    for r in stats.collect():
        expected, far = brute_force_box(groups[r.g])
        assert (r.n, r.low, r.q1, r.median, r.q3, r.high) == expected
        assert sorted(beyond.get(r.g, [])) == far


def test_quality_reports(spark):
    child = frame(spark, "id int, p string", [{"id": 1, "p": "a"}, {"id": 1, "p": "z"}, {"id": 2}])
    parent = frame(spark, "p string", [{"p": "a"}])
    report = quality.constraint_report(
        {
            "unique": quality.duplicate_keys(child, ["id"]),
            "known": quality.orphans(child, "p", parent),
            "present": quality.missing_keys(child, "p"),
        }
    )
    assert records(report, "check", "violations") == [("known", 1), ("present", 1), ("unique", 1)]
    counters = quality.stage_counters("s", child, linked=F.col("p").isNotNull())
    assert records(counters, "counter", "n") == [("linked", 2), ("rows", 3)]
