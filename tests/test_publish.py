"""Published versions: readers see one complete set of tables, whatever happens to a load."""

from __future__ import annotations

import pytest

from grantlens.sources import publish
from grantlens.sources.store import TableSpec
from tests.helpers import frame, records


def specs(spark, rows, fail=False):
    def broken(store):
        raise RuntimeError("the feed broke off")

    return {
        "facts": TableSpec(lambda s: frame(spark, "k string, n int", rows), bucket_by="k", counters={"big": publish.F.col("n") > 5}),
        "sums": TableSpec(broken if fail else lambda s: s.table("facts").groupBy("k").agg(publish.F.sum("n").alias("n"))),
        "years": TableSpec(lambda s: s.table("facts"), partition_by="n"),
    }


OLD = [{"k": "a", "n": 1}, {"k": "b", "n": 9}]
NEW = [{"k": "a", "n": 7}, {"k": "c", "n": 8}]
NAMES = ["facts", "sums", "years"]


def test_nothing_is_published_in_an_empty_folder(spark, tmp_path):
    assert publish.versions(spark, f"file:{tmp_path}/none") == []
    with pytest.raises(LookupError):
        publish.open_store(spark, f"file:{tmp_path}/none")


def test_readers_see_whole_versions(spark, tmp_path):
    folder = f"file:{tmp_path}/w"
    publish.publish(spark, folder, specs(spark, OLD), NAMES)
    old = publish.open_store(spark, folder)
    assert records(old.table("sums"), "k", "n") == [("a", 1), ("b", 9)]
    publish.publish(spark, folder, specs(spark, NEW), NAMES)
    new = publish.open_store(spark, folder)
    assert records(new.table("sums"), "k", "n") == [("a", 7), ("c", 8)]
    assert records(new.table("years"), "k", "n") == records(new.table("facts"), "k", "n")
    # A reader that began before goes on with what it opened.
    assert records(old.table("facts"), "k", "n") == [("a", 1), ("b", 9)]
    assert new.counters("facts") == {"rows": 2, "big": 2} and old.counters("facts")["big"] == 1


def test_a_load_that_breaks_off_changes_nothing(spark, tmp_path):
    folder = f"file:{tmp_path}/w"
    publish.publish(spark, folder, specs(spark, OLD), NAMES)
    with pytest.raises(RuntimeError, match="broke off"):
        publish.publish(spark, folder, specs(spark, NEW, fail=True), NAMES)
    # It got as far as its first table.
    assert len(list((tmp_path / "w" / "versions").glob("*/facts/_SUCCESS"))) == 2
    assert len(publish.versions(spark, folder)) == 1
    assert records(publish.open_store(spark, folder).table("facts"), "k", "n") == [("a", 1), ("b", 9)]
    publish.publish(spark, folder, specs(spark, NEW), NAMES)
    assert records(publish.open_store(spark, folder).table("facts"), "k", "n") == [("a", 7), ("c", 8)]


def test_an_older_version_can_be_opened(spark, tmp_path):
    folder = f"file:{tmp_path}/w"
    for rows in (OLD, NEW):
        publish.publish(spark, folder, specs(spark, rows), NAMES)
    first, second = publish.versions(spark, folder)
    assert records(publish.open_store(spark, folder, version=first).table("sums"), "k", "n") == [("a", 1), ("b", 9)]
    assert first < second and first.split("-")[0] == "00000001"


def test_bucketed_tables_keep_their_layout(spark, tmp_path):
    folder = f"file:{tmp_path}/w"
    publish.publish(spark, folder, specs(spark, OLD), NAMES)
    df = publish.open_store(spark, folder).table("facts").groupBy("k").count()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Bucketed: true" in text


def test_stores_compute_what_was_not_published(spark, tmp_path):
    folder = f"file:{tmp_path}/w"
    publish.publish(spark, folder, specs(spark, OLD), ["facts"])
    store = publish.open_store(spark, folder, specs(spark, NEW))
    assert records(store.table("sums"), "k", "n") == [("a", 1), ("b", 9)]
