"""Change rows and the index that follows them."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.changes import (
    changed_keys,
    differing_buckets,
    snapshot_changes,
    store_snapshot,
    stored_snapshot,
    stored_snapshot_changes,
)
from millrace.streaming import keyed_sync
from millrace.streaming.index_sync import (
    compact_index,
    content_digest,
    current_index,
    publish_changes,
    run_index_sync,
    sync_index,
)
from millrace.streaming.keyed_sync import compact_keyed_index, keyed_index, run_keyed_sync
from tests.conftest import physical_plan, rows

SCHEMA = "document_id string, original_url string, content string"


def snapshot(spark, *documents):
    return spark.createDataFrame([(i, None, c) for i, c in documents], SCHEMA)


def embed_length(df, text):
    """An embedding that shows which text it was made of."""
    return df.withColumn("embedding", F.array(F.length(text).cast("float")))


def contents(index):
    return sorted((r.document_id, r.commit_version, r.embedding[0]) for r in index.collect())


def test_changes_compare_nulls(spark):
    before = spark.createDataFrame([(1, None, "a"), (2, 5, None), (3, 6, "c"), (4, None, None)], "k int, v int, w string")
    after = spark.createDataFrame([(1, None, "a"), (2, None, None), (4, None, "x"), (5, None, None)], "k int, v int, w string")
    assert rows(snapshot_changes(before, after, "k").select("change_type", "k", "v", "w")) == [
        ("delete", 3, 6, "c"),
        ("insert", 5, None, None),
        ("update_postimage", 2, None, None),
        ("update_postimage", 4, None, "x"),
        ("update_preimage", 2, 5, None),
        ("update_preimage", 4, None, None),
    ]


_ROWS = st.dictionaries(st.integers(0, 8), st.tuples(st.none() | st.integers(0, 2), st.none() | st.sampled_from("ab")))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=_ROWS, after=_ROWS)
def test_changes_lead_from_one_snapshot_to_the_other(spark, before, after):
    def table(content):
        return spark.createDataFrame([(k, *v) for k, v in content.items()], "k int, v int, w string")

    expected = [("delete", k, *before[k]) for k in before.keys() - after.keys()]
    expected += [("insert", k, *after[k]) for k in after.keys() - before.keys()]
    for k in before.keys() & after.keys():
        if before[k] != after[k]:
            expected += [("update_preimage", k, *before[k]), ("update_postimage", k, *after[k])]
    assert rows(snapshot_changes(table(before), table(after), "k")) == sorted(expected, key=repr)


def test_changes_with_two_keys_and_no_other_columns(spark):
    before = spark.createDataFrame([(1, "a"), (1, "b")], "k int, l string")
    after = spark.createDataFrame([(1, "b"), (2, "b")], "k int, l string")
    assert rows(snapshot_changes(before, after, "k", "l")) == [("delete", 1, "a"), ("insert", 2, "b")]


def test_changed_keys(spark):
    before = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, d string")
    after = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], "k string, d string")
    found = rows(changed_keys(before, after, "k", "d"))
    assert found == [("b", "update_postimage"), ("c", "delete"), ("d", "insert")]


def test_digest_of_a_missing_text(spark):
    frame = spark.createDataFrame([(None,), ("",)], "c string").select(content_digest(F.col("c")))
    assert len({r[0] for r in frame.collect()}) == 2


def test_batch_sync_embeds_changed_documents_only(spark, tmp_path):
    log = str(tmp_path / "log")
    sync_index(spark, snapshot(spark, ("a", "x"), ("b", "yy"), ("c", None)), log, 0, embed_length)
    assert contents(current_index(spark.read.parquet(log))) == [("a", 0, 1.0), ("b", 0, 2.0), ("c", 0, 0.0)]

    second = snapshot(spark, ("a", "x"), ("b", "yyy"), ("d", "zzzz"))
    for _ in range(2):  # the same sync again replaces itself
        sync_index(spark, second, log, 1, embed_length)
        assert spark.read.parquet(log).filter("commit_version = 1").count() == 3
        assert contents(current_index(spark.read.parquet(log))) == [("a", 0, 1.0), ("b", 1, 3.0), ("d", 1, 4.0)]

    sync_index(spark, second, log, 2, embed_length)
    assert spark.read.parquet(log).filter("commit_version = 2").count() == 0
    # a deleted document comes back
    sync_index(spark, snapshot(spark, ("c", "new")), log, 3, embed_length)
    assert contents(current_index(spark.read.parquet(log))) == [("c", 3, 3.0)]


def test_triggered_sync_from_the_change_feed(spark, tmp_path):
    feed, log, checkpoint = (str(tmp_path / n) for n in ("feed", "log", "checkpoint"))
    one = snapshot(spark, ("a", "x"), ("b", "yy"))
    two = snapshot(spark, ("a", "xx"), ("c", "z"))
    three = snapshot(spark, ("a", "xxx"), ("c", "z"))
    publish_changes(None, one, feed, 0)
    run_index_sync(spark, feed, log, checkpoint, embed_length)
    assert contents(current_index(spark.read.parquet(log))) == [("a", 0, 1.0), ("b", 0, 2.0)]
    # two commits in one sync: the later one wins
    publish_changes(one, two, feed, 1)
    publish_changes(two, three, feed, 2)
    run_index_sync(spark, feed, log, checkpoint, embed_length)
    run_index_sync(spark, feed, log, checkpoint, embed_length)
    assert contents(current_index(spark.read.parquet(log))) == [("a", 2, 3.0), ("c", 1, 1.0)]
    compacted = compact_index(spark, log, str(tmp_path / "compacted"))
    assert compacted.count() == 2 and contents(current_index(compacted)) == [("a", 2, 3.0), ("c", 1, 1.0)]


def test_reading_a_compacted_log_ranks_newer_rows_only(spark, tmp_path):
    log, target = str(tmp_path / "log"), str(tmp_path / "compacted")
    sync_index(spark, snapshot(spark, ("a", "x"), ("b", "yy"), ("c", "zzz")), log, 0, embed_length)
    sync_index(spark, snapshot(spark, ("a", "x"), ("b", "y"), ("c", "zzz")), log, 1, embed_length)
    base = compact_index(spark, log, target)
    newer = spark.createDataFrame(
        [
            ("a", 2, None, "delete", None, None, "d", None),
            ("b", 2, None, "update_postimage", None, "y", "d", [7.0]),
            ("b", 3, None, "update_postimage", None, "z", "e", [8.0]),
        ],
        base.schema,
    )
    log_now = base.unionByName(newer)
    assert contents(current_index(log_now, compacted=1)) == [("b", 3, 8.0), ("c", 0, 3.0)]
    assert contents(current_index(log_now, compacted=1)) == contents(current_index(log_now))
    assert contents(current_index(base, compacted=1)) == contents(current_index(base))


def test_a_document_with_very_many_versions(spark):
    log = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("document_id"),
        F.col("id").alias("commit_version"),
        F.lit("insert").alias("change_type"),
    )
    current = current_index(log)
    assert current.count() == 2_001
    assert current.filter("document_id = 'hot'").first().commit_version == 2_997
    assert "WindowGroupLimit" in physical_plan(current)


def test_stored_snapshots_give_the_same_changes_and_read_differing_buckets_only(spark, tmp_path):
    before = spark.range(2000).selectExpr("id AS k", "CASE WHEN id % 3 > 0 THEN id * 2 END AS v", "cast(id AS string) AS t")
    after = before.filter("k != 11").selectExpr("k", "CASE WHEN k = 7 THEN NULL ELSE v END AS v", "t").union(
        spark.createDataFrame([(5000, 1, None)], "k bigint, v bigint, t string")
    )
    paths = [str(tmp_path / name) for name in ("before", "after")]
    store_snapshot(before, paths[0], "k", buckets=64)
    store_snapshot(after.repartition(3), paths[1], "k", buckets=64)
    changes = stored_snapshot_changes(spark, *paths, "k")
    assert rows(changes) == rows(snapshot_changes(before, after, "k")) and changes.count() == 4
    differing = differing_buckets(spark, *paths)
    assert 1 <= len(differing) <= 3
    assert "PartitionFilters: [bucket" in physical_plan(changes)
    assert differing_buckets(spark, paths[0], paths[0]) == []
    assert stored_snapshot(spark, paths[0], differing).count() < 200 and stored_snapshot(spark, paths[0]).count() == 2000


def test_a_moved_null_changes_the_digest(spark, tmp_path):
    schema = "k int, a string, b string"
    for name, row in (("x", (1, None, "v")), ("y", (1, "v", None)), ("z", (1, "v", "v"))):
        store_snapshot(spark.createDataFrame([row], schema), str(tmp_path / name), "k", buckets=4)
    for one, other in (("x", "y"), ("x", "z"), ("y", "z")):
        assert len(differing_buckets(spark, str(tmp_path / one), str(tmp_path / other))) == 1


def test_keyed_sync_sees_late_publications_and_ignores_older_versions(spark, tmp_path):
    feed, log, checkpoint, base = (str(tmp_path / n) for n in ("feed", "log", "checkpoint", "base"))

    def found(*more):
        return sorted((r.document_id, r.commit_version, r.content) for r in keyed_index(spark, log, *more).collect())

    one, two = snapshot(spark, ("a", "x"), ("b", "y")), snapshot(spark, ("a", "xx"), ("c", "z"))
    publish_changes(None, one, feed, 0)
    run_keyed_sync(spark, feed, log, checkpoint, embed_length)
    publish_changes(one, two, feed, 2)
    run_keyed_sync(spark, feed, log, checkpoint, embed_length)
    run_keyed_sync(spark, feed, log, checkpoint, embed_length)  # nothing new
    assert found() == [("a", 2, "xx"), ("c", 2, "z")]
    compact_keyed_index(spark, log, base)
    # an older version comes late: what it says of documents with a newer version does not count
    publish_changes(one, snapshot(spark, ("a", "old"), ("b", "old"), ("d", "w")), feed, 1)
    run_keyed_sync(spark, feed, log, checkpoint, embed_length)
    assert found() == found(base) == [("a", 2, "xx"), ("c", 2, "z"), ("d", 1, "w")]
    # the newest version comes again with other texts, and with a document that is back
    publish_changes(one, snapshot(spark, ("a", "right"), ("b", "yy")), feed, 2)
    run_keyed_sync(spark, feed, log, checkpoint, embed_length)
    assert [r for r in found() if r[0] != "c"] == [("a", 2, "right"), ("b", 2, "yy"), ("d", 1, "w")] and found() == found(base)


def test_keyed_sync_keeps_state_without_python_and_logs_only_changes(spark, tmp_path, monkeypatch):
    feed, log, checkpoint = (str(tmp_path / n) for n in ("feed", "log", "checkpoint"))
    states, drain = [], keyed_sync.drain

    def watched(query):
        drain(query)
        states.extend(state["operatorName"] for p in query.recentProgress for state in p["stateOperators"])

    def taken():
        """Rows in the log and what is current after taking in what is new."""
        run_keyed_sync(spark, feed, log, checkpoint, embed_length)
        current = keyed_index(spark, log).collect()
        return spark.read.parquet(log).count(), sorted((r.document_id, r.commit_version, r.content) for r in current)

    monkeypatch.setattr(keyed_sync, "drain", watched)
    first = snapshot(spark, ("a", "x"), ("b", "y"), ("n", None), (None, "no id"))
    publish_changes(None, first, feed, 0)
    assert taken() == (3, [("a", 0, "x"), ("b", 0, "y"), ("n", 0, "")])
    # the same texts again: every document is spoken of, none has changed
    publish_changes(None, first, feed, 0)
    assert taken() == (3, [("a", 0, "x"), ("b", 0, "y"), ("n", 0, "")])
    # 'a' has another text, goes, and is back with the text it had at first
    publish_changes(None, snapshot(spark, ("a", "z")), feed, 0)
    assert taken() == (4, [("a", 0, "z"), ("b", 0, "y"), ("n", 0, "")])
    snapshot(spark, ("a", "z")).withColumn("change_type", F.lit("delete")).write.mode("overwrite").parquet(f"{feed}/commit_version=0")
    assert taken() == (5, [("b", 0, "y"), ("n", 0, "")])
    publish_changes(None, snapshot(spark, ("a", "x")), feed, 0)
    assert taken() == (6, [("a", 0, "x"), ("b", 0, "y"), ("n", 0, "")])
    # a version comes again beside its earlier rows: only what came last counts
    again = snapshot(spark, ("a", "w")).withColumn("change_type", F.lit("insert"))
    again.write.mode("append").parquet(f"{feed}/commit_version=0")
    assert taken() == (7, [("a", 0, "w"), ("b", 0, "y"), ("n", 0, "")])
    assert set(states) == {"stateStoreSave"}
