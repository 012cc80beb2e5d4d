"""Tables of commits: crashes, replays and rival writers; streams and captures on them."""

import collections
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from reelmart.sources import files as FS
from reelmart.sources.scratch import new_scratch
from reelmart.sources.versioned import MOST_FOLDERS, CommitConflict, VersionedTable
from reelmart.streaming import streams as ST


class Crash(Exception):
    pass


def crash_at_commit(monkeypatch, times=1):
    """The next commits die after the data is written, before the table shows it."""
    left, real = [times], VersionedTable.commit

    def commit(self, *args, **kwargs):
        if left[0]:
            left[0] -= 1
            raise Crash
        return real(self, *args, **kwargs)
    monkeypatch.setattr(VersionedTable, "commit", commit)


def rows_of(table):
    df = table.read()
    return [] if df is None else sorted(map(tuple, df.collect()))


def test_append_is_whole_or_nothing(spark, monkeypatch):
    table = VersionedTable(spark, new_scratch(spark, "t"))
    assert table.read() is None
    assert table.append(lambda have: spark.range(3).withColumn("x", F.lit("a"))) == 3
    crash_at_commit(monkeypatch)
    with pytest.raises(Crash):
        table.append(lambda have: spark.range(3, 5).withColumn("x", F.lit("b")))
    assert rows_of(table) == [(0, "a"), (1, "a"), (2, "a")]
    assert table.append(lambda have: spark.range(3, 5).withColumn("x", F.lit("b"))) == 2
    assert len(rows_of(table)) == 5


def test_rival_writer_makes_a_writer_look_again(spark):
    """Two writers start from one version: neither's rows are lost or doubled."""
    path = new_scratch(spark, "rivals")
    mine, rival = VersionedTable(spark, path), VersionedTable(spark, path)
    base = mine.state()
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "asset_id string")
    seen = []

    def fresh(have):
        seen.append(have)
        if len(seen) == 1:  # the other one commits while this one is at work
            rival.append(lambda h: rows("a", "b"))
        both = rows("b", "c")
        return both if have is None else both.join(have, "asset_id", "left_anti")

    assert mine.append(fresh) == 1
    assert len(seen) == 2 and rows_of(mine) == [("a",), ("b",), ("c",)]
    with pytest.raises(CommitConflict):
        mine.commit(base, rows("x").schema, {})


def test_a_writer_late_by_many_commits_is_refused(spark):
    """Old versions are vacuumed, yet a late commit never slips in beneath the last."""
    table = VersionedTable(spark, new_scratch(spark, "late-writer"))
    table.append(lambda have: spark.range(1))
    base = table.state()
    for i in range(4):
        table.append(lambda have: spark.range(1))
        table.vacuum(1)
    with pytest.raises(CommitConflict):
        table.commit(base, spark.range(1).schema, {"": ["data/lost"]})
    assert len(rows_of(table)) == 5


def test_an_epoch_is_added_once(spark):
    table = VersionedTable(spark, new_scratch(spark, "epochs"))
    for epoch in (0, 1, 1, 0):
        table.append(lambda have: spark.range(2), ("s", epoch))
    assert len(rows_of(table)) == 4
    table.append(lambda have: spark.range(2), ("another", 0))
    assert len(rows_of(table)) == 6


def test_folders_of_many_appends_are_compacted(spark):
    table = VersionedTable(spark, new_scratch(spark, "many"))
    for i in range(MOST_FOLDERS + 2):
        table.append(lambda have, i=i: spark.range(i, i + 1).coalesce(1))
    folders = table.state()["folders"][""]
    assert len(folders) <= 2 and rows_of(table) == [(i,) for i in range(MOST_FOLDERS + 2)]
    assert table.vacuum(1) > 0 and rows_of(table) == [(i,) for i in range(MOST_FOLDERS + 2)]
    assert table.vacuum(1) == 0 and len(table.names("data")) == len(folders)


def test_merge_touches_only_its_parts(spark):
    table = VersionedTable(spark, new_scratch(spark, "parts"))
    put = lambda rows: table.merge(
        spark.createDataFrame(rows, "m string, v int"), F.col("m"),
        lambda old, new: new if old is None else old.unionByName(new).groupBy("m").agg(F.sum("v").cast("int").alias("v")))
    put([("2024-01", 1), ("2024-02", 2)])
    before = table.state()["folders"]
    put([("2024-02", 5), ("2024-03", 7)])
    after = table.state()["folders"]
    assert before["2024-01"] == after["2024-01"] and before["2024-02"] != after["2024-02"]
    assert rows_of(table) == [("2024-01", 1), ("2024-02", 7), ("2024-03", 7)]


_PULL = ("ad_id STRING, perf_date DATE, impressions BIGINT, plays_3s BIGINT, plays_25 BIGINT, plays_50 BIGINT, "
         "plays_75 BIGINT, plays_100 BIGINT, sum_watch_time_sec BIGINT, play_count BIGINT, link_clicks BIGINT, "
         "results BIGINT, spend BIGINT, load_ts TIMESTAMP, platform_name STRING")


def pull(ad, day, n, loaded):
    return (ad, day, *[n] * 11, loaded, "meta")


def test_upsert_stream_survives_a_crash_between_its_writes(spark, monkeypatch):
    """Data written, commit not: the table is as before, and the replay loses nothing."""
    from reelmart.operators import perf as P
    root = new_scratch(spark, "crash")
    jan, feb = datetime(2024, 1, 5), datetime(2024, 2, 5)

    def run():
        return ST.stream_perf_upsert(spark, f"{root}/pulls", _PULL, f"{root}/t", f"{root}/cp", P.latest_pull)

    def land(*rows):
        spark.createDataFrame(rows, _PULL).coalesce(1).write.mode("append").parquet(f"{root}/pulls")

    land(pull("a", jan.date(), 1, jan), pull("b", jan.date(), 2, jan), pull("a", feb.date(), 3, feb))
    run()
    land(pull("a", jan.date(), 10, feb), pull("c", feb.date(), 4, feb))
    with monkeypatch.context() as m:
        crash_at_commit(m)
        with pytest.raises(Exception):
            run()
    table = VersionedTable(spark, f"{root}/t/table")
    assert sorted((r.ad_id, r.impressions) for r in table.read().collect()) == [("a", 1), ("a", 3), ("b", 2)]
    got = sorted((r.ad_id, r.perf_date.month, r.impressions) for r in run().collect())
    assert got == [("a", 1, 10), ("a", 2, 3), ("b", 1, 2), ("c", 2, 4)]


def test_assets_stay_known_for_ever(spark):
    """An asset that comes again after two years is not emitted; nor is an old
    one late, whatever came before it."""
    root = new_scratch(spark, "years")
    cols = "asset_id STRING, client_id STRING, content_sha256 STRING, modified_at TIMESTAMP"

    def land(*rows):
        spark.createDataFrame([(a, "c", "s", t) for a, t in rows], cols).coalesce(1) \
            .write.mode("append").parquet(f"{root}/landing")
        out = ST.stream_new_assets(spark, f"{root}/landing", cols, f"{root}/sink", f"{root}/cp")
        return sorted((r.asset_id, r.modified_at.year) for r in out.collect())

    assert land(("a", datetime(2022, 1, 1)), ("a", datetime(2022, 1, 2))) == [("a", 2022)]
    assert land(("a", datetime(2024, 6, 1)), ("b", datetime(2024, 6, 1))) == [("a", 2022), ("b", 2024)]
    assert land(("old", datetime(2019, 1, 1))) == [("a", 2022), ("b", 2024), ("old", 2019)]


def test_daily_counts_and_late_events_add_up(spark, monkeypatch):
    root = new_scratch(spark, "late")
    cols = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    day = lambda d, h=12: datetime(2024, 1, 1, h) + timedelta(days=d)
    batches = [[(1, day(0)), (2, day(1)), (3, day(5))],      # day 5 closes days 0 to 2 (delay two days)
               [(4, day(0)), (5, day(2, 23)), (6, day(3)), (7, day(40))],
               [(8, day(39)), (9, day(3)), (10, None), (11, day(38))]]
    seen, late = [], []
    for i, rows in enumerate(batches):
        spark.createDataFrame([(e, t, 1, "x", 1.0, "") for e, t in rows], cols).coalesce(1) \
            .write.mode("append").parquet(f"{root}/events")
        run = lambda: ST.stream_daily_counts(spark, f"{root}/events", "*.parquet", cols, f"{root}/t",
                                             f"{root}/cp", delay=timedelta(days=2))
        if i == 1:  # the late rows are committed, the counts are not: the replay mends it
            with monkeypatch.context() as m:
                real, count = VersionedTable.commit, collections.Counter()

                def commit(self, *args, **kwargs):
                    count["n"] += 1
                    if count["n"] == 2:
                        raise Crash
                    return real(self, *args, **kwargs)
                m.setattr(VersionedTable, "commit", commit)
                with pytest.raises(Exception):
                    run()
        out = run()
        seen = {r.day and r.day.toordinal() - datetime(2024, 1, 1).toordinal(): r.n for r in
                out.groupBy("day").agg(F.sum("n_events").alias("n")).collect()}
        late = sorted(r.event_id for r in ST.late_events(spark, f"{root}/t").collect())
    assert late == [4, 5, 9] and seen == {0: 1, 1: 1, 3: 1, 5: 1, 38: 1, 39: 1, 40: 1, None: 1}
    assert sum(seen.values()) + len(late) == sum(map(len, batches))
    counts = VersionedTable(spark, f"{root}/t/counts")
    assert all(len(f) == 1 for f in counts.state()["folders"].values())  # a folder a month
    assert len(counts.names("data")) <= 2 * len(counts.state()["folders"])


def test_capture_is_idempotent_by_content(spark, tmp_path, monkeypatch):
    schema, target = "ad_id STRING, day DATE, n BIGINT", new_scratch(spark, "capture")
    export = tmp_path / "export"
    export.mkdir()
    (export / "a.csv").write_text("ad_id,day,n\nx,2024-01-01,1\ny,2024-01-01,2\ny,2024-01-01,2\n")
    began = datetime.now(timezone.utc)

    def capture():
        rows = FS.capture_raw_csv(spark, str(export), schema, target)
        return sorted((r.source_file.rsplit("/", 1)[1], r.ad_id, r.n) for r in rows.collect())

    one = [("a.csv", "x", 1), ("a.csv", "y", 2), ("a.csv", "y", 2)]
    assert capture() == capture() == one
    # a second delivery of the same rows, in another order and under another name, and a new file
    (export / "b.csv").write_text("ad_id,day,n\ny,2024-01-01,2\nx,2024-01-01,1\ny,2024-01-01,2\n")
    (export / "c.csv").write_text("ad_id,day,n\nx,2024-01-01,3\n")
    with monkeypatch.context() as m:
        crash_at_commit(m)
        with pytest.raises(Crash):
            capture()
    assert sorted(r.ad_id for r in VersionedTable(spark, target).read().collect()) == ["x", "y", "y"]
    assert capture() == capture() == one + [("c.csv", "x", 3)]
    audit = FS.capture_audit(VersionedTable(spark, target).read(), began).collect()
    assert sorted((r.n_rows, r.n_without_time, r.n_before_run, r.n_times) for r in audit) == [(1, 0, 0, 1), (3, 0, 0, 1)]
    later = FS.capture_audit(VersionedTable(spark, target).read(), datetime.now(timezone.utc) + timedelta(hours=1))
    assert sorted(r.n_before_run for r in later.collect()) == [1, 3]


def test_two_appends_of_one_asset_keep_one(spark, monkeypatch):
    path = new_scratch(spark, "assets")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "asset_id string, x int")
    crash_at_commit(monkeypatch)
    with pytest.raises(Crash):
        FS.manifest_append(rows, path)
    assert FS.stored_rows(spark, path) is None
    assert FS.manifest_append(rows, path) == 2 and FS.manifest_append(rows, path) == 0
    assert sorted(map(tuple, FS.stored_rows(spark, path).collect())) == [("a", 1), ("b", 2)]


def test_overwritten_is_replaced_in_one_step(spark, monkeypatch):
    path = new_scratch(spark, "silver")
    assert FS.overwritten(spark.range(5), path, ["id"]).count() == 5
    with monkeypatch.context() as m:
        crash_at_commit(m)
        with pytest.raises(Crash):
            FS.overwritten(spark.range(2), path, ["id"])
    assert VersionedTable(spark, path).read().count() == 5
    assert FS.overwritten(spark.range(2), path, ["id"]).count() == 2
