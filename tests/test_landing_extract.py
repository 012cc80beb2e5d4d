"""Landing listed and hashed in tasks; extraction rounds with failures and restarts."""

import collections
import hashlib
import json

import pytest

from reelmart.operators import extract as EX
from reelmart.sources import landing as LD
from reelmart.sources.scratch import new_scratch
from reelmart.sources.versioned import VersionedTable


def test_listing_by_prefix(spark, tmp_path):
    want = {}
    for c in range(3):
        for i in range(4):
            f = tmp_path / f"landing/c{c}/video" / f"sub {i % 2}" / f"a{i}%.mp4"
            f.parent.mkdir(parents=True, exist_ok=True)
            f.write_bytes(bytes([c]) * (i * 1000))
            want[str(f)] = (i * 1000, hashlib.sha256(f.read_bytes()).hexdigest())
    (tmp_path / "landing/c0/video/.hidden").write_bytes(b"x")
    (tmp_path / "landing/c0/_golden").mkdir()
    (tmp_path / "landing/c0/_golden/b.mp4").write_bytes(b"golden")
    prefixes = spark.createDataFrame([(f"{tmp_path}/landing/c{c}/video",) for c in (0, 1, 2, 2, 9)], "prefix string")
    rows = LD.hash_objects(LD.list_prefixes(prefixes, tasks=4)).collect()
    assert {r.path: (r.length, r.content_sha256) for r in rows} == want and len(rows) == len(want)
    assert all(abs(r.modified_at.timestamp() - (tmp_path / r.path).stat().st_mtime) < 1 for r in rows)
    assert LD.list_prefixes(prefixes.limit(0)).count() == 0
    uris = spark.createDataFrame([(f"file://{tmp_path}/landing/c1/video",)], "prefix string")
    assert LD.hash_objects(LD.list_prefixes(uris)).count() == 4


def test_many_objects_are_listed_by_tasks(spark, tmp_path):
    """The plan has no file scan: the driver never holds a status."""
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(25_000):
        (folder / f"{i}.bin").touch()
    listing = LD.list_prefixes(spark.createDataFrame([(str(folder),)], "prefix string"))
    assert listing.count() == 25_000
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "MapInArrow" in plan


def caller(log, fails):
    """Calls leave a line each in ``log``; ``fails``: asset -> attempts that fail."""
    def call(asset):
        with open(f"{log}/{asset['asset_id']}", "a") as f:
            f.write("x")
        if asset["attempt"] <= fails.get(asset["asset_id"], 0):
            raise ConnectionError("busy")
        if asset["asset_id"] == "broken":
            return {"raw_response": "not json"}
        return {"raw_response": json.dumps({"chunks": [1] * len(asset["text"])}), "model_version": "m",
                "prompt_version": "p", "tokens_in": 7}
    return call


@pytest.fixture
def stage(spark, tmp_path):
    root = new_scratch(spark, "extract-test")
    ids = ["a", "b", "c", "d", "broken", "never"]
    assets = spark.createDataFrame([(i, f"c{len(i)}", "s" + i, "t" * n) for n, i in enumerate(ids)] * 2,
                                   "asset_id string, client_id string, content_sha256 string, text string")
    return (assets, str(tmp_path), VersionedTable(spark, f"{root}/bronze", ["client_id"]),
            VersionedTable(spark, f"{root}/runs"))


def calls(log):
    import os
    return {n: os.path.getsize(f"{log}/{n}") for n in os.listdir(log)}


def test_extraction_ends_in_one_response_an_asset(stage):
    assets, log, bronze, runs = stage
    fails = {"b": 1, "c": 2, "never": 99}
    left = EX.extract(assets, caller(log, fails), bronze, runs, attempts=3, slices=2, concurrent=3, pause_sec=0)
    assert left == 2
    got = {r.asset_id: (r.chunk_count, r.content_sha256) for r in bronze.read().collect()}
    assert got == {"a": (0, "sa"), "b": (1, "sb"), "c": (2, "sc"), "d": (3, "sd")} and bronze.read().count() == 4
    errors = collections.Counter((r.asset_id, r.error.split(":")[0]) for r in runs.read().where("error is not null").collect())
    assert errors == {("b", "ConnectionError"): 1, ("c", "ConnectionError"): 2, ("never", "ConnectionError"): 3,
                      ("broken", "JSONDecodeError"): 3}
    summary = {r.asset_id: (r.n_calls, r.n_errors, r.last_attempt, r.extracted) for r in EX.run_summary(runs.read()).collect()}
    assert summary["c"] == (3, 2, 3, True) and summary["never"] == (3, 3, 3, False) and summary["a"] == (1, 0, 1, True)
    before = calls(log)
    EX.extract(assets.where("asset_id < 'broken' or asset_id in ('c', 'd')"), caller(log, {}), bronze, runs, pause_sec=0)
    assert calls(log) == before  # Bronze holds them all: nothing is called twice


def test_extraction_goes_on_after_a_crash(stage, monkeypatch):
    """The stage dies after its calls, before or between its commits: the next
    run commits what was answered and calls for nothing again."""
    assets, log, bronze, runs = stage
    assets = assets.where("asset_id not in ('broken', 'never')")
    real = VersionedTable.commit
    for dies_at in (1, 2):
        count = collections.Counter()

        def commit(self, *args, **kwargs):
            count["n"] += 1
            if count["n"] == dies_at:
                raise KeyboardInterrupt
            return real(self, *args, **kwargs)
        with monkeypatch.context() as m:
            m.setattr(VersionedTable, "commit", commit)
            if dies_at == 1:
                with pytest.raises(KeyboardInterrupt):
                    EX.extract(assets, caller(log, {}), bronze, runs, pause_sec=0)
            else:
                with pytest.raises(KeyboardInterrupt):
                    EX.recover(bronze, runs)
    assert EX.extract(assets, caller(log, {}), bronze, runs, pause_sec=0) == 0
    assert calls(log) == dict.fromkeys("abcd", 1)
    assert sorted(r.asset_id for r in bronze.read().collect()) == list("abcd")
    assert sorted(r.asset_id for r in runs.read().collect()) == list("abcd")


def test_more_slices_and_tasks_than_assets(stage):
    assets, log, bronze, runs = stage
    assert EX.extract(assets.where("asset_id = 'a'"), caller(log, {}), bronze, runs, slices=5, concurrent=8,
                      pause_sec=0) == 0
    assert EX.extract(assets.limit(0), caller(log, {}), bronze, runs, pause_sec=0) == 0
    assert calls(log) == {"a": 1}
