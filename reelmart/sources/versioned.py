"""Parquet tables whose every change is one commit.

Data is written into fresh folders that nobody reads yet; a change becomes
visible when a small commit file, which names the folders that make up the
table, is renamed into place. A job that dies before that leaves the table as
it was; a job that is run again does the same change once. Two writers start
from the same version at most once: the second rename finds the name taken,
and the writer repeats its work on the new version.

Commit files hold names only: a folder list for each part of the table (a
month, a client, or the one part of a plain table) and the last epoch of each
stream that writes to it. Rows never pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import suppress
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelmart.sources import paths

#: the part of a table that has no parts
WHOLE = ""
#: folders of one part that are rewritten into one when it has more
MOST_FOLDERS = 64
#: commit files kept by ``vacuum``: a writer that is late by fewer commits finds its name taken
KEPT_COMMITS = 100
#: rows of a batch that are merged together, unless one part has more
MOST_MERGED = 32_000_000
_PART = "_part"


def parts_together(rows_of: dict[str, int]) -> list[list[str]]:
    """Parts in groups of at most ``MOST_MERGED`` rows (or of one part)."""
    groups, held = [], 0
    for name, rows in sorted(rows_of.items()):
        if not groups or held + rows > MOST_MERGED:
            groups.append([])
            held = 0
        groups[-1].append(name)
        held += rows
    return groups


class CommitConflict(Exception):
    """Another writer has committed this version."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, cluster_by: list[str] | None = None):
        """``cluster_by``: columns whose values stand together in the files of
        appends, so that a filter on them skips row groups."""
        self.spark, self.root, self.cluster_by = spark, root.rstrip("/"), cluster_by or []

    def names(self, folder: str) -> list[str]:
        """What lies in a folder under the table's root."""
        return paths.names(self.spark, f"{self.root}/{folder}")

    # versions ------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.names("_commits") if n.endswith(".json") and n[0] != "."]

    def state(self, version: int | None = None) -> dict:
        """The committed table: version, schema, folders by part, last epochs, notes."""
        known = self.versions()
        if not known:
            return {"version": 0, "schema": None, "folders": {}, "streams": {}, "notes": {}}
        return json.loads(paths.read_text(self.spark, f"{self.root}/_commits/{version or known[-1]:010d}.json"))

    def commit(self, base: dict, schema: StructType, folders: dict[str, list[str]],
               streams: dict[str, int] | None = None, notes: dict[str, str] | None = None) -> dict:
        """Put ``folders`` (of the parts named) in place of ``base``'s, in one step."""
        state = {"version": base["version"] + 1, "schema": schema.json(),
                 "folders": {k: v for k, v in (base["folders"] | folders).items() if v},
                 "streams": base["streams"] | (streams or {}), "notes": base["notes"] | (notes or {})}
        if (self.versions() or [0])[-1] != base["version"]:
            raise CommitConflict(f"{self.root}, version {state['version']}")
        draft = f"{self.root}/_commits/.{uuid.uuid4().hex}"
        paths.write_text(self.spark, draft, json.dumps(state))
        try:
            paths.rename_new(self.spark, draft, f"{self.root}/_commits/{state['version']:010d}.json")
        except paths.NameTaken:
            paths.delete(self.spark, draft)
            raise CommitConflict(f"{self.root}, version {state['version']}") from None
        return state

    # rows ----------------------------------------------------------------
    def read(self, state: dict | None = None, parts: list[str] | None = None) -> DataFrame | None:
        """The committed rows (of some parts); None if the table is not there yet."""
        state = state or self.state()
        if not state["schema"]:
            return None
        schema = StructType.fromJson(json.loads(state["schema"]))
        found = [f"{self.root}/{f}" for part, folders in state["folders"].items()
                 if parts is None or part in parts for f in folders]
        return (self.spark.read.schema(schema).parquet(*found) if found
                else self.spark.createDataFrame([], schema))

    def write(self, rows: DataFrame, base: dict, part: Column | None = None) -> dict[str, str]:
        """Write rows into a fresh folder that is not part of the table yet;
        returns its folder by part."""
        folder = f"data/{base['version'] + 1:010d}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{folder}"
        if part is None:
            if self.cluster_by:
                rows = rows.hint("rebalance", *self.cluster_by).sortWithinPartitions(*self.cluster_by)
            rows.write.parquet(path)
            return {WHOLE: folder}
        (rows.withColumn(_PART, part).hint("rebalance", _PART)
         .write.partitionBy(_PART).parquet(path))
        names = [n for n in self.names(folder) if n.startswith(f"{_PART}=")]
        return {unquote(n.split("=", 1)[1]): f"{folder}/{n}" for n in names}

    # changes -------------------------------------------------------------
    def append(self, fresh: Callable[[DataFrame | None], DataFrame],
               stream: tuple[str, int] | None = None) -> int:
        """Add the rows that ``fresh`` finds, given the committed ones; returns
        how many. ``stream`` (name, epoch): an epoch is added once."""
        while True:
            base = self.state()
            if stream and base["streams"].get(stream[0], -1) >= stream[1]:
                return 0
            rows = fresh(self.read(base))
            new = self.write(rows, base)
            added = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{new[WHOLE]}").count()  # from footers
            if not added and not stream and base["schema"]:
                return 0
            old = base["folders"].get(WHOLE, [])
            folders = {WHOLE: old + [new[WHOLE]] if added else old}
            with suppress(CommitConflict):
                state = self.commit(base, rows.schema, folders, dict([stream]) if stream else None)
                if len(state["folders"].get(WHOLE, [])) > MOST_FOLDERS:
                    self.compact(WHOLE)
                return added

    def replace(self, rows: DataFrame) -> None:
        """Put ``rows`` in place of the whole table."""
        while True:
            base = self.state()
            new = self.write(rows, base)
            with suppress(CommitConflict):
                self.commit(base, rows.schema, {p: [] for p in base["folders"]} | {WHOLE: [new[WHOLE]]})
                return

    def merge(self, batch: DataFrame, part: Column,
              combine: Callable[[DataFrame | None, DataFrame], DataFrame],
              stream: tuple[str, int] | None = None, notes: dict[str, str] | None = None) -> None:
        """Replace the parts that ``batch`` touches by ``combine`` of their
        committed rows and the batch's; other parts are neither read nor
        written. ``part`` must give the same parts before and after; null is one.
        A large batch is merged some parts at a time, so that what lies shuffled
        on disk is bounded; all become visible in one commit."""
        part = F.coalesce(part.cast("string"), F.lit("null"))
        while True:
            base = self.state()
            if stream and base["streams"].get(stream[0], -1) >= stream[1]:
                return
            rows_of = {r[0]: r[1] for r in batch.groupBy(part.alias(_PART)).count().collect()}
            new: dict[str, str] = {}
            groups = parts_together(rows_of)
            for group in groups or [[]]:
                some = batch if len(groups) < 2 else batch.where(part.isin(group))
                rows = combine(self.read(base, group), some)
                new |= self.write(rows, base, part)
            with suppress(CommitConflict):
                self.commit(base, rows.schema, {p: [new[p]] if p in new else [] for p in rows_of},
                            dict([stream]) if stream else None, notes)
                return

    def compact(self, part: str) -> None:
        """Rewrite a part's folders into one; the rows stay the same."""
        base = self.state()
        rows = self.read(base, [part])
        new = self.write(rows if self.cluster_by else rows.hint("rebalance"), base)
        with suppress(CommitConflict):  # then the next writer finds it still long
            self.commit(base, rows.schema, {part: [new[WHOLE]]})

    def vacuum(self, keep: int = 2) -> int:
        """Delete data folders older than the last ``keep`` versions that none of
        these names (also those of writers that died), and old commit files."""
        kept = self.versions()[-keep:]
        if not kept:
            return 0
        named = {f.split("/")[1] for v in kept for fs in self.state(v)["folders"].values() for f in fs}
        gone = [f"data/{n}" for n in self.names("data") if n not in named and int(n[:10]) < kept[0]]
        gone += [f"_commits/{v:010d}.json" for v in self.versions()[:-max(keep, KEPT_COMMITS)]]
        for name in gone:
            paths.delete(self.spark, f"{self.root}/{name}")
        return len(gone)
