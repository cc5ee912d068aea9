"""A streaming data source that polls folders for sessions.

An offset is the number of a poll. A poll lists nothing by itself: each of its PARTS tasks lists the entries below the roots whose names hash to
it, compares them with the part's listing of the poll before, and writes its rows as one file of the state folder, under a name that only one
writer can take. Whoever reads the same poll again (a retried or doubled task, a batch after a restart) gives out that file's rows, whatever the
folders hold by then; so a poll's rows never change, and none is lost or doubled. `commit` removes the files of polls before the committed
one, which stays as the base of the next comparison.

The folders and the state folder must be mounted where tasks run.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from sessionloom.sources.inventory import NAME_RULES, SessionWalk

SCHEMA = "name string, path string, size long, mtime double, change string, observed_at double, poll long"
PARTS = 16
_FILE = re.compile(r"^part-(\d+)-poll-(\d+)\.json$")


class _Part(InputPartition):
    def __init__(self, part: int, poll: int, fresh: bool):
        self.part, self.poll, self.fresh = part, poll, fresh


class PollReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.roots = [r for r in options.get("path", "").split(";") if r]
        self.state = options["state"].removeprefix("file://").removeprefix("file:")
        self.parts = int(options.get("parts", str(PARTS)))
        self.again = options.get("unchanged", "false").lower() == "true"
        self.every = float(options.get("seconds", "0"))
        rule = options.get("rule", "digit")
        self.walk = SessionWalk(NAME_RULES.get(rule, rule), int(options.get("depth", "6")))
        self.poll, self.at = 0, None

    # --- on the driver ---

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        """The next poll, or the last one again where it is less than `seconds` ago."""
        now = time.monotonic()
        if self.at is None or now - self.at >= self.every:
            self.poll, self.at = max(self.poll, max((p for _, p in self._files()), default=0)) + 1, now
        return {"poll": self.poll}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Polls between that nobody has listed are left out: only the last one is listed anew."""
        known = set(self._files())
        return [_Part(k, p, p == end["poll"]) for p in range(start["poll"] + 1, end["poll"] + 1) for k in range(self.parts) if p == end["poll"] or (k, p) in known]

    def commit(self, end: dict) -> None:
        last = {k: max((p for j, p in self._files() if j == k and p <= end["poll"]), default=0) for k in range(self.parts)}
        for k, p in self._files():
            if p < last.get(k, 0):
                try:
                    os.remove(self._path(k, p))
                except FileNotFoundError:
                    pass

    # --- in tasks ---

    def _path(self, part: int, poll: int) -> str:
        return os.path.join(self.state, f"part-{part}-poll-{poll}.json")

    def _files(self) -> list[tuple[int, int]]:
        try:
            found = map(_FILE.match, os.listdir(self.state))
        except FileNotFoundError:
            return []
        return sorted((int(m[1]), int(m[2])) for m in found if m)

    def _load(self, part: int, poll: int) -> dict | None:
        try:
            with open(self._path(part, poll), encoding="utf-8", errors="surrogateescape") as f:
                return json.load(f)
        except FileNotFoundError:
            return None

    def _listed(self, part: int, poll: int) -> dict:
        """Lists the part now and writes what it found, unless someone else has done so meanwhile."""
        before = next((self._load(k, p) for k, p in reversed(self._files()) if k == part and p < poll), None)
        known = {r[1]: r for r in (before["rows"] if before else []) if r[4] != "gone"}
        rows = []
        for root in self.roots:
            tops = [e for e in self.walk.folders(root) if crc32(e.name.encode("utf-8", "surrogateescape")) % self.parts == part]
            for name, path, size, mtime in self.walk.sessions(tops):
                old = known.pop(path, None)
                change = "new" if old is None else "same" if old[2:4] == [size, mtime] else "changed"
                rows.append([name, path, size, mtime, change])
        rows += [[r[0], p, None, None, "gone"] for p, r in known.items()]
        made = {"observed_at": time.time(), "rows": rows}
        os.makedirs(self.state, exist_ok=True)
        draft = os.path.join(self.state, f"draft-{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8", errors="surrogateescape") as f:
            json.dump(made, f, ensure_ascii=False)
        try:
            os.link(draft, self._path(part, poll))  # fails where the name is taken
        except FileExistsError:
            made = self._load(part, poll)
        finally:
            os.remove(draft)
        return made

    def read(self, partition: _Part):
        made = self._load(partition.part, partition.poll)
        if made is None:
            made = self._listed(partition.part, partition.poll) if partition.fresh else {"rows": []}
        for name, path, size, mtime, change in made["rows"]:
            if change != "same" or self.again:
                yield name, path, size, mtime, change, made["observed_at"], partition.poll


class PollSource(DataSource):
    """Options: path (roots by `;`), state (a folder of this query alone), rule, depth (see InventorySource), parts, seconds (the least time between polls), unchanged (true: all sessions with every poll)."""

    @classmethod
    def name(cls) -> str:
        return "session_polls"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PollReader(self.options)


def polled(spark: SparkSession, roots: list[str], state: str, rule: str = "digit", depth: int = 6, seconds: float = 0.0, unchanged: bool = False, parts: int = PARTS) -> DataFrame:
    """name, path, size, mtime, change (new, changed, gone, same), observed_at, poll: a stream of the sessions below the roots as they appear, change and go.

    size is the sum of a session's files, mtime the latest time in its tree, sub-folders included. A session that is gone has neither. With `unchanged` each poll gives
    all sessions, as the stability gate needs them.
    """
    spark.dataSource.register(PollSource)
    stream = spark.readStream.format("session_polls").option("path", ";".join(roots)).option("state", state).option("rule", rule).option("depth", str(depth))
    return stream.option("seconds", str(seconds)).option("unchanged", str(unchanged).lower()).option("parts", str(parts)).load()
