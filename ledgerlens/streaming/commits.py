"""The stream's commit log: which batches are stored whole, and in which order they came.

A batch writes its tables into folders of its own and then one marker, a line of JSON. What has no marker does not
exist for readers, so a half-written batch is invisible and a later try may overwrite it. Batches are known by the query
that ran them and its batch number: a query with a new checkpoint counts from 0 again, but under another id, and
overwrites nothing. Markers are numbered in the order of commits; that number is what a merge remembers.

One writer at a time is assumed, as a checkpoint allows only one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.storage import delete, list_files, read_text, write_text

SCHEMA = "seq bigint, commit string, segments array<struct<name: string, level: int, bits: int, ids: bigint>>"
#: So many markers are gathered into one file.
GATHER = 100


@dataclass(frozen=True)
class Segment:
    """A part of the id index; see ``id_index``."""

    name: str
    level: int
    bits: int
    ids: int


@dataclass(frozen=True)
class Commit:
    seq: int
    commit: str
    segments: list[Segment] = field(default_factory=list)

    def line(self) -> str:
        return json.dumps({"seq": self.seq, "commit": self.commit, "segments": [vars(s) for s in self.segments]})


def _parsed(line: str) -> Commit:
    held = json.loads(line)
    return Commit(held["seq"], held["commit"], [Segment(**s) for s in held["segments"]])


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    folder: str

    def _files(self) -> list[str]:
        return sorted(f for f in list_files(self.spark, self.folder) if f.endswith(".json"))

    def lines(self) -> dict[int, Commit]:
        """All commits by number."""
        held = [_parsed(x) for f in self._files() for x in read_text(self.spark, f"{self.folder}/{f}").splitlines()]
        return {c.seq: c for c in held}

    def last(self) -> Commit | None:
        files = self._files()
        return _parsed(read_text(self.spark, f"{self.folder}/{files[-1]}").splitlines()[-1]) if files else None

    def has(self, commit: str) -> bool:
        return any(c.commit == commit for c in self.lines().values())

    def table(self) -> DataFrame:
        """seq, commit: one row per stored batch."""
        if not self._files():
            return self.spark.createDataFrame([], "seq bigint, commit string")
        lines = self.spark.read.schema(SCHEMA).json(self.folder)
        return lines.select("seq", "commit").dropDuplicates(["seq"])

    def add(self, commit: str, segments: list[Segment]) -> Commit:
        """The point from which on a batch exists. Every GATHER commits the earlier markers move into one file."""
        last = self.last()
        made = Commit(last.seq + 1 if last else 0, commit, segments)
        name = f"{made.seq:012d}.json"
        if made.seq % GATHER == GATHER - 1:
            earlier = self._files()
            # Of the index only the newest marker's state is ever used again.
            lines = [Commit(c.seq, c.commit).line() for _, c in sorted(self.lines().items())]
            write_text(self.spark, f"{self.folder}/{name}", "\n".join([*lines, made.line()]))
            for file in earlier:
                delete(self.spark, f"{self.folder}/{file}")
        else:
            write_text(self.spark, f"{self.folder}/{name}", made.line())
        return made
