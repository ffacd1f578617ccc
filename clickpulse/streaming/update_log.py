"""The table of a stream in update mode, as a log of changed rows that is merged as it grows.

Each micro-batch writes the rows it changed to ``<path>/batch_id=<n>``, overwritten if the batch
runs again. The table is the newest row of each key. Read on its own, the log
grows with every batch ever written; so batches are merged in levels: ``fanout`` neighbouring segments of a level
become one of the next, which holds the newest row of each key in it. A log of n batches is then
read from at most (fanout - 1) * log_fanout(n) + fanout segments.

What has been merged is said by the manifest: one row per segment, in a folder for each version, of
which the newest counts. A version is one file, so it is there or it is not. The order is

1. write the merged segment to a folder that nobody knows yet;
2. write the next version of the manifest, which names it in place of its parts;
3. delete the parts of the version before, which no reader of this version opens.

A crash after 1 leaves a folder that no version names, after 2 parts that nobody reads; the
next merge removes both. Readers see each batch once at any time. Only batches before the one being written are
merged: a batch that runs again is never in a segment.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.session import delete_path, list_folder

BATCH_ID = "batch_id"
#: Names that begin with an underscore are not seen by readers of the whole folder.
SEGMENTS, MANIFEST = "_segments", "_manifest"
_WRITTEN = "_written"
FANOUT = 4


@dataclass(frozen=True)
class Segment:
    """Batches ``first`` to ``last``, merged in the folder ``name``."""

    first: int
    last: int
    level: int
    name: str


def latest_per_key(updates: DataFrame, keys: Sequence[str], columns: Sequence[str], by: str = BATCH_ID) -> DataFrame:
    """Newest version of each row in an update log (highest ``by`` per key)."""
    values = [c for c in columns if c not in keys]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(by)).alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values]).select(*columns)


class UpdateLog:
    """The log at ``path`` of rows of ``schema``, each named by ``keys`` (none: the table is one row)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], fanout: int = FANOUT):
        self.spark, self.path, self.keys, self.fanout = spark, path.rstrip("/"), list(keys), fanout
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        self.columns = self.schema.names

    # -- writing

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The changed rows of a micro-batch; merges what was there before it."""
        rows = batch.select(*self.columns)
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH_ID}={batch_id}")
        self.merge(batch_id)

    def merge(self, before: int) -> None:
        """Merge segments and batches before batch ``before`` until no level holds ``fanout`` of them."""
        version, segments = self.manifest()
        done = max((s.last for s in segments), default=-1)
        fresh = [Segment(b, b, 0, "") for b in self._batches() if done < b < before]
        # What is due is planned first, so that a merge that makes the next one due is written once.
        plan = [(s, [s]) for s in [*segments, *fresh]]
        while (at := self._due([s.level for s, _ in plan])) is not None:
            run = plan[at : at + self.fanout]
            merged = Segment(run[0][0].first, run[-1][0].last, run[0][0].level + 1, uuid.uuid4().hex)
            plan[at : at + self.fanout] = [(merged, [part for _, parts in run for part in parts])]
        new = [(s, parts) for s, parts in plan if s.name and parts != [s]]
        if not new:
            return
        for segment, parts in new:
            self._write_segment(parts, segment)
        named = [s for s, _ in plan if s.name]  # later batches are found in their folders
        self._write_manifest(version + 1, named)
        self._sweep(version + 1, named)

    def _due(self, levels: list[int]) -> int | None:
        """Where the first ``fanout`` neighbours of one level begin."""
        for i in range(len(levels) - self.fanout + 1):
            if len(set(levels[i : i + self.fanout])) == 1:
                return i
        return None

    def _write_segment(self, parts: list[Segment], into: Segment) -> None:
        rows = self._updates(parts)
        values = [c for c in [*self.columns, _WRITTEN] if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), F.col(_WRITTEN)).alias("_v"))
        if not self.keys:  # a table of one row has one also where nothing was written
            newest = newest.where("_v IS NOT NULL")
        newest.select(*self.keys, "_v.*").write.parquet(f"{self.path}/{SEGMENTS}/{into.name}")

    def _write_manifest(self, version: int, segments: list[Segment]) -> None:
        rows = [(s.first, s.last, s.level, s.name) for s in segments]
        table = self.spark.createDataFrame(rows, "first long, last long, level int, name string")
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{MANIFEST}/version={version}")

    def _sweep(self, version: int, segments: list[Segment]) -> None:
        """Remove what the version before ``version`` and this one do not name."""
        keep = {s.name for s in segments} | {s.name for s in self._version(version - 1)}
        for name in list_folder(self.spark, f"{self.path}/{SEGMENTS}"):
            if name not in keep:
                delete_path(self.spark, f"{self.path}/{SEGMENTS}/{name}")
        merged = max((s.last for s in self._version(version - 1)), default=-1)
        for b in self._batches():
            if b <= merged:
                delete_path(self.spark, f"{self.path}/{BATCH_ID}={b}")
        for v in self._versions():
            if v < version - 1:
                delete_path(self.spark, f"{self.path}/{MANIFEST}/version={v}")

    # -- reading

    def _numbers(self, folder: str, name: str) -> list[int]:
        found = [n.partition("=") for n in list_folder(self.spark, folder)]
        return sorted(int(value) for key, _, value in found if key == name and value.isdigit())

    def _batches(self) -> list[int]:
        return self._numbers(self.path, BATCH_ID)

    def _versions(self) -> list[int]:
        # A version counts once its file is there; until then its folder is empty or holds hidden names.
        folder = f"{self.path}/{MANIFEST}"
        return [
            v
            for v in self._numbers(folder, "version")
            if any(n.startswith("part-") for n in list_folder(self.spark, f"{folder}/version={v}"))
        ]

    def _version(self, version: int) -> list[Segment]:
        if version not in self._versions():
            return []
        table = self.spark.read.schema("first long, last long, level int, name string")
        rows = table.parquet(f"{self.path}/{MANIFEST}/version={version}").collect()
        return sorted((Segment(*r) for r in rows), key=lambda s: s.first)

    def manifest(self) -> tuple[int, list[Segment]]:
        """The newest version and its segments, first batches first."""
        version = max(self._versions(), default=0)
        return version, self._version(version)

    def _updates(self, parts: Sequence[Segment]) -> DataFrame:
        """The rows of these segments and batches with the number of the batch that wrote them."""
        out = self.spark.createDataFrame([], self.schema).withColumn(_WRITTEN, F.lit(0).cast("bigint"))
        names = [s.name for s in parts if s.name]
        if names:
            kept = T.StructType([*self.schema.fields, T.StructField(_WRITTEN, T.LongType())])
            out = self.spark.read.schema(kept).parquet(*[f"{self.path}/{SEGMENTS}/{n}" for n in names])
        batches = [s.first for s in parts if not s.name]
        if batches:
            reader = self.spark.read.schema(self.schema).option("basePath", self.path)
            read = reader.parquet(*[f"{self.path}/{BATCH_ID}={b}" for b in batches])
            rows = read.select(*self.columns, F.col(BATCH_ID).cast("bigint").alias(_WRITTEN))
            out = out.unionByName(rows) if names else rows
        return out

    def parts(self, upto: int | None = None) -> list[Segment]:
        """The segments and batches that make up the table, as of batch ``upto``."""
        _, segments = self.manifest()
        done = max((s.last for s in segments), default=-1)
        batches = [b for b in self._batches() if b > done and (upto is None or b <= upto)]
        return [*segments, *[Segment(b, b, 0, "") for b in batches]]

    def read(self, upto: int | None = None, where: Column | None = None) -> DataFrame:
        """The newest row of each key; empty if no batch has written one. Any other read error is raised.

        ``upto`` leaves out later batches (which are never merged while it is being written);
        ``where`` is a condition on the keys and reaches the scan.
        """
        for attempt in range(3):
            try:
                rows = self._updates(self.parts(upto))
                break
            except AnalysisException as e:
                # A merge between the manifest and the listing: look again.
                if e.getCondition() != "PATH_NOT_FOUND" or attempt == 2:
                    raise
        if where is not None:
            rows = rows.where(where)
        if self.keys:
            return latest_per_key(rows, self.keys, self.columns, _WRITTEN)
        newest = rows.agg(F.max_by(F.struct(*self.columns), _WRITTEN).alias("_v")).where("_v IS NOT NULL")
        return newest.select("_v.*")
