"""Tables that change as a whole: data under new names, then one list that names them.

Each write gets a folder of its own, ``<root>/<table>/write=<id>``. A snapshot is a list of
the folders that make up all tables; publishing writes that list as the next version, in one
small file. Readers resolve the last version, so they see all of a run or nothing of it, and
a run that is killed half-way leaves the former tables whole. What no kept version names is
removed by age.

One writer publishes at a time. A second one that built on the same version is found out when
it publishes, and refused.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LISTS = "_snapshots"
LISTED = "table string, part string, write string, note string, published timestamp"


class PublishConflict(RuntimeError):
    """Another writer has published the version this one was about to."""


class Snapshot(NamedTuple):
    """``parts`` maps (table, part) to the folder of the write that holds it, ``schemas`` tables
    to their columns as JSON, for those whose folders may hold no file."""
    version: int
    parts: dict[tuple[str, str], str]
    note: str
    schemas: dict[str, str]


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def folder(self, table: str, write: str) -> str:
        return f"{self.root}/{table}/write={write}"

    def new_folder(self, table: str) -> tuple[str, str]:
        """A write id and its folder, for data that are not published yet."""
        write = uuid.uuid4().hex
        return write, self.folder(table, write)

    def _lists(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(f"{LISTED}, version long, writer string").json(
                f"{self.root}/{LISTS}"
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def current(self, version: int | None = None) -> Snapshot:
        """The last published version, or a kept earlier one; version 0 is empty."""
        lists = self._lists()
        if lists is not None:
            if version is not None:
                lists = lists.where(F.col("version") == version)
            last = (
                lists.groupBy("version", "writer")
                .agg(F.collect_list(F.struct("table", "part", "write", "note")).alias("rows"))
                .orderBy(F.desc("version"), "writer").first()
            )
            if last:
                parts = {(r.table, r.part): r.write for r in last.rows if r.write is not None}
                note = next((r.note for r in last.rows if r.table is None), "")
                schemas = {r.table: r.note for r in last.rows if r.table is not None and r.write is None}
                return Snapshot(last.version, parts, note or "", schemas)
        if version:
            raise LookupError(f"no version {version} under {self.root}")
        return Snapshot(0, {}, "", {})

    def publish(
        self, base: Snapshot, put: dict[tuple[str, str], str],
        drop: Iterable[tuple[str, str]] = (), note: str | None = None,
        schemas: dict[str, str] | None = None,
    ) -> Snapshot:
        """The next version: ``base`` with the parts of ``put`` and without those of ``drop``."""
        gone = set(drop)
        parts = {**{k: w for k, w in base.parts.items() if k not in gone}, **put}
        note = base.note if note is None else note
        schemas = {**base.schemas, **(schemas or {})}
        made = Snapshot(base.version + 1, parts, note, schemas)
        if self.current().version != base.version:
            raise PublishConflict(f"version {made.version} is there already")
        writer, now = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc)
        rows = [(t, p, w, None, now) for (t, p), w in sorted(parts.items())]
        rows += [(t, None, None, s, now) for t, s in sorted(schemas.items())]
        self.spark.createDataFrame([*rows, (None, None, None, note, now)], LISTED).coalesce(1).write.json(
            f"{self.root}/{LISTS}/version={made.version}/writer={writer}"
        )
        writers = self._lists().where(F.col("version") == made.version).agg(F.min("writer")).first()
        if writers[0] != writer:
            raise PublishConflict(f"version {made.version} is there already")
        return made

    def read(self, table: str, snapshot: Snapshot | None = None) -> DataFrame:
        """All parts of a table, with the columns of their folders below the write."""
        snapshot = snapshot or self.current()
        paths = [self.folder(t, w) for (t, _), w in sorted(snapshot.parts.items()) if t == table]
        if not paths:
            raise LookupError(f"no table {table} is published under {self.root}")
        reader = self.spark.read.option("basePath", f"{self.root}/{table}")
        if table in snapshot.schemas:
            schema = T.StructType.fromJson(json.loads(snapshot.schemas[table]))
            return reader.schema(schema).parquet(*paths)
        return reader.parquet(*paths).drop("write")

    def expire(self, keep: int = 1, older_than: dt.timedelta = dt.timedelta(days=7)) -> int:
        """Removes all but the last ``keep`` lists, and the folders no kept list names, once they
        are older than ``older_than``; give running writers and readers that long. Returns how
        many folders went."""
        lists = self._lists()
        if lists is None:
            return 0
        kept = [r.version for r in lists.select("version").distinct().orderBy(F.desc("version")).limit(keep).collect()]
        named = {
            self.folder(r.table, r.write)
            for r in lists.where(F.col("version").isin(kept) & F.col("table").isNotNull())
            .select("table", "write").distinct().collect()
        }
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        files = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        limit = (dt.datetime.now() - older_than).timestamp() * 1000
        tails = {name.removeprefix(self.root) for name in named}
        removed = 0
        for pattern in ("*/write=*", f"{LISTS}/version=*"):
            for found in files.globStatus(path(f"{self.root}/{pattern}")) or []:
                text = found.getPath().toString()
                used = (
                    int(text.rpartition("=")[2]) in kept if LISTS in pattern
                    else any(text.endswith(tail) for tail in tails)
                )
                if not used and found.getModificationTime() <= limit:
                    files.delete(found.getPath(), True)
                    removed += 1
        return removed
