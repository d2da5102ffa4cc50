"""Panels stored as commits under a manifest: atomic appends, watermarks as state, pruned reads, compaction.

Layout below the table's folder: ``data/commit=<id>/event_date=<day>/part-….parquet``, ``marks/<id>`` with
the last time of each series, and ``_versions`` with the manifest. A commit's files are staged in a folder
of their own and become visible with the manifest that names it; a crash before leaves a folder nobody
reads. A reader is pinned to the version it asked for, whatever is appended or compacted meanwhile, until
``vacuum`` removes versions it was told not to keep.

Checks run inside the write: counts of nulls, NaNs and repeated keys are observed while the files are
staged, and a failed check publishes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.functions.timegrid import ntz
from gridpulse.operators.quality import QualityError, schema_matches
from gridpulse.sources.manifest import Manifest
from gridpulse.sources.tables import DATE
from gridpulse.spec import SeriesSpec

COMMIT = "commit"


@dataclass(frozen=True)
class Commit:
    """One visible folder: its rows and the times they span (ISO, no zone)."""

    id: str
    rows: int
    first: str | None
    last: str | None


@dataclass(frozen=True)
class Snapshot:
    """What one version holds. ``sources`` has the last batch taken from each source."""

    version: int = 0
    commits: tuple[Commit, ...] = ()
    marks: str | None = None
    sources: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(c.rows for c in self.commits)


class VersionedTable:
    """A growing panel of ``schema`` with the key of ``spec``, in the folder ``path``.

    ``spread`` is the number of tasks, and so of files, that one date of a commit is dealt over, by series.
    """

    def __init__(
        self, spark: SparkSession, path: str, spec: SeriesSpec, schema: T.StructType | None = None, spread: int = 1
    ):
        self.spark, self.spec, self.path, self.spread = spark, spec, path.rstrip("/"), spread
        self.schema = schema or spec.series_schema
        self.manifest = Manifest(spark, path)

    # --- reading ---

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The given or the newest version; an empty one if nothing was published yet."""
        version = self.manifest.latest() if version is None else version
        if not version:
            return Snapshot()
        content = self.manifest.read(version)
        commits = tuple(Commit(**c) for c in content["commits"])
        return Snapshot(version, commits, content["marks"], content["sources"])

    def read(
        self,
        snapshot: Snapshot | None = None,
        since: datetime | Column | None = None,
        until: datetime | Column | None = None,
    ) -> DataFrame:
        """Rows of a version. Bounds on the time prune date folders; literal ones prune whole commits too."""
        snapshot = snapshot or self.snapshot()
        commits = [c for c in snapshot.commits if c.rows]
        if isinstance(since, datetime):
            commits = [c for c in commits if c.last >= since.isoformat()]
        if isinstance(until, datetime):
            commits = [c for c in commits if c.first <= until.isoformat()]
        if not commits:
            return self.spark.createDataFrame([], self.schema)
        fields = [*self.schema.fields, T.StructField(COMMIT, T.StringType()), T.StructField(DATE, T.DateType())]
        folders = [f"{self.path}/data/{COMMIT}={c.id}" for c in commits]
        rows = self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.path}/data").parquet(*folders)
        ts = F.col(self.spec.time_col)
        for bound, holds in ((since, Column.__ge__), (until, Column.__le__)):
            if bound is not None:
                edge = ntz(bound) if isinstance(bound, datetime) else bound
                rows = rows.where(holds(F.col(DATE), F.to_date(edge)) & holds(ts, edge))
        return rows.select(*self.schema.fieldNames())

    def marks(self, snapshot: Snapshot | None = None) -> DataFrame:
        """(series, ``_first``, ``_last``): the stored range of each series, without reading its rows."""
        snapshot = snapshot or self.snapshot()
        times = [T.StructField(c, T.TimestampNTZType()) for c in ("_first", "_last")]
        schema = T.StructType([self.schema[self.spec.series_col], *times])
        if snapshot.marks is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/marks/{snapshot.marks}")

    def watermarks(self, snapshot: Snapshot | None = None) -> DataFrame:
        """(series, ``_watermark``), as :func:`gridpulse.operators.upsert.high_watermarks` has it."""
        return self.marks(snapshot).select(self.spec.series_col, F.col("_last").alias("_watermark"))

    def trailing_start(self, snapshot: Snapshot | None = None, lookback: timedelta | None = None) -> datetime | None:
        """The earliest time of any series' trailing look-back; None without rows."""
        oldest = self.marks(snapshot).agg(F.min("_last")).first()[0]
        return oldest and oldest - (self.spec.lookback if lookback is None else lookback)

    # --- writing ---

    def append(
        self,
        df: DataFrame,
        source: tuple[str, int] | None = None,
        base: Snapshot | None = None,
        allow_nan: bool = True,
    ) -> Snapshot:
        """Add rows in one commit after ``base`` (the newest version), and check them while they are written.

        ``source`` names where a batch comes from and its number: a batch that is not newer than the
        last one taken from there changes nothing. Raises ``QualityError`` on a schema change, a null or
        a repeated key, ``ConflictError`` if another writer was first; then nothing is visible.
        """
        base = base or self.snapshot()
        if source and base.sources.get(source[0], -1) >= source[1]:
            return base
        if not schema_matches(df, self.schema):
            raise QualityError(f"schema differs from the stored table: {df.schema.simpleString()}")
        name = uuid.uuid4().hex
        try:
            seen = self._stage(df, name)
            self._judge(seen, allow_nan)
            commit = Commit(name, seen["rows"], *(seen[c] and seen[c].isoformat() for c in ("first", "last")))
            commits, marks = base.commits, base.marks
            if not commit.rows:
                self.manifest.remove(f"data/{COMMIT}={name}")
                if not source:
                    return base
            else:
                commits = (*commits, commit)
                marks = self._write_marks(base, name)
            sources = {**base.sources, **({source[0]: source[1]} if source else {})}
            return self._publish(base, commits, marks, sources)
        except BaseException:
            # Only this writer knows the names; a crash leaves them to vacuum.
            self.manifest.remove(f"data/{COMMIT}={name}")
            self.manifest.remove(f"marks/{name}")
            raise

    def _stage(self, df: DataFrame, name: str) -> dict[str, Any]:
        """Write the rows of a commit by date, sorted by key, and return what was observed."""
        spec, key = self.spec, [F.col(c) for c in self.spec.key]
        others = [c for c in df.columns if c not in spec.key]
        # One exchange and one sort serve the files and the search for repeated keys.
        # A series' rows of a date stay together.
        dealt = F.pmod(F.xxhash64(spec.series_col), F.lit(self.spread))
        before = Window.partitionBy(DATE, "_deal").orderBy(*key)
        previous = F.lag(F.struct(*key)).over(before)
        same = previous.isNotNull() & previous.eqNullSafe(F.struct(*key))
        dated = df.withColumns({DATE: F.to_date(spec.time_col), "_deal": dealt}).repartition(DATE, "_deal")
        observed = Observation(f"commit-{name}")
        checked = dated.withColumn("_again", same).observe(
            observed,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in df.columns],
            *[F.count_if(F.isnan(c)).alias(f"nan {c}") for c in others if df.schema[c].dataType == T.DoubleType()],
            F.count_if("_again").alias("repeated keys"),
            F.min(spec.time_col).alias("first"),
            F.max(spec.time_col).alias("last"),
        )
        checked.drop("_again", "_deal").write.partitionBy(DATE).parquet(f"{self.path}/data/{COMMIT}={name}")
        return observed.get

    @staticmethod
    def _judge(seen: dict[str, Any], allow_nan: bool) -> None:
        bad = {
            what: n
            for what, n in seen.items()
            if n and (what.startswith("null ") or what == "repeated keys" or (what.startswith("nan ") and not allow_nan))
        }
        if bad:
            raise QualityError(f"rows that must not be stored: {bad}")

    def _write_marks(self, base: Snapshot, name: str) -> str:
        """Ranges after a commit, from the marks before and the commit's own rows."""
        series, time = self.spec.key
        fields = [*self.schema.fields, T.StructField(DATE, T.DateType())]
        own = self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/data/{COMMIT}={name}")
        both = self.marks(base).unionByName(own.select(series, F.col(time).alias("_first"), F.col(time).alias("_last")))
        ranges = both.groupBy(series).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
        ranges.write.parquet(f"{self.path}/marks/{name}")
        return name

    def _publish(self, base: Snapshot, commits: tuple[Commit, ...], marks: str | None, sources: dict[str, int]) -> Snapshot:
        content = {"commits": [asdict(c) for c in commits], "marks": marks, "sources": sources}
        self.manifest.publish(base.version, content)
        return Snapshot(base.version + 1, commits, marks, sources)

    # --- upkeep ---

    def compact(self, most: int = 1, small: int = 1_000_000) -> Snapshot:
        """Rewrite commits of less than ``small`` rows as one, if there are more than ``most`` of them.

        Each date then has one file of them. Readers of earlier versions go on reading the old files.
        """
        base = self.snapshot()
        few = [c for c in base.commits if c.rows < small]
        if len(few) <= most:
            return base
        name = uuid.uuid4().hex
        try:
            seen = self._stage(self.read(Snapshot(base.version, tuple(few))), name)
            if seen["rows"] != sum(c.rows for c in few):
                raise RuntimeError(f"compaction read {seen['rows']} rows of {sum(c.rows for c in few)}")
            merged = Commit(name, seen["rows"], min(c.first for c in few), max(c.last for c in few))
            kept = tuple(c for c in base.commits if c not in few)
            return self._publish(base, (*kept, merged), base.marks, base.sources)
        except BaseException:
            self.manifest.remove(f"data/{COMMIT}={name}")
            raise

    def vacuum(self, keep: int = 1) -> None:
        """Remove versions but the newest ``keep``, and files that none of those names.

        Not to be run beside a writer: a commit that is being staged is not named by any version yet.
        """
        self.manifest.forget(keep)
        kept = [self.snapshot(v) for v in self.manifest.versions()]
        named = {f"{COMMIT}={c.id}" for s in kept for c in s.commits}
        for folder in set(self.manifest.children("data")) - named:
            self.manifest.remove(f"data/{folder}")
        for folder in set(self.manifest.children("marks")) - {s.marks for s in kept}:
            self.manifest.remove(f"marks/{folder}")


def append_batches(
    table: VersionedTable,
    query: str,
    fresh: Callable[[DataFrame, DataFrame], DataFrame],
) -> Callable[[DataFrame, int], None]:
    """Body for ``foreachBatch``: each batch is one commit, and a batch that comes again changes nothing.

    ``fresh`` gets a batch and the watermarks of its series and returns the rows to add. The stored rows
    are not read, so a batch costs what it holds and one row a series.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        base = table.snapshot()
        if base.sources.get(query, -1) < batch_id:
            table.append(fresh(batch, table.watermarks(base)), (query, batch_id), base)

    return body
