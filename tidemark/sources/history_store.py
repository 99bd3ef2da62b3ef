"""The version table on plain Parquet: S4, with run by run commits.

    opened/run=N/bucket=B         versions that run N opened, written once and never again
    closed/run=N/bucket=B         key, load and end of the versions that run N closed
    base/run=N/part=P/bucket=B    all versions after run N (part=active, part=retired);
                                  base/run=N-part holds some buckets only
    commits/run=N                 one row, written last; a run without it does not exist
    bases/run=N                   one row per bucket of a base, written after it
    folded/run=N                  copies of all commits up to run N, so that few files are read
    layout                        number of buckets, fixed by the first run
    staged/run=N, changes/run=N and others: what a run writes on its way, gone once it is committed

A key's rows all lie in the bucket of its hash, so a partial run reads and joins the buckets
of its own keys only, and a repair writes anew only those that it changes. A run writes in
proportion to what it changes; ``compact`` rewrites everything into a new base. Nothing is
overwritten that a committed run reads: a run that failed half way, or is started again,
replaces its own folders only. Commits hold the numbers of rows, so a lost folder is an error
and never an empty table. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import content_checksum
from tidemark.operators.audit import drop_duplicate_versions, duplicate_versions
from tidemark.operators.merge import PARTIAL, plan_changes
from tidemark.operators.replay import continue_history
from tidemark.schema import VERSION_COLUMNS, VERSION_SCHEMA, VersionColumns
from tidemark.session import CODEC, folder_names, remove_folder

BUCKETS = 32
# A stream compacts once this many runs, and this share of the base in rows, lie beside it;
# or more runs, however small.
COMPACT_RUNS, COMPACT_SHARE, COMPACT_RUNS_AT_MOST = 10, 0.5, 50
REPAIR, REWATCH, REPLAY = "repair", "rewatch", "replay"

_COMMIT = ("run long, run_at timestamp_ntz, mode string, watched string, source string, "
           "batch long, opened long, closed long, counts map<string,long>")
_BASE = "run long, folder string, bucket int, active long, retired long"


@dataclass(frozen=True)
class State:
    """What is committed: the runs in order, and per bucket the newest base that holds it."""

    commits: list[Row]
    bases: dict[int, Row]

    @property
    def last(self) -> int:
        return self.commits[-1].run if self.commits else -1

    @property
    def watched(self) -> str | None:
        return self.commits[-1].watched if self.commits else None

    def since(self, bucket: int) -> int:
        """The run whose versions the base of a bucket still holds; -1 without base."""
        return self.bases[bucket].run if bucket in self.bases else -1


class HistoryStore:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = VERSION_SCHEMA,
                 names: VersionColumns = VERSION_COLUMNS, buckets: int = BUCKETS):
        """``buckets`` counts for a new store; about one per task that a whole read should have."""
        self.spark, self.root = spark, root.rstrip("/")
        self.schema, self.names = schema, names
        self._wanted, self._buckets = buckets, None

    # --- state ------------------------------------------------------------------------------

    @property
    def buckets(self) -> int:
        if self._buckets is None:
            if "layout" not in folder_names(self.spark, self.root):
                return self._wanted
            self._buckets = self.spark.read.schema("buckets int").parquet(f"{self.root}/layout").first().buckets
        return self._buckets

    def _marked(self, name: str, folders: Iterable[str], schema: str) -> DataFrame:
        paths = [f"{self.root}/{name}/{folder}" for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _numbered(self, name: str) -> dict[str, int]:
        """Folders of a kind with their run numbers, from one listing."""
        return {folder: int(folder[4:].removesuffix("-part"))
                for folder in folder_names(self.spark, f"{self.root}/{name}") if folder.startswith("run=")}

    def commits(self) -> DataFrame:
        """One row per finished run: number, time, mode, watched fields, source, rows written, and
        what the run counted on its way."""
        folded, single = self._numbered("folded"), self._numbered("commits")
        newest = max(folded.values(), default=None)
        later = [f for f, run in single.items() if newest is None or run > newest]
        every = self._marked("commits", later, _COMMIT)
        return every if newest is None else every.unionByName(self._marked("folded", [f"run={newest}"], _COMMIT))

    def state(self) -> State:
        """All commits (one narrow row each) and the bases in use; hand it on instead of asking twice."""
        commits = sorted(self.commits().collect(), key=lambda row: row.run)
        committed = {row.run for row in commits}
        found = {f: run for f, run in self._numbered("bases").items() if run in committed}
        # A base of some buckets belongs to a run of its own, a whole one of that run comes later.
        order = sorted(found, key=lambda f: (found[f], not f.endswith("-part")))
        whole = max((i for i, f in enumerate(order) if not f.endswith("-part")), default=0)
        rows = self._marked("bases", order[whole:], _BASE).collect()
        rows.sort(key=lambda row: order.index(row.folder))
        return State(commits, {row.bucket: row for row in rows})

    def runs(self) -> list[int]:
        return [row.run for row in self.state().commits]

    def find(self, source: str, batch: int, state: State | None = None) -> int | None:
        """The run that committed this batch of this source, if any."""
        found = [row.run for row in (state or self.state()).commits if (row.source, row.batch) == (source, batch)]
        return found[0] if found else None

    def next_run(self) -> int:
        return self.state().last + 1

    # --- reading ----------------------------------------------------------------------------

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(self.names.key), F.lit(self.buckets)).cast("int")

    def _read(self, folders: dict[str, set[int]], schema: T.StructType) -> DataFrame:
        """Union of folders, of each the named buckets; those not named are pruned at the scan."""
        schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        same: dict[tuple, list[str]] = {}
        for folder, buckets in folders.items():
            if buckets:
                kind = f"{self.root}/{folder.partition('/')[0]}"
                same.setdefault((kind, frozenset(buckets)), []).append(f"{self.root}/{folder}")
        found = None
        for (kind, buckets), paths in same.items():
            part = self.spark.read.schema(schema).option("basePath", kind).parquet(*paths).select(*schema.fieldNames())
            if len(buckets) < self.buckets:
                part = part.where(F.col("bucket").isin(sorted(buckets)))
            found = part if found is None else found.unionByName(part)
        # Spark knows that no row passes, so what meets this is not shuffled for it.
        return self.spark.createDataFrame([], schema).where(F.lit(False)) if found is None else found

    def _closing_schema(self) -> T.StructType:
        names = self.names
        return T.StructType([self.schema[c] for c in (names.key, names.load, names.valid_to)])

    def _parts(self, state: State, only: set[int] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Versions that were open in the base or opened since, closings since, base's retired."""
        every = set(range(self.buckets)) if only is None else only
        opened: dict[str, set[int]] = {}
        closed: dict[str, set[int]] = {}
        retired: dict[str, set[int]] = {}
        for row in state.bases.values():
            if row.bucket in every:
                for part, n, into in (("active", row.active, opened), ("retired", row.retired, retired)):
                    if n:
                        into.setdefault(f"base/{row.folder}/part={part}", set()).add(row.bucket)
        for row in state.commits:
            later = {b for b in every if row.run > state.since(b)}
            if row.opened:
                opened[f"opened/run={row.run}"] = later
            if row.closed:
                closed[f"closed/run={row.run}"] = later
        return self._read(opened, self.schema), self._read(closed, self._closing_schema()), self._read(retired, self.schema)

    def _active(self, state: State, only: set[int] | None = None) -> DataFrame:
        opened, closed, _ = self._parts(state, only)
        return opened.join(closed, [self.names.key, self.names.load], "left_anti").select(
            *self.schema.fieldNames())

    def _retired(self, state: State, only: set[int] | None = None) -> DataFrame:
        opened, closed, retired = self._parts(state, only)
        names = self.names
        ended = opened.drop(names.valid_to).join(closed.drop("bucket"), [names.key, names.load])
        return ended.select(*self.schema.fieldNames()).unionByName(retired.select(*self.schema.fieldNames()))

    def active(self) -> DataFrame:
        """H5: base and later openings without what was closed since."""
        return self._active(self.state())

    def retired(self) -> DataFrame:
        return self._retired(self.state())

    def versions(self) -> DataFrame:
        return self._versions(self.state())

    def _versions(self, state: State, only: set[int] | None = None) -> DataFrame:
        return self._active(state, only).unionByName(self._retired(state, only))

    # --- writing ----------------------------------------------------------------------------

    def work_path(self, name: str, run: int) -> str:
        """Folder for what a run writes on its way or reports; replaced when the run is repeated."""
        return f"{self.root}/{name}/run={run}"

    def materialise(self, frame: DataFrame, name: str, run: int) -> DataFrame:
        """Writes an intermediate table and reads it back: computed once, of known size."""
        path = self.work_path(name, run)
        frame.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def clear(self, run: int, *names: str) -> None:
        """Removes what a committed run wrote on its way and nobody reads again."""
        for name in names:
            remove_folder(self.spark, self.work_path(name, run))

    def _bucketed(self, frame: DataFrame, folder: str, *within: str) -> DataFrame:
        """Writes rows below their buckets, sorted by key; large buckets are dealt to several tasks."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        share = F.pmod(F.hash(self.names.key), F.lit(max(1, tasks // self.buckets)))
        path, into = f"{self.root}/{folder}", [*within, "bucket"]
        rows = frame.withColumn("bucket", self.bucket_of())
        (rows.repartition(*into, share).sortWithinPartitions(*into, self.names.key)
         .write.mode("overwrite").option("compression", CODEC).partitionBy(*into).parquet(path))
        return self.spark.read.schema(rows.schema).parquet(path)

    def _mark(self, name: str, folder: str, rows: list, schema: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/{name}/{folder}")

    def _begin(self, run: int, state: State) -> bool:
        """False if the run is committed already; fixes the layout with the first run."""
        if any(row.run == run for row in state.commits):
            return False
        if state.commits and run < state.last:
            raise ValueError(f"run {run} is older than committed run {state.last}")
        if not state.commits:
            self.spark.createDataFrame([(self._wanted,)], "buckets int").coalesce(1).write.mode(
                "overwrite").parquet(f"{self.root}/layout")
            self._buckets = self._wanted
        return True

    def _record(self) -> list[str]:
        names = self.names
        return [c for c in self.schema.fieldNames() if c not in (names.valid_from, names.valid_to, names.load)]

    def merge(self, snapshot: DataFrame, run: int, run_at: datetime, *, mode: str,
              merge_key: Sequence[str] | None = None, watched: Sequence[str] = (),
              staged: bool = False, source: str | None = None, batch: int | None = None,
              new_watched: bool = False, state: State | None = None,
              counts: dict[str, int] | None = None) -> bool:
        """One run: merges ``snapshot`` and commits. False if the run is committed already.

        ``staged`` says that the snapshot is a cheap read of stored rows already. A partial run
        by key reads only the buckets of its keys. Watching other fields than the last run
        would reopen every version, so it fails unless ``new_watched`` says that this is meant;
        ``rewatch`` changes the fields without reopening anything. ``counts`` are kept with the
        commit as they are.
        """
        state = state or self.state()
        if not self._begin(run, state):
            return False
        fields = ",".join(sorted(watched))
        if state.commits and fields != state.watched and not new_watched:
            raise ValueError(f"run {run} watches other fields than run {state.last}")
        names = self.names
        taken = snapshot.select(*self._record())
        if not staged:
            taken = self.materialise(taken, "staged", run)
        only = None
        if mode == PARTIAL and set(merge_key or [names.key]) == {names.key}:
            only = {row.bucket for row in taken.select(self.bucket_of().alias("bucket")).distinct().collect()}
        active = self._active(state, only)
        changes = self.materialise(
            plan_changes(active, taken, mode=mode, merge_key=merge_key, names=names), "changes", run)
        at = F.lit(run_at.isoformat()).cast("timestamp_ntz")
        opening = changes.filter("opens").select(names.key)
        opened = self._bucketed(taken.join(opening, names.key, "left_semi").withColumns({
            names.valid_from: at, names.load: F.lit(run).cast("long"),
            names.valid_to: F.lit(None).cast(self.schema[names.valid_to].dataType),
        }).select(*self.schema.fieldNames()), f"opened/run={run}")
        closing = changes.filter("closes").select(names.key)
        closed = self._bucketed(
            active.select(names.key, names.load).join(closing, names.key, "left_semi")
            .withColumn(names.valid_to, at).select(*self._closing_schema().fieldNames()), f"closed/run={run}")
        self._commit(run, run_at, mode, fields, source, batch, opened.count(), closed.count(), counts)
        self.clear(run, "changes", *() if staged else ("staged",))
        return True

    def _commit(self, run: int, *values) -> None:
        self._mark("commits", f"run={run}", [(run, *values)], _COMMIT)

    def replay(self, observations: DataFrame, runs: Sequence[tuple[int, datetime]], *,
               run: str = "run", watched: Sequence[str] = ()) -> bool:
        """H3 into the store: many complete snapshots in one job and one commit.

        ``observations`` holds one row per key and run number in ``run``; ``runs`` lists
        every run with its time, also those whose snapshot is empty. The result is that of
        merging the snapshots run by run: active versions count as sighted just before the
        first of the runs, so what the first snapshot shows unchanged goes on. Histories are
        planned on key and checksum; records are read once more for the versions that open.
        False if the last of the runs is committed already.
        """
        calendar = sorted(runs)
        last, last_at = calendar[-1]
        state = self.state()
        if not self._begin(last, state):
            return False
        if state.commits and calendar[0][0] <= state.last:
            raise ValueError(f"run {calendar[0][0]} is not after committed run {state.last}")
        fields = ",".join(sorted(watched))
        if state.commits and fields != state.watched:
            raise ValueError(f"run {last} watches other fields than run {state.last}")
        names = self.names
        seen = self.materialise(observations.select(F.col(run).cast("long").alias("_run"), *self._record()), "staged", last)
        active = self._active(state)
        found = self.materialise(continue_history(
            active.select(names.key, names.checksum, names.load), seen.select(names.key, names.checksum, "_run"),
            self.spark.createDataFrame(calendar, "_run long, _at timestamp_ntz"), names), "changes", last)
        starts = found.where("_starts").select(names.key, F.col(names.load).alias("_run"), names.valid_from)
        opened = self._bucketed(seen.join(starts, [names.key, "_run"]).withColumns({
            names.load: F.col("_run"), names.valid_to: F.lit(None).cast(self.schema[names.valid_to].dataType),
        }).select(*self.schema.fieldNames()), f"opened/run={last}")
        closed = self._bucketed(found.where(F.col(names.valid_to).isNotNull()).select(
            *self._closing_schema().fieldNames()), f"closed/run={last}")
        self._commit(last, last_at, REPLAY, fields, None, None, opened.count(), closed.count(), None)
        self.clear(last, "changes", "staged")
        return True

    def _rebase(self, run: int, folder: str, versions: DataFrame, buckets: set[int]) -> None:
        """The plain rewrite job: all versions of some buckets into one place."""
        part = F.when(F.col(self.names.valid_to).isNull(), "active").otherwise("retired")
        written = {(row.bucket, row.part): row["count"] for row in self._bucketed(
            versions.withColumn("part", part), f"base/{folder}", "part").groupBy("bucket", "part").count().collect()}
        self._mark("bases", folder, [(run, folder, b, written.get((b, "active"), 0), written.get((b, "retired"), 0))
                                     for b in sorted(buckets)], _BASE)

    def compact(self) -> int | None:
        """Writes a new base after the newest run, by bucket and key; returns its run.

        Readers that began on the old base still find it: ``superseded`` names the folders
        that new readers no longer need.
        """
        state = self.state()
        if not state.commits:
            return None
        run = state.last
        if not any(row.folder != f"run={run}" for row in state.bases.values()) and len(state.bases) == self.buckets:
            return run
        self._rebase(run, f"run={run}", self._versions(state), set(range(self.buckets)))
        self._mark("folded", f"run={run}", state.commits, _COMMIT)
        return run

    def compaction_due(self, state: State | None = None) -> bool:
        """Whether what lies beside the bases has come to the stated share of them."""
        state = state or self.state()
        since = min((state.since(b) for b in range(self.buckets)), default=-1)
        later = [row for row in state.commits if row.run > since]
        beside = sum(row.opened + row.closed for row in later)
        held = sum(row.active + row.retired for row in state.bases.values())
        return (len(later) >= COMPACT_RUNS and beside >= COMPACT_SHARE * held) or len(later) >= COMPACT_RUNS_AT_MOST

    def drop_duplicates(self, run: int, run_at: datetime) -> set[int]:
        """H11 in the store: of versions with equal key and content the newest load stays.

        Groups are counted on narrow columns; only the buckets that hold one are read whole
        and written anew. A run of its own: returns those buckets, and commits nothing if
        there are none, so a repeat is harmless.
        """
        state = self.state()
        if not self._begin(run, state):
            return set()
        names = self.names
        narrow = [names.key, names.checksum, names.load]
        several = duplicate_versions(self._versions(state).select(*narrow), names).select(self.bucket_of().alias("bucket"))
        buckets = {row.bucket for row in several.distinct().collect()}
        if buckets:
            held = self.materialise(self._versions(state, buckets), "held", run)
            self._rebase(run, f"run={run}-part", drop_duplicate_versions(held, names), buckets)
            self._commit(run, run_at, REPAIR, state.watched, None, None, 0, 0, None)
            self.clear(run, "held")
        return buckets

    def rewatch(self, run: int, run_at: datetime, watched: Sequence[str],
                checksum: Callable[[Sequence[str]], Column] = content_checksum) -> bool:
        """I3 under another list of watched fields: active versions get its checksums, none reopens.

        A field that the store's schema has newly gained is null in all versions so far, so the
        next run opens versions only for the keys that show a value in it. Retired versions
        keep the checksums they were compared by. A run of its own that rewrites the store.
        """
        state = self.state()
        if not self._begin(run, state):
            return False
        active = self._active(state).withColumn(self.names.checksum, checksum(sorted(watched)))
        self._rebase(run, f"run={run}", active.unionByName(self._retired(state)), set(range(self.buckets)))
        self._commit(run, run_at, REWATCH, ",".join(sorted(watched)), None, None, 0, 0, None)
        return True

    def superseded(self) -> list[str]:
        """Folders of openings, closings and bases that newer bases have taken in, and folded commits."""
        state = self.state()
        if not state.bases:
            return []
        since = min(state.since(b) for b in range(self.buckets))
        old = [f"{self.root}/{name}/run={row.run}" for row in state.commits if row.run <= since
               for name, n in (("opened", row.opened), ("closed", row.closed)) if n]
        used = {row.folder for row in state.bases.values()}
        bases = [f"{self.root}/{name}/{f}" for f in sorted(self._numbered("bases")) if f not in used
                 and self._numbered("bases")[f] <= state.last for name in ("base", "bases")]
        folded = self._numbered("folded")
        newest = max(folded.values(), default=-1)
        return old + bases + [f"{self.root}/{name}/{f}" for name, top in (("commits", newest), ("folded", newest - 1))
                              for f, run in self._numbered(name).items() if run <= top]
