"""Tables as partitioned Parquet under one root folder.

Every write makes new folders, `<partition>/v=<version>`; nothing that readers see is overwritten. Which versions are the table stands
in the manifest, and a commit moves all tables of a transaction on by one rename: readers see the state before or the
state after, whatever step a writer was lost at. Versions that were replaced are deleted some commits later. One writer at
a time, by a lease; a writer that lost its lease can't commit.

Results that several steps need are written to staging tables in the shared folder, which a repeated run reuses.
"""

from __future__ import annotations

import copy
import hashlib
import re
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import keep_latest
from lamina.schemas import TABLES, TableSpec
from lamina.session import shared_folder
from lamina.sources.manifest import Change, Files, Head, Lease, Live, Manifest

# A partition, or all partitions below a prefix: values of the first partition columns.
Scope = tuple
# Name of the folder level below the partitions.
VERSION = "v"
_BUCKETS = "_user_buckets-"
_PLAIN = re.compile(r"[\w. -]+")


class Store:
    """`user_buckets` is how many partitions the user dimension has. It is settled when the first
    Store is opened on `root`; choose it so that a bucket of users fits a task, some
    hundred thousand each."""

    def __init__(self, spark: SparkSession, root: str, user_buckets: int | None = None, lease_seconds: float = 120.0):
        self.spark = spark
        self.root = root.rstrip("/")
        self._names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        self._files = Files(spark)
        self._manifest = Manifest(self._files, f"{self.root}/_manifest")
        self._lease = Lease(self._files, f"{self.root}/_writer", lease_seconds)
        # Set in a transaction or a snapshot.
        self._base: Head | None = None
        self._pending: dict[str, Change] | None = None
        self._outer: Store = self
        self._lock = threading.Lock()
        owner = hashlib.sha256(self.root.encode()).hexdigest()[:16]
        self.staging_root = f"{shared_folder(spark)}/lamina/staging/{owner}"
        self.user_buckets = self._settled_buckets(user_buckets)

    def _settled_buckets(self, wanted: int | None) -> int:
        """The number kept in a folder name, as users would be found in other buckets under another one."""
        kept = [int(n.removeprefix(_BUCKETS)) for n in self._files.names(self.root) if n.startswith(_BUCKETS)]
        if kept and wanted not in (None, kept[0]):
            raise ValueError(f"{self.root} has {kept[0]} user buckets, not {wanted}")
        if not kept:
            kept = [wanted or 16]
            self._files.make_folder(f"{self.root}/{_BUCKETS}{kept[0]}")
        return kept[0]

    # -- folders ---------------------------------------------------------------

    def path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.layer}/{spec.name}"

    def scope_path(self, spec: TableSpec, scope: Scope) -> str:
        return "/".join([self.path(spec), *self._folders(spec, scope)])

    def _part(self, spec: TableSpec, scope: Scope) -> str:
        return "/".join(self._folders(spec, scope))

    def _folders(self, spec: TableSpec, values: Iterable) -> list[str]:
        return [self._folder(column, value) for column, value in zip(spec.partition_by, values)]

    def _folder(self, column: str, value) -> str:
        text = None if value is None else str(value)
        if text and _PLAIN.fullmatch(text):
            return f"{column}={text}"
        return self._names.getPartitionPathString(column, text)

    def exists(self, path: str) -> bool:
        return self._files.exists(path)

    def drop_folder(self, path: str) -> None:
        self._files.delete(path)

    # -- commits ---------------------------------------------------------------

    def writing(self) -> Lease:
        """To be the one writer for some steps; raises if there is another."""
        return self._lease

    @contextmanager
    def transaction(self) -> Iterator["Store"]:
        """A store whose reads see what it has written, and nobody else does, until all of it is committed at the end.

        An error leaves everything as it was. Within a transaction there is no other one.
        """
        with self.writing():
            inner = copy.copy(self)
            inner._base, inner._pending, inner._lock = self._manifest.head(), {}, threading.Lock()
            try:
                yield inner
                inner._commit()
            except BaseException:
                inner._forget()
                raise

    def _commit(self) -> None:
        if self._pending:
            self._manifest.commit(self._base, self._pending, self._lease.assert_held)
            for table_id, part, version in self._manifest.expired():
                self.drop_folder(self._version_path(table_id, part, version))

    def _version_path(self, table_id: str, part: str, version: str) -> str:
        return "/".join(filter(None, [self.root, *table_id.split("."), part, f"{VERSION}={version}"]))

    def _forget(self) -> None:
        """Delete what a transaction wrote before it failed; what a lost writer leaves is never seen, only takes room."""
        for table_id, change in self._pending.items():
            for parts in (change.replaced, change.added):
                for part, versions in parts.items():
                    for version in versions:
                        self.drop_folder(self._version_path(table_id, part, version))

    @property
    def settled(self) -> "Store":
        """The store outside the transaction: for logs that stay whatever becomes of it."""
        return self._outer

    def snapshot(self) -> "Store":
        """A store for reading all tables as the last commit left them, whatever is committed later."""
        pinned = copy.copy(self)
        pinned._base = self._manifest.head()
        return pinned

    def _live(self, spec: TableSpec) -> Live:
        live = self._manifest.live(self._base or self._manifest.head(), spec.table_id)
        pending = (self._pending or {}).get(spec.table_id)
        return pending.over(live) if pending else live

    def _within(self, spec: TableSpec, scopes: Iterable[Scope]) -> Live:
        live, found = self._live(spec), {}
        for scope in scopes:
            part = self._part(spec, scope)
            if len(scope) == len(spec.partition_by):
                found.update({part: live[part]} if part in live else {})
            else:
                found.update({p: v for p, v in live.items() if not part or p.startswith(part + "/")})
        return found

    def first_level(self, spec: TableSpec) -> list[str]:
        """Values of the first partition column."""
        return list(dict.fromkeys(unquote(part.split("/", 1)[0].split("=", 1)[1]) for part in self._live(spec)))

    def partitions(self, spec: TableSpec) -> dict[tuple, list[str]]:
        """The partitions there are, as text and for INT columns as numbers, and the versions each consists of."""
        kinds = {name: dtype.typeName() for name, dtype, _ in spec.columns}

        def value(folder: str):
            column, text = folder.split("=", 1)
            return int(text) if kinds[column] == "integer" else unquote(text)

        return {tuple(map(value, part.split("/"))) if part else (): versions for part, versions in self._live(spec).items()}

    # -- reading ---------------------------------------------------------------

    def read(self, spec: TableSpec, scopes: Iterable[Scope] | None = None) -> DataFrame:
        """The table, or only the partitions of `scopes`, whose folders alone are then listed."""
        root = self.path(spec)
        live = self._live(spec) if scopes is None else self._within(spec, scopes)
        paths = [self._version_path(spec.table_id, part, v) for part, versions in live.items() for v in versions]
        if not paths:
            return self.spark.createDataFrame([], spec.schema)
        reader = self.spark.read.schema(spec.schema).option("basePath", root)
        return reader.parquet(*paths).select(*spec.column_names)

    def read_latest(self, spec: TableSpec) -> DataFrame:
        """Current rows of a latest-wins table that is written by appending."""
        return keep_latest(self.read(spec), spec.keys, spec.version)

    # -- staging ---------------------------------------------------------------

    def is_staged(self, batch_id: str, step: str) -> bool:
        return self.exists(f"{self._staging(batch_id)}/{step}/_SUCCESS")

    def staged(self, batch_id: str, step: str, df: DataFrame) -> DataFrame:
        """`df` through a staging table, which is reused if an earlier attempt completed it."""
        path = f"{self._staging(batch_id)}/{step}"
        if not self.is_staged(batch_id, step):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _staging(self, batch_id: str) -> str:
        return f"{self.staging_root}/{self._folder('batch', batch_id)}"

    def staged_batches(self) -> list[str]:
        """What has a staging folder."""
        return [unquote(name.split("=", 1)[1]) for name in self._files.names(self.staging_root) if "=" in name]

    def clear_staging(self, batch_id: str) -> None:
        self.drop_folder(self._staging(batch_id))

    # -- writing ---------------------------------------------------------------

    def publish(
        self, spec: TableSpec, staged: DataFrame, scopes: Iterable[Scope], partitions: Iterable[Scope] | None = None
    ) -> None:
        """Make `staged` the whole content of `scopes`; partitions it has no rows for disappear.

        `partitions` are the ones `staged` may have rows for, where the caller knows them. Outside a transaction it is one of its own.
        """
        if self._pending is None:
            with self.transaction() as inner:
                inner._publish(spec, staged, scopes, partitions)
        else:
            self._publish(spec, staged, scopes, partitions)

    def _publish(self, spec: TableSpec, staged: DataFrame, scopes: Iterable[Scope], partitions: Iterable[Scope] | None) -> None:
        if partitions is None:
            partitions = map(tuple, staged.select(*spec.partition_by).distinct().collect())
        parts = [self._part(spec, p) for p in partitions]
        version = self._write(spec, arranged(staged.select(*spec.column_names), spec, len(parts))) if parts else None
        gone = {part: [] for part in self._within(spec, scopes)}
        # Without rows there is no folder.
        held = [part for part in parts if self.exists(self._version_path(spec.table_id, part, version))]
        self._note(spec, Change({**gone, **{part: [version] for part in held}}, {}))

    def append(self, spec: TableSpec, df: DataFrame, partitions: Iterable[Scope] | None = None) -> None:
        """Add rows to a log table; `partitions` as in `publish`."""
        if self._pending is None:
            with self.transaction() as inner:
                inner.append(spec, df, partitions)
            return
        if not spec.partition_by:
            partitions = [()]
        elif partitions is None:
            partitions = map(tuple, df.select(*spec.partition_by).distinct().collect())
        version = self._write(spec, df.select(*spec.column_names))
        # Without rows there is no folder.
        parts = [part for part in (self._part(spec, p) for p in partitions) if self.exists(self._version_path(spec.table_id, part, version))]
        self._note(spec, Change({}, {part: [version] for part in parts}))

    def draw_together(self, spec: TableSpec, versions: int = 64) -> int:
        """Write partitions that consist of at least so many versions as one each; returns how many. To be called now and then for
        tables that deliveries add to; rows stay the same."""
        with self.transaction() as inner:
            scopes = [part for part, held in inner.partitions(spec).items() if len(held) >= versions]
            if scopes:
                inner._publish(spec, inner.read(spec, scopes), scopes, scopes)
        return len(scopes)

    def _write(self, spec: TableSpec, rows: DataFrame) -> str:
        """Returns the name of the new version."""
        version = f"c{uuid.uuid4().hex[:16]}"
        rows.withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy(*spec.partition_by, VERSION).parquet(self.path(spec))
        return version

    def _note(self, spec: TableSpec, change: Change) -> None:
        with self._lock:
            known = self._pending.get(spec.table_id, Change({}, {}))
            added = {p: v for p, v in known.added.items() if p not in change.replaced}
            for part, versions in change.added.items():
                added[part] = [*added.get(part, []), *versions]
            self._pending[spec.table_id] = Change({**known.replaced, **change.replaced}, added)

    # -- SQL access ------------------------------------------------------------

    def register_tables(self, prefix: str = "") -> None:
        """Databases and views of all tables as of the last commit, so that SQL users see them; safe to repeat, and to be repeated to
        see later commits. A view reads the files through a table `<name>__files`, which has the version as a further partition."""
        now = self.snapshot()
        for layer in dict.fromkeys(t.layer for t in TABLES):
            self.spark.sql(f"create database if not exists {prefix}{layer}")
        for t in TABLES:
            view = f"{prefix}{t.layer}.{t.name}"
            name = f"{view}__files"
            self._files.make_folder(self.path(t))
            columns = ", ".join(f"{c} {dtype.simpleString()} comment '{_quoted(text)}'" for c, dtype, text in t.columns)
            keys = [*t.partition_by, VERSION]
            self.spark.sql(
                f"create table if not exists {name} ({columns}, {VERSION} string comment 'Commit that wrote the row') using parquet "
                f"partitioned by ({', '.join(keys)}) location '{self.path(t)}' comment '{_quoted(t.description)}'"
            )
            wanted = {(*p.split("/"), f"{VERSION}={v}") if p else (f"{VERSION}={v}",) for p, versions in now._live(t).items() for v in versions}
            known = {tuple(r[0].split("/")) for r in self.spark.sql(f"show partitions {name}").collect()}
            for verb, parts in (("drop if exists", known - wanted), ("add if not exists", wanted - known)):
                parts, joint = sorted(parts), ", " if verb.startswith("drop") else " "
                for at in range(0, len(parts), 200):
                    clauses = joint.join(f"partition ({', '.join(map(_clause, p))})" for p in parts[at : at + 200])
                    self.spark.sql(f"alter table {name} {verb} {clauses}")
            self.spark.catalog.refreshTable(name)
            described = ", ".join(f"{c} comment '{_quoted(text)}'" for c, _, text in t.columns)
            self.spark.sql(
                f"create or replace view {view} ({described}) comment '{_quoted(t.description)}' as select {', '.join(t.column_names)} from {name}"
            )


def _clause(folder: str) -> str:
    column, value = folder.split("=", 1)
    return f"{column}='{_quoted(unquote(value))}'"


def arranged(df: DataFrame, spec: TableSpec, partitions: int | None = None) -> DataFrame:
    """Rows brought together by partition and sorted for data skipping.

    Small partitions are hashed to one task each, or several to a task where there are many for each core. Elsewhere a
    partition may hold a large share of the rows, and the rebalance lets AQE split it over several tasks.
    """
    if spec.small_partitions and partitions:
        spark = df.sparkSession
        tasks = min(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        gathered = df.repartition(tasks, *spec.partition_by)
    else:
        gathered = df.hint("rebalance", *spec.partition_by)
    return gathered.sortWithinPartitions(*spec.partition_by, *spec.sort_by)


def _quoted(text: str) -> str:
    return text.replace("'", "\\'")
