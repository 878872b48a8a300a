"""Warehouse store: immutable table directories and one versioned manifest.

Parquet has no UPDATE/DELETE/MERGE and a table being read cannot be overwritten,
so every write goes to a new directory ``<root>/<table>/load=<id>/`` and a table is the
list of directories named by the current manifest. A load writes its directories
first and then commits one new manifest version (``<root>/_manifest/version=<n>``)
naming every table it changed plus its audit events: data and audit become
visible together or not at all. All I/O goes through Spark, so the root may be
any file system Spark can write (the committed version directory is created by
the job commit; concurrent writers are not supported: one loader at a time).

Facts are written by Spark as Hive partitions (``schemas.PARTITIONS``), each a directory of its own in
the manifest: a load or a report reads only the partitions it asks for, and a delete replaces only those
that held a deleted row. A write also carries its number of rows and largest surrogate key into the
manifest, so that loads never count a table or search it for its last key.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.schemas import PARTITIONS, SCHEMAS, STAGING_TABLES, SURROGATES
from starload.session import remove_path

log = logging.getLogger("starload")

MANIFEST_SCHEMA = T.StructType([T.StructField("table_name", T.StringType(), False),
                                T.StructField("path", T.StringType(), False),
                                T.StructField("table_rows", T.LongType(), False),
                                T.StructField("top_key", T.LongType(), False)])


class StoreError(RuntimeError):
    pass


@dataclass
class Table:
    """A table's directories, number of rows and largest surrogate key (0 without one)."""

    paths: list[str] = field(default_factory=list)
    rows: int = 0
    top_key: int = 0


@dataclass
class Transaction:
    store: "Warehouse"
    base_version: int
    tables: dict[str, Table]
    changed: set[str] = field(default_factory=set)
    written: list[str] = field(default_factory=list)

    def _write(self, table: str, df: DataFrame, kept: Table) -> str:
        """Write ``df`` and set the table to ``kept`` plus what was written."""
        path = f"{self.store.root}/{table}/load={uuid.uuid4().hex}"
        self.written.append(path)
        seen, key = Observation(), SURROGATES.get(table)
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), (F.max(key) if key else F.lit(0)).alias("top"))
        writer = df.write.mode("errorifexists")
        if table in PARTITIONS:
            writer.partitionBy(PARTITIONS[table]).parquet(path)
            paths = self.store.subfolders(path)
        else:
            writer.parquet(path)
            paths = [path]
        got = seen.get
        self.tables[table] = Table([*kept.paths, *paths], kept.rows + got["rows"], max(kept.top_key, got["top"] or 0))
        self.changed.add(table)
        return path

    def table(self, table: str) -> Table:
        return self.tables.get(table, Table())

    def replace(self, table: str, df: DataFrame) -> str:
        """New version of a whole table (dimensions, staging refresh)."""
        return self._write(table, df, Table())

    def append(self, table: str, df: DataFrame) -> str:
        """Add rows to a table (facts, audit events) without rewriting it."""
        return self._write(table, df, self.table(table))

    def keep(self, table: str, df: DataFrame, parts: list | None = None) -> str:
        """Delete as "rows to keep" (K12): the table, or its partitions ``parts``, become exactly ``df``.

        The directories of other partitions stay as they are; so does the largest key ever given.
        """
        now = self.table(table)
        if parts is None:
            return self._write(table, df, Table(top_key=now.top_key))
        old = self.store.in_parts(table, now.paths, parts)
        rest = [p for p in now.paths if p not in old]
        return self._write(table, df, Table(rest, now.rows - self.store.read(table, old).count(), now.top_key))

    def refresh_staging(self, table: str, df: DataFrame) -> str:
        """K1 + K2: truncate-and-load of a staging table; only the staging tables are allowed."""
        if table.lower() not in STAGING_TABLES:
            raise StoreError(f"only staging tables can be refreshed, not {table}")
        return self.replace(table, df)

    def read(self, table: str, parts: list | None = None, with_part: bool = False) -> DataFrame:
        """The table, or its partitions ``parts``, as this transaction sees it (its own writes included)."""
        return self.store.read(table, self.table(table).paths, parts, with_part)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest_root = f"{self.root}/_manifest"
        self._snapshot: tuple[int, dict[str, Table]] | None = None
        self.after_commit: list[Callable[[set[str]], None]] = []  # called with the tables a commit changed

    # ---- manifest ----------------------------------------------------------------------------
    def _manifest_frame(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(T.StructType([*MANIFEST_SCHEMA.fields,
                                                        T.StructField("version", T.LongType())])) \
                .parquet(self.manifest_root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None  # no manifest yet

    def version(self) -> int:
        m = self._manifest_frame()
        if m is None:
            return 0
        v = m.agg(F.max("version")).first()[0]
        return int(v) if v is not None else 0

    def refresh(self) -> None:
        """Forget the remembered manifest (needed only if another process may have committed)."""
        self._snapshot = None

    def _current(self) -> tuple[int, dict[str, Table]]:
        """Latest version and its tables, read once and then kept up to date by this object's commits."""
        if self._snapshot is None:
            v = self.version()
            self._snapshot = (v, self._read_tables(v))
        v, tables = self._snapshot
        return v, dict(tables)

    def tables(self, version: int | None = None) -> dict[str, list[str]]:
        """Each table's directories."""
        return {k: list(t.paths) for k, t in (self._current()[1] if version is None else self._read_tables(version)).items()}

    def rows(self, table: str) -> int:
        """A table's number of rows, carried along by its writes."""
        return self._current()[1].get(table, Table()).rows

    def _read_tables(self, version: int) -> dict[str, Table]:
        m = self._manifest_frame()
        if m is None:
            return {}
        out: dict[str, Table] = {}
        for r in m.filter(F.col("version") == version).orderBy("table_name", "path").collect():
            t = out.setdefault(r.table_name, Table([], r.table_rows, r.top_key))
            if r.path:
                t.paths.append(r.path)
        return out

    # ---- reads -------------------------------------------------------------------------------
    def read(self, table: str, paths: list[str] | None = None, parts: list | None = None,
             with_part: bool = False) -> DataFrame:
        """A table, some of its directories or partitions; ``with_part`` keeps the partition column."""
        paths = self.tables().get(table, []) if paths is None else paths
        schema, part = SCHEMAS.get(table), PARTITIONS.get(table)
        if part and parts is not None:
            paths = self.in_parts(table, paths, parts)
        if schema is None and not paths:
            raise StoreError(f"Unknown table {table}")
        if part:
            schema = T.StructType([*schema.fields, T.StructField(part, T.LongType())])
        if not paths:
            df = self.spark.createDataFrame([], schema)
        elif schema is None:
            return self.spark.read.parquet(*paths)
        else:
            df = self.spark.read.option("basePath", f"{self.root}/{table}").schema(schema).parquet(*paths)
        if part and parts is not None:
            df = df.filter(F.col(part).isin(parts))
        return df.select(*[f.name for f in SCHEMAS[table].fields], *([part] if part and with_part else []))

    def in_parts(self, table: str, paths: list[str], parts: list) -> list[str]:
        """Those directories of a partitioned table that hold one of its partitions ``parts``."""
        ends = tuple(f"/{PARTITIONS[table]}={p}" for p in parts)
        return [p for p in paths if p.endswith(ends)]

    def subfolders(self, path: str) -> list[str]:
        """The partition directories of a partitioned write, one for each value."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        found = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(where)
        return sorted(f"{path}/{x.getPath().getName()}" for x in found if x.isDirectory())

    # ---- writes ------------------------------------------------------------------------------
    @contextmanager
    def transaction(self):
        """Collect writes; commit them as one manifest version if the block ends without error.

        After an error before the commit, the directories the block wrote are removed: no manifest names them.
        """
        base, tables = self._current()
        tx = Transaction(self, base, tables)
        try:
            yield tx
            if tx.changed and self.version() != base:
                self._snapshot = None
                raise StoreError("Concurrent commit: the manifest moved while the load ran")
        except BaseException:
            self._remove(tx.written)
            raise
        if tx.changed:
            self._commit(tx)
            for hook in self.after_commit:
                try:
                    hook(tx.changed)
                except Exception:  # the commit stands: what follows it must not mark it as failed
                    log.exception("a hook after the commit failed")

    def _remove(self, paths: list[str]) -> None:
        for p in paths:
            remove_path(self.spark, p)

    def _commit(self, tx: Transaction) -> int:
        new = tx.base_version + 1
        rows = [(name, p, t.rows, t.top_key) for name, t in tx.tables.items() for p in t.paths or [""]]
        df = self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1)
        df.write.mode("errorifexists").parquet(f"{self.manifest_root}/version={new}")
        self._snapshot = (new, dict(tx.tables))
        return new
