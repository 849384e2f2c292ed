"""Declared datasets: tables and views defined by functions, with expectations.

A dataset is a function ``fn(ctx) -> DataFrame`` registered under a name; it
refers to other datasets with ``ctx.read(name)``. Nothing runs when a dataset
is declared or read: reads return lazily built DataFrames and Catalyst sees
one plan.

``Context.run`` materialises tables in dependency order. Each is written once, to a
fresh folder: rows that fail a drop rule go apart from those that are kept, with the
names of the rules, and the rule counts are observed by that write. Later tables read the
fresh copies, which cuts the lineage at every table boundary. When all are there
and their table-level expectations hold, the run publishes them, as folders or as
named tables of a catalog schema with their declared comments and properties,
and adds its counts to the tables ``rule_metrics`` and ``run_tables`` under its run id.
A run that fails before that leaves the tables of the run before as they were.
"""

from __future__ import annotations

import re
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..operators.expectations import (ALL_OR_DROP, DROP, EXPECT, FAILED, FAILED_RULES, KEPT, OR_DROP, STATE, WARN,
                                      Rule, SummedCounts, apply_rules, observe_rules, observed_metrics, split_by_rules)
from ..operators.table_checks import FAIL, Reference, UniqueKey, keys_to_filter, reference_metrics, unique_metrics
from ..sources import io


#: Tables that a run writes at a time.
WRITERS = 4

#: A table that may be written in shares (``shares_of``) is written in at most SHARES, as many as the table it is
#: made from has SHARE_BYTES, by Catalyst's estimate.
SHARES, SHARE_BYTES = 4, 256 << 20

#: The tables of a run's counts.
RULE_METRICS, RUN_TABLES = "rule_metrics", "run_tables"
METRICS_SCHEMA = "dataset string, rule string, action string, passed long, failed long"
TABLES_SCHEMA = "dataset string, rows_read long, rows_kept long, rows_failed long, location string"


@dataclass
class DatasetDef:
    name: str
    fn: Callable[["Context"], DataFrame]
    kind: str                      # "table" or "view"
    comment: str = ""
    properties: dict = field(default_factory=dict)
    rules: list[Rule] = field(default_factory=list)
    uniques: list[UniqueKey] = field(default_factory=list)
    references: list[Reference] = field(default_factory=list)
    shares_of: str | None = None


@dataclass
class _Run:
    """What a run has written so far."""

    out_dir: str
    fmt: str
    quarantine: bool
    named: bool                                             # to be tables of a catalog schema
    staged: dict[str, str] = field(default_factory=dict)    # version folder of each table
    kept: dict[str, tuple[str, StructType]] = field(default_factory=dict)
    failed: dict[str, tuple[str, StructType]] = field(default_factory=dict)

    def base(self, name: str) -> str:
        return f"{self.out_dir}/{name}" if self.named else f"{self.out_dir}/_staged/{name}"


class TableCheckError(RuntimeError):
    """A table-level expectation with action ``fail`` does not hold; nothing was published."""


def _attach(fn, rules: list[Rule]):
    fn.__rules__ = list(rules) + list(getattr(fn, "__rules__", []))
    return fn


class Registry:
    def __init__(self):
        self.datasets: dict[str, DatasetDef] = {}

    # -- declarations -------------------------------------------------------------
    def _declare(self, kind, name, comment, properties, shares_of=None):
        def deco(fn):
            n = name or fn.__name__
            if n in self.datasets:
                raise ValueError(f"dataset declared twice: {n}")
            if n in (RULE_METRICS, RUN_TABLES):
                raise ValueError(f"{n} is a table of the runs themselves")
            self.datasets[n] = DatasetDef(n, fn, kind, comment, dict(properties or {}),
                                          list(getattr(fn, "__rules__", [])), list(getattr(fn, "__uniques__", [])),
                                          list(getattr(fn, "__references__", [])), shares_of)
            return fn
        return deco

    def table(self, name: str | None = None, comment: str = "", properties: dict | None = None,
              shares_of: str | None = None):
        """With ``shares_of``, the table whose wide rows it moves, a run writes a large one share by share, which bounds
        its shuffle's files: its function gives the rows of ``ctx.share()``."""
        return self._declare("table", name, comment, properties, shares_of)

    def view(self, name: str | None = None, comment: str = ""):
        return self._declare("view", name, comment, None)

    @staticmethod
    def expect(name: str, predicate: str):
        return lambda fn: _attach(fn, [Rule(name, predicate, WARN, EXPECT)])

    @staticmethod
    def expect_or_drop(name: str, predicate: str):
        return lambda fn: _attach(fn, [Rule(name, predicate, DROP, OR_DROP)])

    @staticmethod
    def expect_all_or_drop(rules: dict[str, str]):
        return lambda fn: _attach(fn, [Rule(n, p, DROP, ALL_OR_DROP) for n, p in rules.items()])

    @staticmethod
    def expectations(rules: list[Rule]):
        """Attach a prepared rule list (see ``operators.expectations``)."""
        return lambda fn: _attach(fn, rules)

    @staticmethod
    def expect_unique(name: str, *columns: str, action: str = WARN):
        """No two rows of the table share these columns: counted (warn), or the run ends (fail)."""
        def deco(fn):
            fn.__uniques__ = [UniqueKey(name, columns, action), *getattr(fn, "__uniques__", [])]
            return fn
        return deco

    @staticmethod
    def expect_reference(name: str, columns: str | tuple[str, ...], parent: str,
                         parent_columns: str | tuple[str, ...] | None = None, action: str = WARN):
        """The columns stand in a row of the table ``parent``: counted (warn), or the run ends (fail)."""
        own = (columns,) if isinstance(columns, str) else tuple(columns)
        other = (parent_columns,) if isinstance(parent_columns, str) else tuple(parent_columns or own)

        def deco(fn):
            fn.__references__ = [Reference(name, own, parent, other, action), *getattr(fn, "__references__", [])]
            return fn
        return deco

    # -- lookups ----------------------------------------------------------------------
    def rules(self, name: str) -> list[Rule]:
        return list(self.datasets[name].rules)

    def tables(self) -> list[str]:
        return [n for n, d in self.datasets.items() if d.kind == "table"]

    def context(self, spark: SparkSession, sources: dict, **params) -> "Context":
        return Context(self, spark, sources, params)


class Context:
    """One evaluation of the registry over given sources.

    ``sources`` maps input names to DataFrames or zero-argument callables
    returning DataFrames (built on first use). ``params`` are free parameters
    the dataset functions may read (``ctx.param("run_ts")``).
    """

    def __init__(self, registry: Registry, spark: SparkSession, sources: dict, params: dict):
        self.registry = registry
        self.spark = spark
        self._sources = dict(sources)
        self._params = params
        self._built: dict[str, DataFrame] = {}
        self._unchecked: dict[str, DataFrame] = {}
        self._written: dict[str, str] = {}
        self._published: dict[str, Callable[[], DataFrame]] = {}
        self._running: _Run | None = None
        self._reading = threading.local()      # what this thread is building, outermost first
        self._deps: dict[str, set[str]] = {}    # what each dataset's function has read
        self._observations: dict = {}
        self._checks: list[tuple] = []          # table-level counts of the last run
        #: Where the rows are that the last run's drop rules failed: by table, a folder or a table's name.
        self.failed_tables: dict[str, str] = {}
        self.run_id: str | None = None

    def param(self, name: str, default=None):
        return self._params.get(name, default)

    def share(self) -> tuple[int, int] | None:
        """The share of its rows, (k, n), that the dataset being built is to give; None for all."""
        return getattr(self._reading, "share", None)

    def _note(self, name: str) -> list[str]:
        chain = self._reading.__dict__.setdefault("chain", [])
        if chain:
            self._deps.setdefault(chain[-1], set()).add(name)
        return chain

    def unchecked(self, name: str) -> DataFrame:
        """The dataset before its drop rules (for metrics and failed rows)."""
        chain = self._note(name)
        if name not in self._unchecked:
            if name in chain:
                raise ValueError(f"datasets read each other: {' -> '.join([*chain[chain.index(name):], name])}")
            chain.append(name)
            share, self._reading.share = self.share(), None          # a share is the table's, not of what it reads
            try:
                self._unchecked[name] = self.registry.datasets[name].fn(self)
            finally:
                chain.pop()
                self._reading.share = share
        return self._unchecked[name]

    def read(self, name: str) -> DataFrame:
        self._note(name)
        if name in self._built:
            return self._built[name]
        if name in self._sources:
            src = self._sources[name]
            df = src() if callable(src) else src
        elif name in self._published:
            df = self._published[name]()
        elif name in self.registry.datasets:
            d = self.registry.datasets[name]
            df = self.unchecked(name)
            if self._running and d.kind == "table":
                df = self._stage(self._running, d, df)
            elif d.rules:
                df = apply_rules(df, d.rules)
        else:
            raise KeyError(f"unknown dataset: {name}")
        self._built[name] = df
        return df

    # -- runs ---------------------------------------------------------------------------
    def _load(self, path: str, schema: StructType, fmt: str) -> DataFrame:
        return self.spark.read.schema(schema).format(fmt).load(path)

    def _shares(self, d: DatasetDef, df: DataFrame) -> list[DataFrame]:
        """The table's rows, in as many shares as the run writes one after the other."""
        if not d.shares_of:
            return [df]
        size = self.read(d.shares_of)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        n = min(SHARES, 1 + int(str(size)) // SHARE_BYTES)
        shares = []
        for k in range(n if n > 1 else 0):
            self._reading.share = (k, n)
            try:
                shares.append(d.fn(self))
            finally:
                self._reading.share = None
        return shares or [df]

    def _stage(self, run: _Run, d: DatasetDef, df: DataFrame) -> DataFrame:
        """Write a table to a fresh folder, its failed rows apart; the kept rows, read back."""
        # the counts ride along with the write: no second pass
        schema, apart = df.schema, run.quarantine and any(r.action == DROP for r in d.rules)
        path, seen = None, []
        for df in self._shares(d, df):
            df, counts = observe_rules(df, d.rules, d.name)
            seen.append(counts)
            rows = split_by_rules(df, d.rules) if apart else apply_rules(df, d.rules)
            path = io.stage(rows, run.base(d.name), run.fmt, partition_by=STATE if apart else None, deal=False, into=path)
            run.staged[d.name] = path
        self._observations[d.name] = seen[0] if len(seen) == 1 else SummedCounts(seen)
        if apart:
            parts = {s: f"{path}/{STATE}={s}" for s in (KEPT, FAILED)}
            more = StructType([*schema.fields, StructField(FAILED_RULES, ArrayType(StringType()))])
            for state, kind in ((KEPT, schema), (FAILED, more)):
                if not io.folder_exists(self.spark, parts[state]):      # no row of this state
                    io.empty_like(self.spark, kind, parts[state], run.fmt)
            run.kept[d.name], run.failed[d.name] = (parts[KEPT], schema), (parts[FAILED], more)
        else:
            run.kept[d.name] = (path, schema)
        return self._load(*run.kept[d.name], run.fmt)

    def _check_tables(self, run: _Run, tables: list[str]) -> list[tuple]:
        """Counts of the table-level expectations of the written tables; raises where one with ``fail`` fails."""
        jobs = []
        for name in tables:
            d = self.registry.datasets[name]
            jobs += [lambda r=r, n=name: unique_metrics(self.read(n), r, n) for r in d.uniques]
            for r in d.references:
                if r.parent in run.kept or r.parent in self._published or r.parent in self._sources:
                    jobs.append(lambda r=r, n=name: reference_metrics(
                        self.read(n), self.read(r.parent), r, n,
                        keys_to_filter(self.read(r.parent), r.parent_columns)))
        with ThreadPoolExecutor(max_workers=WRITERS) as pool:
            rows = [tuple(x) for x in pool.map(lambda job: job().first(), jobs)]
        bad = [f"{dataset}: {rule} ({failed} rows)" for dataset, rule, action, _, failed in rows
               if action == FAIL and failed]
        if bad:
            raise TableCheckError("; ".join(bad))
        return rows

    def _publish(self, run: _Run, schema: str | None) -> None:
        """Switch every name (or folder) to what the run has written."""
        for name in run.staged:
            d = self.registry.datasets[name]
            parts = [(name, run.kept[name], d.comment)]
            if name in run.failed:
                parts.append((f"{name}_{FAILED}", run.failed[name], f"Rows of {name} that failed a drop rule"))
            for title, (path, kind), comment in parts:
                if schema:
                    where = io.switch_table(self.spark, f"{schema}.{title}", path, kind, run.fmt, comment, d.properties)
                    load = lambda n=where: io.read_table(self.spark, n)
                else:
                    where = io.swap_folder(self.spark, path, f"{run.out_dir}/{title}" if title == name
                                           else f"{run.out_dir}/quarantine/{name}")
                    load = lambda p=where, k=kind: self._load(p, k, run.fmt)
                if title == name:
                    self._written[name], self._published[name] = where, load
                else:
                    self.failed_tables[name] = where
            io.drop_old_versions(self.spark, run.base(name), io.KEEP_VERSIONS if schema else 0, parts=True)
        self._forget()

    def _write_counts(self, run: _Run, schema: str | None) -> None:
        """This run's rows of the tables ``rule_metrics`` and ``run_tables``, in a partition of its own."""
        tables = []
        for name in run.staged:
            seen = self._observations[name].get
            tables.append((name, seen["__rows"], seen["__kept"], seen["__rows"] - seen["__kept"], self._written[name]))
        for title, rows, kind in ((RULE_METRICS, self.rule_metrics(), METRICS_SCHEMA), (RUN_TABLES, tables, TABLES_SCHEMA)):
            path = f"{run.out_dir}/{title}"
            df = io.rows_to_df(self.spark, rows, kind)
            df.coalesce(1).write.mode("overwrite").parquet(f"{path}/run_id={self.run_id}")
            if schema:
                io.add_partition(self.spark, f"{schema}.{title}", path, df.schema, "run_id", self.run_id)

    def counts(self, title: str, out_dir: str | None = None, schema: str | None = None) -> DataFrame:
        """``rule_metrics`` or ``run_tables`` of all runs into a folder or a schema."""
        if schema:
            return io.read_table(self.spark, f"{schema}.{title}")
        kind = {RULE_METRICS: METRICS_SCHEMA, RUN_TABLES: TABLES_SCHEMA}[title]
        return self.spark.read.schema(f"{kind}, run_id string").parquet(f"{out_dir.rstrip('/')}/{title}")

    def failed(self, name: str) -> DataFrame:
        """The rows of a table that failed a drop rule in the last run, with ``failed_rules``."""
        where = self.failed_tables[name]
        return io.read_table(self.spark, where) if "/" not in where else self.spark.read.parquet(where)

    def observed(self, name: str) -> dict | None:
        """Values observed while ``name`` was written by the running or last run, else None."""
        written = self._running.staged if self._running else self._written
        return dict(self._observations[name].get) if name in written else None

    def rule_metrics(self) -> list[tuple]:
        """(dataset, rule, action, passed, failed) of every table written by ``run``, table-level rules last."""
        out = []
        for name, obs in self._observations.items():
            out += observed_metrics(obs.get, self.registry.rules(name), name)
        return out + self._checks

    def row_counts(self) -> dict[str, int]:
        """Rows of every table that the last run has written, as its writes observed them."""
        return {name: int(self._observations[name].get["__kept"]) for name in self._written if name in self._observations}

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every declared dataset as a temporary view (lazy, by name)."""
        for n in self.registry.datasets:
            self.read(n).createOrReplaceTempView(prefix + n)
        return [prefix + n for n in self.registry.datasets]

    def run(self, out_dir: str, targets: list[str] | None = None, fmt: str = "parquet", schema: str | None = None,
            quarantine: bool = True, run_id: str | None = None) -> dict[str, str]:
        """Write every target table (default: all) in dependency order, then publish them.

        Returns ``{table name: path}``. With ``schema`` the tables are tables of
        that catalog schema, their files in ``out_dir``, and the result holds
        their names. Views are not written; a view read by a table is folded
        into that table's plan. With ``quarantine`` the rows that fail a drop rule
        are kept too: in ``out_dir/quarantine/<table>``, or the table ``<table>_failed``
        (see ``failed_tables``). The counts of the run stand under its ``run_id`` in the
        tables ``rule_metrics`` and ``run_tables``.
        """
        self.run_id = run_id or uuid.uuid4().hex
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", self.run_id):
            raise ValueError(f"not a run id: {self.run_id}")
        levels = self._levels(targets or self.registry.tables())
        run = _Run(out_dir.rstrip("/"), fmt, quarantine, bool(schema))
        self._observations, self._checks, self._written, self.failed_tables = {}, [], {}, {}
        try:
            self._running = run
            with io.lean_writes(self.spark):
                for level in levels:
                    # tables that don't read each other are written side by side
                    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
                        list(pool.map(self.read, level))
                self._checks = self._check_tables(run, [t for level in levels for t in level])
        except BaseException:
            self._forget()
            for path in run.staged.values():
                io.drop_folder(self.spark, path)
            raise
        finally:
            self._running = None
        self._publish(run, schema)
        self._write_counts(run, schema)
        return dict(self._written)

    def _forget(self) -> None:
        """Forget what was built, but for the sources."""
        self._built, self._unchecked = {n: df for n, df in self._built.items() if n in self._sources}, {}

    def _levels(self, targets: list[str]) -> list[list[str]]:
        """The targets and the tables they read, each after what it reads. All are
        built lazily once to learn that, and forgotten, so that they are
        written and their readers use the written copies."""
        self._published = {}
        self._forget()
        for t in targets:
            self.read(t)
        self._forget()

        def depth(name: str) -> int:
            below = max([depth(d) for d in self._deps.get(name, ()) if d != name], default=0)
            return below + (name in self.registry.datasets and self.registry.datasets[name].kind == "table")

        def reached(name: str) -> set[str]:
            return {name}.union(*(reached(d) for d in self._deps.get(name, ()) if d != name))

        levels: dict[int, list[str]] = {}
        wanted = set().union(*map(reached, targets))
        for t in self.registry.tables():
            if t in wanted:
                levels.setdefault(depth(t), []).append(t)
        return [levels[k] for k in sorted(levels)]
