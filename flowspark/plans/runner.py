"""Run a flow document: bind it to tables, chain its steps as temp views, write its sinks.

The driver only builds plans. Every step is one lazy ``spark.sql`` call over the
views of earlier steps, so Catalyst sees the whole chain at once and pushes
filters and columns through it down to the scans; jobs start only at sinks.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Callable, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

TABLE_VARIABLE = re.compile(r"\$\{(\w+)\}")
PARAMETER = re.compile(r"\$\[(\w+)\]")
WRITE_MODES = {"REPLACE": "overwrite", "APPEND": "append"}
HAVING_CONF = "spark.sql.legacy.parser.havingWithoutGroupByAsWhere"


class FlowError(ValueError):
    """The flow cannot be bound or run as given."""


@dataclass
class FlowRun:
    """Views by step name, and the sinks written (step, target, mode)."""

    views: dict[str, DataFrame] = field(default_factory=dict)
    written: list[tuple[str, str, str]] = field(default_factory=list)
    cached: list[DataFrame] = field(default_factory=list)

    def __getitem__(self, step: str) -> DataFrame:
        return self.views[step]

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()


def active_steps(flow: Mapping[str, Any]) -> list[dict[str, Any]]:
    """Enabled steps in ascending (order, position), but none before its parents."""
    steps = [s for s in flow["steps"] if s.get("active", True)]
    steps.sort(key=lambda s: s["order"])
    by_name = {s["name"]: s for s in steps}
    off = {s["name"] for s in flow["steps"]} - set(by_name)
    for step in steps:
        missing = off.intersection(step.get("parents", []))
        if missing:
            raise FlowError(f"active step {step['name']} depends on inactive {sorted(missing)}")
    waiting = {s["name"]: {p for p in s.get("parents", []) if p in by_name} for s in steps}
    place = {s["name"]: (s["order"], k) for k, s in enumerate(steps)}
    ready = [(place[name], name) for name, parents in waiting.items() if not parents]
    heapq.heapify(ready)
    out: list[dict[str, Any]] = []
    while ready:
        _, name = heapq.heappop(ready)
        out.append(by_name[name])
        del waiting[name]
        for child, parents in waiting.items():
            if name in parents:
                parents.discard(name)
                if not parents:
                    heapq.heappush(ready, (place[child], child))
    if waiting:
        raise FlowError(f"steps depend on each other: {sorted(waiting)}")
    return out


def unbound(flow: Mapping[str, Any], tables: Mapping, params: Mapping) -> set[str]:
    """Variables and parameters of the enabled steps that have no value."""
    names: set[str] = set()
    for step in active_steps(flow):
        names.update(set(TABLE_VARIABLE.findall(step["sql"])) - set(tables))
        names.update(set(PARAMETER.findall(step["sql"])) - set(params))
    return names


def bind_sql(sql: str, views: Mapping[str, str], params: Mapping[str, Any]) -> tuple[str, dict[str, Any]]:
    """Put view names for ``${X}`` and named parameters for ``$[X]``.

    This happens before Spark sees the text: Spark would itself replace ``${X}``
    from session settings, silently by nothing where the name is unset.
    """
    used = {name: params[name] for name in PARAMETER.findall(sql)}
    text = TABLE_VARIABLE.sub(lambda m: views[m.group(1)], sql)
    return PARAMETER.sub(lambda m: ":" + m.group(1), text), used


@contextmanager
def _having_filters(spark: SparkSession):
    """Accept HAVING without GROUP BY as a row filter while step SQL is parsed."""
    before = spark.conf.get(HAVING_CONF, None)
    spark.conf.set(HAVING_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(HAVING_CONF)
        else:
            spark.conf.set(HAVING_CONF, before)


def _temporary_view(spark: SparkSession, name: str) -> DataFrame | None:
    """The session's temp view of this name, looked up by the name alone."""
    try:
        found = spark.catalog.getTable(name)
    except AnalysisException:
        return None
    return spark.table(name) if found.isTemporary else None


@contextmanager
def _scoped_views(spark: SparkSession):
    """Temp views that exist only while the chain is built; shadowed ones return."""
    shadowed: dict[str, DataFrame | None] = {}

    def register(name: str, df: DataFrame) -> None:
        key = name.lower()
        if key not in shadowed:
            shadowed[key] = _temporary_view(spark, name)
        df.createOrReplaceTempView(name)

    try:
        yield register
    finally:
        for name, previous in shadowed.items():
            if previous is None:
                spark.catalog.dropTempView(name)
            else:
                previous.createOrReplaceTempView(name)


def bind_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame | str], register: Callable[[str, DataFrame], None]
) -> dict[str, str]:
    """A uniquely named view per table variable."""
    run = uuid.uuid4().hex[:12]
    views = {}
    for name, value in tables.items():
        views[name] = f"bound_{run}_{name}"
        register(views[name], spark.table(value) if isinstance(value, str) else value)
    return views


def _switch(spark: SparkSession, staged: str, target: str) -> None:
    """Put the folder ``staged`` in the place of ``target``, which stays whole until then."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    before = path(f"{target}.{uuid.uuid4().hex[:12]}.old")
    there = files.exists(path(target))
    if there and not files.rename(path(target), before):
        raise FlowError(f"cannot replace {target}")
    if not files.rename(path(staged), path(target)):
        raise FlowError(f"cannot move {staged} to {target}; its rows before are in {before}")
    if there:
        files.delete(before, True)


def write_step(
    df: DataFrame, target: str, mode: str, folder: str | None, partition_by: list[str] | None = None, run_id: str | None = None
) -> None:
    """Write one step result as parquet: to a catalog table, or below ``folder``.

    In a folder, REPLACE writes beside the target and then switches, so a step may read its
    own target and a failed run leaves it as it was. With ``run_id``, appended rows are a
    partition of that name, and appending the same run again replaces just that one.
    """
    if mode not in WRITE_MODES:
        raise FlowError(f"unknown appendType {mode!r}")
    spark, keys = df.sparkSession, list(partition_by or [])
    if run_id is not None:
        df, keys = df.withColumn("run_id", F.lit(run_id)), ["run_id", *keys]
    replace = WRITE_MODES[mode] == "overwrite"
    if folder is None:
        if run_id is None or replace or not spark.catalog.tableExists(target):
            writer = df.write.format("parquet").mode(WRITE_MODES[mode])
            (writer.partitionBy(*keys) if keys else writer).saveAsTable(target)
        else:
            # goes by place; the table's partition columns come last
            names = ", ".join(f"`{c}`" for c in spark.table(target).columns if c != "run_id")
            own = run_id.replace("\\", "\\\\").replace("'", "\\'")
            parts = ", ".join([f"run_id = '{own}'", *[f"`{k}`" for k in keys[1:]]])
            spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({parts}) SELECT {names} FROM {{rows}}", rows=df)
        return
    path = f"{folder.rstrip('/')}/{target}"
    if replace:
        staged = f"{folder.rstrip('/')}/_staged-{uuid.uuid4().hex}"
        writer = df.write.format("parquet")
        (writer.partitionBy(*keys) if keys else writer).save(staged)
        _switch(spark, staged, path)
        return
    writer = df.write.format("parquet").mode("append")
    if run_id is not None:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*keys) if keys else writer).save(path)


def run_flow(
    spark: SparkSession,
    flow: Mapping[str, Any],
    tables: Mapping[str, DataFrame | str],
    params: Mapping[str, Any] | None = None,
    udfs: Mapping[str, Any] | None = None,
    *,
    targets: Mapping[str, str] | None = None,
    sink_folder: str | None = None,
    write: bool = False,
    cache: bool = False,
    run_id: str | None = None,
) -> FlowRun:
    """Build (and with ``write`` also store) every enabled step of ``flow``.

    ``run_id`` names the run: writing it again leaves the same rows, also in targets that are
    appended to.

    ``cache`` keeps views that more than one later step reads; it is off by
    default because a kept view is a barrier to filter and column pushdown.
    """
    params = dict(params or {})
    missing = unbound(flow, tables, params)
    if missing:
        raise FlowError(f"no value for {sorted(missing)}")
    for name, fn in (udfs or {}).items():
        spark.udf.register(name, fn)

    steps = active_steps(flow)
    readers: dict[str, int] = {}
    for step in steps:
        for parent in step.get("parents", []):
            readers[parent] = readers.get(parent, 0) + 1

    run = FlowRun()
    with _scoped_views(spark) as register, _having_filters(spark):
        bound = bind_tables(spark, tables, register)
        for step in steps:
            text, args = bind_sql(step["sql"], bound, params)
            df = spark.sql(text, args=args) if args else spark.sql(text)
            if cache and readers.get(step["name"], 0) > 1:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
                run.cached.append(df)
            register(step["output"]["tempView"], df)
            run.views[step["name"]] = df

    if write:
        names = {**{n: n for n in tables}, **(targets or {})}
        for step in steps:
            target = step["output"].get("table", "")
            if not target:
                continue
            try:
                target = TABLE_VARIABLE.sub(lambda m: names[m.group(1)], target)
            except KeyError as e:
                raise FlowError(f"no target for {e}") from None
            mode = step["output"].get("appendType", "REPLACE")
            write_step(run.views[step["name"]], target, mode, sink_folder, run_id=run_id and f"{run_id}.{step['name']}")
            run.written.append((step["name"], target, mode))
    return run


def dry_run(
    spark: SparkSession,
    flow: Mapping[str, Any],
    schemas: Mapping[str, T.StructType | str],
    params: Mapping[str, Any] | None = None,
    udfs: Mapping[str, Any] | None = None,
) -> list[tuple[str, str]]:
    """Analyse every step over empty tables of the declared schemas.

    No job runs. Returns (step, error) for syntax errors, unknown columns,
    functions or views; an empty list means that the flow analyses.
    """
    for name, fn in (udfs or {}).items():
        spark.udf.register(name, fn)
    problems = []
    with _scoped_views(spark) as register, _having_filters(spark):
        bound = bind_tables(
            spark, {n: spark.createDataFrame([], schema) for n, schema in schemas.items()}, register
        )
        for step in active_steps(flow):
            try:
                text, args = bind_sql(step["sql"], bound, params or {})
                df = spark.sql(text, args=args) if args else spark.sql(text)
                register(step["output"]["tempView"], df)
            except KeyError as e:
                problems.append((step["name"], f"unbound {e.args[0]}"))
            except (AnalysisException, ParseException) as e:
                problems.append((step["name"], e.getCondition() or type(e).__name__))
    return problems
