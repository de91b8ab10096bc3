"""Versioned dataset builds: one Parquet folder per build and an append-only event table."""

from __future__ import annotations

import functools
import graphlib
import hashlib
import inspect
import json
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assetlake.operators import catalog, position, quality
from assetlake.operators.lineage import CycleError
from assetlake.session import prepare
from assetlake.sources import records

EVENT_SCHEMA = (
    "seq long, name string, version string, version_no long, index long, build_id string, "
    "status int, location string, info string, schema string, "
    "uses map<string,string>"
)
OUTCOME_SCHEMA = "name string, level int, status string, build_id string, info string, uses map<string,string>"
REGISTRATION_SCHEMA = "seq long, name string, description string, dependencies array<string>, source_digest string"
STARTED, COMPLETED, FAILED = 1, 2, 3


def scan_partitions(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All Parquet partitions as one table; columns missing from a partition are null."""
    if not paths:
        return spark.createDataFrame([], "struct<>")
    return spark.read.option("mergeSchema", True).parquet(*paths)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, with the union of their columns."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_nanosecond_times(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read Parquet whose ``columns`` are nanosecond timestamps, cut to microseconds."""
    setting = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        df = spark.read.parquet(path)
        micros = {c: F.timestamp_micros(F.floor(F.col(f"`{c}`") / 1000)).cast("timestamp_ntz") for c in columns}
        df = df.withColumns(micros)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
    return df


@dataclass(frozen=True)
class DatasetFunction:
    """A named function that makes a table, with the rules its result must pass."""

    name: str
    function: Callable[..., DataFrame | None]
    dependencies: tuple = ()
    description: str = ""
    rules: tuple = field(default=())

    def __call__(self, *args, **kwargs):
        return self.function(*args, **kwargs)

    @property
    def needs(self) -> list[str]:
        """Names of the datasets it depends on."""
        return [d.name if isinstance(d, DatasetFunction) else d for d in self.dependencies]


def dataset(
    name: str, dependencies: Sequence = (), description: str = "", rules: Sequence[quality.Rule] = ()
):
    """Declare ``f(spark, …) -> DataFrame`` as the source of dataset ``name``."""
    for dependency in dependencies:
        if not isinstance(dependency, (str, DatasetFunction)):
            raise ValueError("a dependency must be a reference or a dataset function")

    def declare(function):
        return DatasetFunction(name, function, tuple(dependencies), description, tuple(rules))

    return declare


class BuildStore:
    """Writes, lists and reads builds below ``root``, a folder that all executors share.

    Events are only ever appended, so readers never see a half-written state: a build counts
    once its COMPLETED event exists. Concurrent writers of one dataset must pass ``index``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        # Two jobs that append to one folder at once would clean up each other's files.
        self._appending = threading.RLock()

    def _append(self, row: dict, schema: str, log: str) -> None:
        columns = [part.split()[0] for part in schema.split(", ")]
        with self._appending:
            entry = self.spark.createDataFrame([tuple({"seq": time.time_ns(), **row}[c] for c in columns)], schema)
            entry.coalesce(1).write.mode("append").parquet(f"{self.root}/{log}")

    def _record(self, **event) -> None:
        self._append({"location": None, "info": None, "schema": None, "uses": None, **event}, EVENT_SCHEMA, "_events")

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENT_SCHEMA).parquet(f"{self.root}/_events")

    def builds(self) -> DataFrame:
        """Current state of every build."""
        keys = ["name", "version", "version_no", "index", "build_id"]
        return catalog.build_status(self.events(), keys, "seq")

    def _next_index(self, name: str, version: str) -> int:
        try:
            events = self.events().filter((F.col("name") == name) & (F.col("version") == version))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 1  # no build was ever recorded below this root
        return (events.agg(F.max("index")).first()[0] or 0) + 1

    def _start(self, name: str, version: str, index: int | None) -> dict:
        with self._appending:
            return self._started(name, version, index)

    def _started(self, name: str, version: str, index: int | None) -> dict:
        build = {
            "name": name,
            "version": version,
            "version_no": int(version) if version.isdigit() else 0,
            "index": index if index is not None else self._next_index(name, version),
            "build_id": uuid.uuid4().hex,
        }
        self._record(status=STARTED, **build)
        return build

    def _finish(
        self, build: dict, make: Callable, rules: Sequence[quality.Rule], max_records_per_file: int,
        order: Sequence[str] = (), uses: dict[str, str] | None = None,
    ) -> str | None:
        """Make, write and check the table of a started build; whatever is raised is recorded as its failure.

        ``uses`` may be filled while the table is made: the build of each dependency that it was made from.
        """
        location = f"{self.root}/{build['name']}/{build['build_id']}"
        try:
            result = make()
            if result is None:
                self._record(status=COMPLETED, uses=uses, **build)
                return None
            df = records.check_table(result)
            if order:
                position.write_ordered(df, order, location, max_records_per_file or position.ROWS_PER_BLOCK)
            else:
                df.write.mode("errorifexists").option("maxRecordsPerFile", max_records_per_file).parquet(location)
            if rules:
                quality.check(self.spark.read.schema(df.schema).parquet(location), rules)
        except BaseException as error:
            self._record(status=FAILED, info=str(error), uses=uses, **build)
            raise
        self._record(status=COMPLETED, location=location, schema=df.schema.json(), uses=uses, **build)
        return build["build_id"]

    def write(
        self,
        df: DataFrame,
        name: str,
        version: str = "1",
        rules: Sequence[quality.Rule] = (),
        index: int | None = None,
        max_records_per_file: int = 0,
        order: Sequence[str] = (),
    ) -> str:
        """Write one build and return its id.

        The table is written once, into the build's own folder; the rules then run on the
        written columns. If a rule fails, the build is recorded as FAILED, without a location.
        With a total ``order`` key the build is stored in that order, for :meth:`ordered`.
        """
        return self._finish(self._start(name, version, index), lambda: df, rules, max_records_per_file, order)

    def register(self, function: DatasetFunction) -> None:
        """Record a dataset function's description, dependencies and source digest; the last registration counts."""
        try:
            source = inspect.getsource(function.function)
        except OSError:  # defined in an interactive session
            source = function.function.__qualname__
        row = {
            "name": function.name,
            "description": function.description,
            "dependencies": function.needs,
            "source_digest": hashlib.sha256(source.encode()).hexdigest(),
        }
        self._append(row, REGISTRATION_SCHEMA, "_registrations")

    def registrations(self) -> DataFrame:
        """What is registered of each dataset."""
        every = self.spark.read.schema(REGISTRATION_SCHEMA).parquet(f"{self.root}/_registrations")
        return catalog.registry_latest(every, ["name"], "seq")

    def build(self, function: DatasetFunction, version: str = "1", *args, **kwargs) -> str | None:
        """Register and run a dataset function and write its result, a DataFrame or a list of dicts.

        The build is STARTED before the function runs and FAILED if it raises. Without a result the build completes
        but has nothing to read.
        """
        self.register(function)
        started = self._start(function.name, version, None)
        return self._finish(started, lambda: function(self.spark, *args, **kwargs), function.rules, 0)

    def build_all(self, functions: Sequence[DatasetFunction], version: str = "1", workers: int = 4) -> DataFrame:
        """Build a set of dataset functions, each after those of the set that it depends on.

        A function is called with the session and a table per dependency, in the declared order: the build that was just
        made, or the latest completed one of a dataset outside the set. Functions that wait for nothing run side by side,
        ``workers`` at a time. One that raises is FAILED like any build; what depends on it is NOT BUILT and the others
        go on. The builds that a build was made from are recorded with it (:meth:`used_builds`).

        Returns ``(name, level, status, build_id, info, uses)``, where level 0 waits for nothing. A cycle raises
        before anything is built.
        """
        members = {f.name: f for f in functions}
        if len(members) < len(functions):
            raise ValueError("two functions of the set make the same dataset")
        inside = {name: [d for d in f.needs if d in members] for name, f in members.items()}
        waiting = graphlib.TopologicalSorter(inside)
        try:
            waiting.prepare()
        except graphlib.CycleError as error:
            raise CycleError("the dependencies form a cycle: " + " -> ".join(error.args[1])) from None
        levels: dict[str, int] = {}
        for name in graphlib.TopologicalSorter(inside).static_order():
            levels[name] = 1 + max((levels[d] for d in inside[name]), default=-1)
        outcomes: dict[str, tuple] = {}
        running: dict[Future, str] = {}
        with ThreadPoolExecutor(workers) as pool:
            while waiting.is_active():
                for name in waiting.get_ready():
                    known = {d: outcomes[d] for d in inside[name]}
                    running[pool.submit(self._build_one, members[name], version, known)] = name
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(future)
                    outcomes[name] = future.result()
                    waiting.done(name)
        rows = [(name, levels[name], *outcomes[name]) for name in members]
        return self.spark.createDataFrame(rows, OUTCOME_SCHEMA)

    def _build_one(self, function: DatasetFunction, version: str, known: dict[str, tuple]) -> tuple:
        """``(status, build_id, info, uses)`` of one function of a set; ``known`` has those of its dependencies in it."""
        bad = [d for d, outcome in known.items() if outcome[0] != "COMPLETED"]
        if bad:
            return "NOT BUILT", None, "not built: " + ", ".join(bad), {}
        uses: dict[str, str] = {}

        def make():
            tables = []
            for name in function.needs:
                build_id, location, schema = self._find(name, build_id=known[name][1] if name in known else None)
                uses[name] = build_id
                tables.append(self.spark.read.schema(schema).parquet(location))
            return function(self.spark, *tables)

        self.register(function)
        started = self._start(function.name, version, None)
        try:
            self._finish(started, make, function.rules, 0, uses=uses)
        except Exception as error:
            return "FAILED", started["build_id"], str(error), uses
        return "COMPLETED", started["build_id"], None, uses

    def used_builds(self) -> DataFrame:
        """``(name, build_id, dependency, used_build_id)``: what each completed build was made from."""
        done = self.events().filter(F.col("status") == COMPLETED)
        return done.select("name", "build_id", F.explode("uses").alias("dependency", "used_build_id"))

    def _find(
        self, name: str, version: str | None = None, index: int | None = None, build_id: str | None = None
    ) -> tuple[str, str, StructType]:
        chosen = self.builds().filter(F.col("name") == name)
        if build_id is not None:
            chosen = chosen.filter(F.col("build_id") == build_id)
        if version is not None:
            chosen = chosen.filter(F.col("version") == version)
        if index is not None:
            chosen = chosen.filter(F.col("index") == index)
        chosen = chosen.filter("location IS NOT NULL")
        best = catalog.latest_build(chosen, ["name"], ["location", "build_id"]).first()
        if best is None:
            raise LookupError(f"no completed build of {name}")
        written = self.events().filter((F.col("build_id") == best["build_id"]) & (F.col("status") == COMPLETED)).first()
        return best["build_id"], best["location"], StructType.fromJson(json.loads(written["schema"]))

    def read(self, name: str, version: str | None = None, index: int | None = None) -> DataFrame:
        """Latest completed build of a dataset, of one version of it, or exactly one build."""
        _, location, schema = self._find(name, version, index)
        return self.spark.read.schema(schema).parquet(location)

    def ordered(self, name: str, version: str | None = None, index: int | None = None) -> position.OrderedTable:
        """As :meth:`read`, of a build written with ``order``: rows by position, slices and heads without a write."""
        _, location, schema = self._find(name, version, index)
        return position.OrderedTable(self.spark, location, schema)
