"""Warehouse runs that readers see whole or not at all.

A run writes its tables into folders of its own and changes nothing that a
reader may see. What a table consists of stands in a manifest, one small JSON
file per committed run: committing writes the manifest aside and renames it to
the next number, a single rename. Readers take the manifest with the highest
number, so they see all tables of a run or, if it broke at any point before the
rename, all tables of the run before. A broken run leaves folders that no
manifest names; running it again writes new ones.

A table is a list of folders: ``replace`` gives it a new only folder, ``append``
adds one (facts, rejects), ``rewrite`` adds the partitions that it wrote and
takes out older folders of the same partitions (snapshot months, mart months).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from telco_mart.operators.export import _hadoop_fs, _write_text

MANIFESTS, LOAD = "_runs", "load"


def _read_all(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _hadoop_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


class RunStore:
    """The tables below one root folder, as of the last committed run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        names = [n for n in _children(spark, f"{self.root}/{MANIFESTS}") if n.startswith("run_")]
        self.number = int(names[-1][4:-5]) if names else 0
        content = json.loads(_read_all(spark, f"{self.root}/{MANIFESTS}/{names[-1]}")) if names else {}
        self.run_id: str | None = content.get("run")
        self.tables: dict[str, dict] = content.get("tables", {})

    def has(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str) -> DataFrame:
        """A table of this state; its folders, not their parents, are listed."""
        if name not in self.tables:
            raise FileNotFoundError(f"no committed table {name} under {self.root}")
        entry = self.tables[name]
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        if not entry["folders"]:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{name}/{f}" for f in entry["folders"]]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths).select(*schema.names)

    def folders(self, name: str) -> list[str]:
        return list(self.tables[name]["folders"]) if name in self.tables else []


class Run(RunStore):
    """A run in progress: reads see what it wrote itself, else the state that it
    started from."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.before = RunStore(spark, root)
        self.run_id = uuid.uuid4().hex[:16]
        self.load = f"{LOAD}={self.run_id}"

    def _write(self, name: str, df: DataFrame, partition_by: list[str], folder: str | None = None) -> None:
        writer = df.write.mode("error").option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.root}/{name}/{folder or self.load}")

    def _set(self, name: str, df: DataFrame, folders: list[str]) -> DataFrame:
        plain = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        self.tables = {**self.tables, name: {"schema": plain.json(), "folders": folders}}
        return self.read(name)

    def replace(self, name: str, df: DataFrame, partition_by: list[str] = ()) -> DataFrame:
        self._write(name, df, list(partition_by))
        return self._set(name, df, [self.load])

    def append(self, name: str, df: DataFrame, partition_by: list[str] = ()) -> DataFrame:
        """A run may append to a table more than once."""
        mine = [f for f in self.folders(name) if f.startswith(self.load)]
        folder = f"{self.load}-{len(mine)}"
        self._write(name, df, list(partition_by), folder)
        return self._set(name, df, [*self.before.folders(name), *mine, folder])

    def rewrite(self, name: str, df: DataFrame, partition_by: list[str], emptied: list[dict] = ()) -> DataFrame:
        """``emptied``: partitions (column -> value) that are replaced even if
        ``df`` has no row for them."""
        self._write(name, df, partition_by)
        found = [""]
        for _ in partition_by:
            found = [f"{f}/{c}" for f in found for c in _children(self.spark, f"{self.root}/{name}/{self.load}{f}") if "=" in c]
        gone = {*found, *("".join(f"/{c}={p[c]}" for c in partition_by) for p in emptied)}
        kept = [f for f in self.before.folders(name) if f"/{f.split('/', 1)[1]}" not in gone]
        return self._set(name, df, kept + [self.load + f for f in found])

    def _only(self, name: str, folders: list[str]) -> DataFrame:
        part = RunStore.__new__(RunStore)
        part.spark, part.root = self.spark, self.root
        part.tables = {name: {**self.tables[name], "folders": folders}}
        return part.read(name)

    def loaded(self, name: str) -> DataFrame:
        """Only the rows that this run has written to ``name``."""
        return self._only(name, [f for f in self.folders(name) if f.startswith(self.load)])

    def appended(self, name: str) -> DataFrame:
        """Only the rows of the last append to ``name``."""
        return self._only(name, self.folders(name)[-1:])

    def commit(self) -> int:
        """Make this run's tables the current ones. Fails if another run has
        committed since this one started."""
        folder, number = f"{self.root}/{MANIFESTS}", self.before.number + 1
        aside, final = f"{folder}/aside_{self.run_id}", f"{folder}/run_{number:08d}.json"
        _write_text(self.spark, aside, json.dumps({"run": self.run_id, "tables": self.tables}))
        fs, target, jvm = _hadoop_fs(self.spark, final)
        if fs.exists(target) or not fs.rename(jvm.org.apache.hadoop.fs.Path(aside), target):
            raise RuntimeError(f"another run has committed {final}")
        return number
