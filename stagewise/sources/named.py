"""Named tables: create or replace, with an atomic commit, and resume behind the last finished one.

    <root>/<name>/data-<id>/            one folder a version, written by Spark's tasks
    <root>/<name>/commits/<number>      one small file a commit: version, run, schema, metrics

A version counts only once its commit file is there.  That file is created
without overwriting after the data are complete, so a reader sees the version
before or the version after, never half of one, and of two writers that replace
one table at once the later takes the next number.  A commit file that is not
readable yet (its writer died within it) counts as absent.

A run that failed is started again with its name: the tables that it had
committed are read, those after them are computed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T


class NamedTables:
    """Tables under ``root``, a folder that the driver and all executors share.

    ``run`` names the run; :meth:`frame` takes a table that this run has
    committed as it is.  Another run's table of the same name is replaced.
    """

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), run
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._text = jvm.org.apache.commons.io.IOUtils

    def _commits(self, name: str) -> list[tuple[int, str]]:
        """(number, path) of the commit files, the last one first."""
        folder = self._path(f"{self.root}/{name}/commits")
        if not self._fs.exists(folder):
            return []
        found = [s.getPath() for s in self._fs.listStatus(folder) if s.isFile() and s.getPath().getName().isdigit()]
        return sorted(((int(p.getName()), p.toString()) for p in found), reverse=True)

    def _commit(self, name: str) -> dict | None:
        """What the last readable commit file says."""
        for _, path in self._commits(name):
            stream = self._fs.open(self._path(path))
            try:
                return json.loads(self._text.toString(stream, "UTF-8"))
            except ValueError:
                continue
            finally:
                stream.close()
        return None

    def path(self, name: str) -> str | None:
        """The folder of the table's current version; None where there is none."""
        commit = self._commit(name)
        return commit and f"{self.root}/{name}/{commit['version']}"

    def read(self, name: str) -> DataFrame:
        commit = self._commit(name)
        if commit is None:
            raise LookupError(f"no table {name!r} in {self.root}")
        return self._read(name, commit)

    def _read(self, name: str, commit: dict) -> DataFrame:
        schema = T.StructType.fromJson(commit["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{commit['version']}")

    def metrics(self, name: str) -> dict:
        """What was observed while the current version was written."""
        return (self._commit(name) or {}).get("metrics", {})

    def replace(self, name: str, df: DataFrame, watch: Observation | None = None) -> DataFrame:
        """Write ``df`` as the table's new current version and read it.  ``watch``: an observation
        within ``df``, whose metrics are kept with the commit."""
        version = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{name}/{version}")
        commit = {"version": version, "run": self.run, "schema": json.loads(df.schema.json()),
                  "metrics": watch.get if watch is not None else {}}
        number = max([n for n, _ in self._commits(name)], default=0)
        while True:
            number += 1
            try:
                out = self._fs.create(self._path(f"{self.root}/{name}/commits/{number:08d}"), False)
                break
            except Exception as e:  # another writer took the number
                if "exist" not in str(e):
                    raise
        try:
            out.write(bytearray(json.dumps(commit).encode()))
        finally:
            out.close()
        return self._read(name, commit)

    def frame(self, name: str, build: Callable[[], DataFrame], watch: Observation | None = None) -> DataFrame:
        """The table as this run has committed it, else built, written and committed now."""
        commit = self._commit(name)
        if commit is not None and commit["run"] == self.run:
            return self._read(name, commit)
        return self.replace(name, build(), watch)
