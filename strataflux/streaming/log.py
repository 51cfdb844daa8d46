"""A keyed history as a log of runs that are merged in levels.

A batch appends one run, which holds the last version of each of its keys. When a level has ``fan`` runs they become one run of the next level, so
a table of n batches has about fan * log(n) runs, and a read meets each key once in each of these instead of in every batch. Runs are
dealt into folders by a hash of the key: a lookup of a key opens one folder in each run.

What counts is a state file: it names the runs that are live and the last batch that is in them. It is written beside and put in place by a rename, so
a writer that dies leaves the state before, and the same batch can be appended again. One writer at a time. Folders without a
state's word are left over from writers that died; :meth:`KeyedLog.vacuum` deletes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType


class Files:
    """The few file operations of a commit, on the file system of a path."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.spark, self.root = spark, root.rstrip("/")

    def list(self, folder: str = "") -> list[str]:
        p = self.path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> dict:
        stream = self.fs.open(self.path(f"{self.root}/{name}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, name: str, content: dict) -> None:
        """A new file, whole or not at all; fails if there is one."""
        temporary, final = self.path(f"{self.root}/.{uuid.uuid4().hex}"), self.path(f"{self.root}/{name}")
        stream = self.fs.create(temporary, True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if self.fs.exists(final) or not self.fs.rename(temporary, final):
            self.fs.delete(temporary, False)
            raise FileExistsError(name)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(f"{self.root}/{name}"), True)


def last_versions(rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row of the last version of each key, of equal versions the one with the largest other values: sums on both sides of one shuffle, no key is gathered."""
    rest = [c for c in rows.columns if c not in keys and c != version]
    out = rows.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias("_m"))
    return out.select(*(F.col(c) if c in keys else F.col(f"_m.{c}").alias(c) for c in rows.columns))


class KeyedLog:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], version: str, schema: StructType, buckets: int = 16, fan: int = 4):
        self.spark, self.path, self.keys, self.version, self.schema, self.buckets, self.fan = spark, path.rstrip("/"), keys, version, schema, buckets, fan
        self.files = Files(spark, self.path)

    def state(self) -> dict:
        """The last state: its number, live runs (name and level) and the last batch in them."""
        found = [int(n[6:-5]) for n in self.files.list() if n.startswith("state-")]
        return self.files.read(f"state-{max(found)}.json") if found else {"number": 0, "runs": [], "batch": -1}

    def _commit(self, old: dict, runs: list[dict], batch: int) -> None:
        self.files.put(f"state-{old['number'] + 1}.json", {"number": old["number"] + 1, "runs": runs, "batch": batch})

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.withColumn("bucket", self._bucket()).repartition("bucket").sortWithinPartitions("bucket", *self.keys).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}")

    def _runs(self, runs: Iterable[dict]) -> DataFrame:
        out = None
        for r in runs:
            df = self.spark.read.schema(f"{self.schema.toDDL()}, bucket int").parquet(f"{self.path}/{r['name']}")
            out = df if out is None else out.unionByName(df)
        return out if out is not None else self.spark.createDataFrame([], self.schema).withColumn("bucket", F.lit(0))

    def append(self, rows: DataFrame, batch: int) -> bool:
        """Append a batch; one that is in the log already changes nothing. Then merge what is due."""
        state = self.state()
        if batch <= state["batch"]:
            return False
        name = f"run-{batch}-0"
        self._write(last_versions(rows.select(*self.schema.fieldNames()), self.keys, self.version), name)
        self._commit(state, [*state["runs"], {"name": name, "level": 0}], batch)
        self.compact()
        return True

    def compact(self) -> None:
        """Merge the runs of each level that has ``fan`` of them or more, lowest first."""
        while True:
            state = self.state()
            levels = sorted({r["level"] for r in state["runs"]})
            due = next((n for n in levels if sum(r["level"] == n for r in state["runs"]) >= self.fan), None)
            if due is None:
                return
            old = [r for r in state["runs"] if r["level"] == due]
            name = f"run-{state['batch']}-{due + 1}"
            self._write(last_versions(self._runs(old).drop("bucket"), self.keys, self.version), name)
            self._commit(state, [r for r in state["runs"] if r["level"] != due] + [{"name": name, "level": due + 1}], state["batch"])

    def read(self) -> DataFrame:
        """The last version of every key."""
        return last_versions(self._runs(self.state()["runs"]).drop("bucket"), self.keys, self.version)

    def lookup(self, **key: object) -> DataFrame:
        """The last version of one key, from one folder of each run."""
        one = self.spark.createDataFrame([Row(**{k: key[k] for k in self.keys})], StructType([self.schema[k] for k in self.keys]))
        bucket = one.select(self._bucket().alias("b")).head()["b"]
        rows = self._runs(self.state()["runs"]).where(F.col("bucket") == bucket)
        for k in self.keys:
            rows = rows.where(F.col(k).eqNullSafe(F.lit(key[k]).cast(self.schema[k].dataType)))
        return last_versions(rows.drop("bucket"), self.keys, self.version)

    def vacuum(self) -> list[str]:
        """Delete runs that are not live, and states before the last; gives their names. Readers of older states must be done."""
        state = self.state()
        live = {r["name"] for r in state["runs"]} | {f"state-{state['number']}.json"}
        gone = [n for n in self.files.list() if n not in live and (n.startswith(("run-", "state-", ".")))]
        for n in gone:
            self.files.delete(n)
        return gone
