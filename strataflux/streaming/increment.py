"""A cycle over landed observations as one transaction over its tables.

A cycle takes what has landed since the last one, replaces the series of the (track, tile) that really change, judges only these anew, puts the
best results of all tiles into the history, and compares them with the cycle before. All of it lies in folders of the cycle's own number; a single
commit file, put in place by a rename, makes it count. A cycle that dies at any point leaves the state before, and runs again with the
same files and number. Files that bring nothing new write nothing. What landed is read once, and meets the rows before in one shuffle; what a
cycle keeps of this for itself lies in ``work`` and goes with its end.

Tables under the root: ``series`` and ``results`` (by batch, track, tile), ``tiles`` (track, tile and the batch that holds their rows), ``judgements``
and ``alerts`` (by batch). Results must have bridge and level; a date that comes again counts by its version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strataflux.session import staged
from strataflux.streaming.cycle import run_cycle
from strataflux.streaming.log import Files, last_versions

TILE = ["track", "tile"]
#: Tiles up to which a list of them is sent to every task; longer ones are shuffled.
TILES = 100_000


class Increments:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        observations: str,
        keys: list[str],
        version: str,
        results: str,
        judge: Callable[[DataFrame], DataFrame],
        best: Callable[[DataFrame], DataFrame],
        alerts: Callable[[DataFrame, DataFrame], DataFrame],
    ):
        """``observations`` and ``results`` are schemas; ``judge`` makes results of whole series, ``best`` one row a bridge of all results, ``alerts`` rows of judgements and those of the cycle before."""
        self.spark, self.root, self.keys, self.version = spark, root.rstrip("/"), keys, version
        self.observations, self.results_schema = StructType.fromDDL(observations), StructType.fromDDL(results)
        self.judge, self.best, self.alerts = judge, best, alerts
        self.files = Files(spark, self.root)
        self.reached: Callable[[str], None] = lambda step: None

    def commits(self) -> list[int]:
        return sorted(int(n[7:-5]) for n in self.files.list() if n.startswith("commit-"))

    def _tiles(self, batch: int | None) -> DataFrame:
        """track, tile and the batch of their rows, as of a commit."""
        schema = "track string, tile string, batch int"
        return self.spark.createDataFrame([], schema) if batch is None else self.spark.read.schema(schema).parquet(f"{self.root}/tiles/of={batch}")

    def _table(self, name: str, schema: StructType, tiles: DataFrame) -> DataFrame:
        """The rows that the tiles' batches hold: only these batches' folders are read, and of them only the tiles'."""
        batches = [r["batch"] for r in tiles.select("batch").distinct().collect()]  # a row for each cycle that is still of use
        if not batches:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{name}/batch={b}" for b in batches]
        rows = self.spark.read.schema(StructType([*schema.fields, StructField("batch", IntegerType())])).option("basePath", f"{self.root}/{name}").parquet(*paths)
        return rows.join(F.broadcast(tiles) if tiles.count() < TILES else tiles, [*TILE, "batch"], "left_semi").select(*schema.fieldNames())

    def _write(self, step: str, df: DataFrame, path: str, *by: str) -> None:
        self.reached(step)
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{self.root}/{path}")

    def _work(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` as a table of this cycle's own, which several steps read."""
        path = f"{self.root}/work/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _merged(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """The last versions of old and new rows; ``_fresh`` where the new row is later. Each key has two rows at most, so one shuffle deals them evenly."""
        rest = [c for c in self.observations.fieldNames() if c not in self.keys and c != self.version]
        both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True))).repartition(*self.keys)
        known, arrived = (F.max(F.when(F.col("_new") == n, F.col(self.version))) for n in (False, True))
        out = both.groupBy(*self.keys).agg(F.max(F.struct(self.version, *rest)).alias("_m"), (F.bool_or("_new") & (known.isNull() | (arrived > known))).alias("_fresh"))
        return out.select(*(F.col(c) if c in self.keys else F.col(f"_m.{c}").alias(c) for c in self.observations.fieldNames()), "_fresh")

    def step(self, landed: DataFrame, batch: int) -> None:
        """One cycle; a number that is committed already does nothing."""
        try:
            self._step(landed, batch)
        finally:
            self.files.delete("work")

    def _step(self, landed: DataFrame, batch: int) -> None:
        done = self.commits()
        if done and batch <= done[-1]:
            return
        last = done[-1] if done else None
        tiles = self._tiles(last)
        new = self._work("new", last_versions(landed.select(*self.observations.fieldNames()), self.keys, self.version))
        met = new.select(*TILE).distinct()
        merged = self._work("merged", self._merged(self._table("series", self.observations, tiles.join(met, TILE, "left_semi")), new))
        of = staged(merged.where("_fresh").select(*TILE).distinct())  # the tiles of the cycle
        changed = of.count()
        if not changed:
            return
        of = F.broadcast(of) if changed < TILES else of
        whole = merged.drop("_fresh").join(of, TILE, "left_semi")
        self._write("series", whole.repartition(*TILE).sortWithinPartitions(*self.keys), f"series/batch={batch}", *TILE)
        now = of.withColumn("batch", F.lit(batch))
        self._write("results", self.judge(self._table("series", self.observations, now)).select(*self.results_schema.fieldNames()), f"results/batch={batch}", *TILE)
        self._write("tiles", tiles.join(of, TILE, "left_anti").unionByName(now), f"tiles/of={batch}")
        self._write("judgements", self.best(self._table("results", self.results_schema, self._tiles(batch))), f"judgements/of={batch}")
        self._write("alerts", self.alerts(self.judgements(batch), self.judgements(last) if done else self.judgements(batch).limit(0)), f"alerts/of={batch}")
        self.reached("commit")
        self.files.put(f"commit-{batch}.json", {"batch": batch, "tiles": changed})
        self.reached("end")

    def run(self, landed: DataFrame) -> None:
        """All that has landed in a stream since the last run, then stop."""
        run_cycle(landed, self.step, f"{self.root}/checkpoint")

    def series(self) -> DataFrame:
        done = self.commits()
        return self._table("series", self.observations, self._tiles(done[-1] if done else None))

    def results(self) -> DataFrame:
        done = self.commits()
        return self._table("results", self.results_schema, self._tiles(done[-1] if done else None))

    def judgements(self, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/judgements/of={batch}")

    def latest_alerts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/alerts/of={self.commits()[-1]}")

    def vacuum(self) -> list[str]:
        """Delete the folders of cycles that hold no tile's rows any more, and of cycles that died. Readers of older cycles must be done."""
        done = self.commits()
        if not done:
            return []
        live = {f"batch={r['batch']}" for r in self._tiles(done[-1]).select("batch").distinct().collect()}
        kept = {f"of={b}" for b in done}
        gone = [f"{t}/{n}" for t in ("series", "results") for n in self.files.list(t) if n.startswith("batch=") and n not in live]
        gone += [f"tiles/{n}" for n in self.files.list("tiles") if n.startswith("of=") and n != f"of={done[-1]}"]
        gone += [f"{t}/{n}" for t in ("judgements", "alerts") for n in self.files.list(t) if n.startswith("of=") and n not in kept]
        for n in gone:
            self.files.delete(n)
        return gone
