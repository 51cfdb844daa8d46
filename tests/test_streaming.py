"""Streams against the batch forms, under late, repeated and interrupted batches."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from strataflux.operators import results
from strataflux.plans import monitoring
from strataflux.streaming import watch
from strataflux.streaming.increment import Increments
from strataflux.streaming.log import Files, KeyedLog


def landed(spark, path, batches, schema):
    """One file a batch, taken one by one."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/b{k:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{path}/in")


def collected(stream, path):
    out = []

    def keep(df, batch):
        out.extend(df.collect())

    stream.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start().awaitTermination()
    return out


LEVELS = "structure string, cycle long, level int, review boolean, version long"


def test_streamed_changes_equal_batch(spark, tmp_path):
    watch.store(spark)
    r = random.Random(1)
    rows = [(f"s{s}", c, r.randint(0, 3), r.random() < 0.2, c) for s in range(6) for c in range(1, 6) if r.random() < 0.85]
    late = r.sample(rows, 6)
    fixed = [(s, c, (lv + 1) % 4, v, n + 100) for s, c, lv, v, n in r.sample(rows, 4)]
    order = [x for x in rows if x not in late]
    batches = [order[: len(order) // 2], late + order[:3], order[len(order) // 2 :] + fixed, fixed + late]
    words = collected(watch.changes(landed(spark, tmp_path, batches, LEVELS)), tmp_path)
    got = watch.last_changes(spark.createDataFrame(words, "structure string, cycle long, level int, prev int, kind string, version long, prev_version long"))
    final = {}
    for x in sorted(rows + fixed, key=lambda x: x[4]):
        final[x[:2]] = x
    every = spark.createDataFrame(list(final.values()), LEVELS)
    want = results.previous(every, "structure", "cycle", "level").withColumn("kind", F.when(F.col("level") >= 2, results.alert_kind(F.col("level"), F.col("prev"), F.col("review"))))
    # A cycle is numbered on from the one before; every cycle has a structure here.
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_silent_tracks(spark, tmp_path):
    watch.store(spark)
    day = lambda k: datetime.datetime(2024, 1, 1, 5) + datetime.timedelta(days=k)
    batches = [[("a", day(0)), ("b", day(0)), ("c", day(2))], [("a", day(12)), ("b", day(12))], [("a", day(40)), ("c", day(39))], [("a", day(52)), ("c", day(51))], [("a", day(64)), ("c", day(40))], [("a", day(76))]]
    words = collected(watch.silences(landed(spark, tmp_path, batches, "track string, ts timestamp")), tmp_path)
    got = {x["track"]: (x["last_date"], x["stale"]) for x in watch.last_silences(spark.createDataFrame(words, "track string, last_date date, stale boolean")).collect()}
    assert got == {"a": (day(76).date(), False), "b": (day(12).date(), True), "c": (day(51).date(), True)}
    as_of = day(76)
    assert {t: v[1] for t, v in got.items()} == {t: (as_of.date() - v[0]).days > 24 for t, v in got.items()}


KEYED = "k int, d int, v double, version long"


@pytest.fixture
def log(spark, tmp_path):
    return KeyedLog(spark, f"{tmp_path}/log", ["k", "d"], "version", spark.createDataFrame([], KEYED).schema, buckets=4, fan=3)


def test_log_is_the_last_version_of_each_key(spark, log):
    r, want = random.Random(2), {}
    for batch in range(13):
        rows = [(r.randint(0, 9), r.randint(0, 3), float(batch), batch - (3 if r.random() < 0.3 else 0)) for _ in range(12)]
        for k, d, v, n in rows:
            if (k, d) not in want or (n, v) > want[k, d]:
                want[k, d] = (n, v)
        df = spark.createDataFrame(rows, KEYED)
        assert log.append(df, batch) and not log.append(df, batch)
        runs = log.state()["runs"]
        assert all(sum(x["level"] == n for x in runs) < 3 for n in range(4))
    assert {(x["k"], x["d"]): (x["version"], x["v"]) for x in log.read().collect()} == want
    assert len(log.state()["runs"]) == 3 and max(x["level"] for x in log.state()["runs"]) == 2  # 13 = 9 + 3 + 1
    k, d = next(iter(want))
    one = log.lookup(k=k, d=d)
    assert [(x["version"], x["v"]) for x in one.collect()] == [want[k, d]] and "bucket" in one._jdf.queryExecution().executedPlan().toString()
    assert log.vacuum() and {(x["k"], x["d"]): (x["version"], x["v"]) for x in log.read().collect()} == want


def test_dead_writers_leave_the_state_before(spark, log, monkeypatch):
    log.append(spark.createDataFrame([(1, 1, 1.0, 1)], KEYED), 0)
    monkeypatch.setattr(KeyedLog, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        log.append(spark.createDataFrame([(1, 1, 2.0, 2)], KEYED), 1)
    monkeypatch.undo()
    assert [x["v"] for x in log.read().collect()] == [1.0]
    assert log.append(spark.createDataFrame([(1, 1, 2.0, 2), (None, 1, 3.0, 1)], KEYED), 1)
    assert sorted(x["v"] for x in log.read().collect()) == [2.0, 3.0] and [x["v"] for x in log.lookup(k=None, d=1).collect()] == [3.0]


OBS = "track string, tile string, point int, date int, y double, version long"
RES = "track string, tile string, bridge int, level int, n int"


def monitor(spark, root, judged=None):
    def judge(series):
        if judged is not None:
            judged.append({tuple(r) for r in series.select("track", "tile").distinct().collect()})
        return series.groupBy("track", "tile", F.col("point").alias("bridge")).agg((F.sum("y") % 4).cast("int").alias("level"), F.count("*").cast("int").alias("n"))

    def best(rows):
        return rows.groupBy("bridge").agg(F.max(F.struct("n", "level", "track")).alias("m")).select("bridge", "m.level", "m.n", "m.track")

    def alerts(now, before):
        return now.where("level >= 2").join(before.select("bridge", F.col("level").alias("prev")), "bridge", "left").select("bridge", "level", "prev", results.alert_kind(F.col("level"), F.col("prev"), F.lit(False)).alias("kind"))

    return Increments(spark, root, OBS, ["track", "tile", "point", "date"], "version", RES, judge, best, alerts)


def tables(m):
    cols = {"series": m.series(), "results": m.results(), "judgements": m.judgements(m.commits()[-1]), "alerts": m.latest_alerts()}
    return {k: sorted(map(str, df.select(*sorted(df.columns)).collect())) for k, df in cols.items()}


def batches_of(seed):
    r = random.Random(seed)
    out = [[(f"k{r.randint(0, 1)}", f"t{r.randint(0, 3)}", r.randint(0, 4), r.randint(0, 6), float(r.randint(0, 9)), b * 1000 + k) for k in range(8 if b else 30)] for b in range(4)]
    return [out[0], out[1], out[1], [("k0", "t1", 1, 1, 5.0, 10**6)]]


def test_increments_equal_one_cycle_over_all(spark, tmp_path):
    judged = []
    m = monitor(spark, f"{tmp_path}/m", judged)
    batches = batches_of(3)
    m.run(landed(spark, tmp_path, batches, OBS))
    assert m.commits() == [0, 1, 3]  # the third brings nothing new
    for k, b in enumerate([batches[0], batches[1], batches[3]]):
        assert judged[k] <= {x[:2] for x in b}
    assert judged[-1] == {("k0", "t1")}
    once = monitor(spark, f"{tmp_path}/once")
    once.step(spark.createDataFrame([x for b in batches[:3] for x in b], OBS), 0)
    once.step(spark.createDataFrame(batches[3], OBS), 1)
    assert tables(m) == tables(once)
    before = tables(m)
    files = {t: m.files.list(t) for t in ("series", "results", "tiles", "judgements", "alerts", "")}
    m.run(spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in"))
    assert files == {t: m.files.list(t) for t in files}  # an idle cycle writes nothing
    assert m.vacuum() and tables(m) == before


@pytest.mark.parametrize("where", ["results", "commit", "end"])
def test_killed_cycles_run_again(spark, tmp_path, where):
    batches = batches_of(4)[:2]
    m = monitor(spark, f"{tmp_path}/m")
    m.step(spark.createDataFrame(batches[0], OBS), 0)
    clean = monitor(spark, f"{tmp_path}/clean")
    for k, b in enumerate(batches):
        clean.step(spark.createDataFrame(b, OBS), k)
    before = tables(m)

    def die(step):
        if step == where:
            raise RuntimeError("killed")

    m.reached = die
    with pytest.raises(RuntimeError):
        m.step(spark.createDataFrame(batches[1], OBS), 1)
    assert where == "end" or tables(m) == before
    again = monitor(spark, f"{tmp_path}/m")
    again.step(spark.createDataFrame(batches[1], OBS), 1)
    assert tables(again) == tables(clean)


def counted(df, seen):
    """``df``, which adds the rows that are read of it to an accumulator each time it is computed."""

    def count(parts):
        for p in parts:
            seen.add(len(p))
            yield p

    return df.mapInPandas(count, df.schema)


def test_a_cycle_reads_what_landed_once(spark, tmp_path):
    batches = batches_of(5)
    m, plain = monitor(spark, f"{tmp_path}/m"), monitor(spark, f"{tmp_path}/plain")
    for k, b in enumerate(batches):
        seen = spark.sparkContext.accumulator(0)
        df = spark.createDataFrame(b, OBS)
        m.step(counted(df, seen), k)
        plain.step(df, k)
        assert seen.value == len(b)
    assert tables(m) == tables(plain) and m.commits() == [0, 1, 3]
    assert "work" not in m.files.list()


def test_landing_reads_its_table_once(spark):
    seen = spark.sparkContext.accumulator(0)
    base = monitoring._landing(counted(spark.range(40).select("id", (F.col("id") * 2).alias("v")), seen), (F.col("id") % 4).cast("int"))
    assert seen.value == 40
    files = Files(spark, base)
    assert files.list() == ["in"] and files.list("in") == ["000", "001", "002", "003"]
    for k in range(4):
        assert sum(n.endswith(".parquet") for n in files.list(f"in/{k:03d}")) == 1
        assert sorted(map(tuple, spark.read.parquet(f"{base}/in/{k:03d}").collect())) == [(i, 2 * i) for i in range(40) if i % 4 == k]
