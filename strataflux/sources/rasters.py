"""Flat binary rasters as a data source: byte ranges of a file are read by many tasks, and ordered rows are written by many.

Reading (``format("flat_raster")``): a file of ``width`` values a row and ``bands`` bands, interleaved by pixel, line or band, is dealt into
ranges of whole rows; a task seeks to its range and reads no other byte. Rows are (file, band, row, re, im), im null for real types.

Writing: rows in order of their keys (:func:`write_ordered`) become one file a task, of its values end to end. The commit names the files in
order in a manifest, with the offsets that follow from their sizes; read in this order they are byte by byte what one writer would have
written. Files that no manifest names do not count, and a job that fails leaves none. A column ``part_of`` makes a raster of its own for each of its values.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "file string, band int, row long, re array<double>, im array<double>"
#: Types that the XML beside a raster names; fixed values of that format.
DTYPES = {"BYTE": "u1", "SHORT": "<i2", "INT": "<i4", "FLOAT": "<f4", "DOUBLE": "<f8", "CFLOAT": "<c8"}
#: Incidence in degrees where a raster of another size says nothing.
INCIDENCE = 39.0
SPLIT = 32 << 20


@dataclass
class Rows(InputPartition):
    """Rows of one band, or of all bands where these are interleaved, and the pieces of files that hold them."""

    file: str
    band: int | None
    first: int
    count: int
    pieces: list[tuple[str, int, int]]


@dataclass
class Part(WriterCommitMessage):
    number: int
    files: list[tuple[str, str, int]]


def _pieces(parts: list[tuple[str, int]], start: int, size: int) -> list[tuple[str, int, int]]:
    """Where bytes from ``start`` on lie in files that follow each other: path, offset and count."""
    out, at = [], 0
    for path, n in parts:
        lo, hi = max(start, at), min(start + size, at + n)
        if lo < hi:
            out.append((path, lo - at, hi - lo))
        at += n
    return out


class RasterReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.width, self.dtype = options["path"], int(options["width"]), np.dtype(options.get("dtype", "<f4"))
        self.bands, self.interleave, self.split = int(options.get("bands", 1)), options.get("interleave", "pixel"), int(options.get("splitbytes", SPLIT))
        if self.interleave not in ("pixel", "line", "band"):
            raise ValueError("interleave is pixel, line or band")

    def _rasters(self) -> list[tuple[str, list[tuple[str, int]]]]:
        """Names of rasters and the files, with sizes, that they are made of."""
        fs, root = arrow_fs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        if info.type == arrow_fs.FileType.File:
            return [(root, [(root, info.size)])]
        infos = fs.get_file_info(arrow_fs.FileSelector(root))
        manifests = [i.path for i in infos if re.fullmatch(r"_raster-\w+\.json", i.base_name)]
        if not manifests:
            return [(i.path, [(i.path, i.size)]) for i in sorted(infos, key=lambda i: i.path) if i.is_file and not i.base_name.startswith(("_", "."))]
        out: dict[str, list[tuple[str, int]]] = {}
        for m in manifests:
            for of, name, size in json.loads(fs.open_input_stream(m).read())["parts"]:
                out.setdefault(of, []).append((f"{root}/{name}", size))
        return [(f"{root}/{of}" if of else root, parts) for of, parts in sorted(out.items())]

    def partitions(self) -> list[InputPartition]:
        out = []
        for name, parts in self._rasters():
            total, line = sum(n for _, n in parts), self.width * self.dtype.itemsize * (1 if self.interleave == "band" else self.bands)
            whole = self.width * self.dtype.itemsize * self.bands
            if total % whole:
                raise ValueError(f"{name} holds no whole rows of {self.width} values")
            length, step = total // whole, max(1, self.split // line)
            for band in range(self.bands) if self.interleave == "band" else [None]:
                base = (band or 0) * length * line
                out += [Rows(name, band, k, min(step, length - k), _pieces(parts, base + k * line, min(step, length - k) * line)) for k in range(0, length, step)]
        return out or [Rows("", None, 0, 0, [])]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        fs, _ = arrow_fs.FileSystem.from_uri(self.path)
        data = b""
        for path, offset, size in partition.pieces:
            with fs.open_input_file(path) as f:
                data += f.read_at(size, offset)
        values = np.frombuffer(data, self.dtype)
        bands = 1 if partition.band is not None else self.bands
        cube = values.reshape(partition.count, self.width, bands) if self.interleave == "pixel" else values.reshape(partition.count, bands, self.width).transpose(0, 2, 1)
        for b in range(bands):
            for lo in range(0, partition.count, 256):
                part = cube[lo : lo + 256, :, b]
                rows = np.arange(partition.first + lo, partition.first + lo + len(part))
                im = [x.imag.astype(float) for x in part] if part.dtype.kind == "c" else [None] * len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.file] * len(part)), pa.array([b if partition.band is None else partition.band] * len(part), pa.int32()), pa.array(rows), pa.array([x.real.astype(float) for x in part], pa.list_(pa.float64())), pa.array(im, pa.list_(pa.float64()))],
                    names=["file", "band", "row", "re", "im"],
                )


class RasterWriter(DataSourceArrowWriter):
    """Rows have re, for complex types im, and may have part_of."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.dtype = options["path"], np.dtype(options.get("dtype", "<f4"))
        fs, root = arrow_fs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        self.job = uuid.uuid4().hex
        self.old = [i.path for i in fs.get_file_info(arrow_fs.FileSelector(root)) if i.is_file and i.base_name.startswith(("_raster-", "_part-"))] if overwrite else []

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = arrow_fs.FileSystem.from_uri(self.path)
        number, files, out, of = TaskContext.get().partitionId(), [], None, None
        try:
            for b in batches:
                names = b.schema.names
                owners = b.column("part_of").to_pylist() if "part_of" in names else [""] * b.num_rows
                re_, im = b.column("re"), b.column("im") if "im" in names and self.dtype.kind == "c" else None
                for k, owner in enumerate(owners):
                    if out is None or owner != of:
                        if out:
                            out.close()
                        of = owner
                        files.append([of, f"_part-{self.job}-{number}-{uuid.uuid4().hex}", 0])
                        out = fs.open_output_stream(f"{root}/{files[-1][1]}", compression=None)
                    x = re_[k].values.to_numpy(zero_copy_only=False)
                    if im is not None:
                        x = x + 1j * im[k].values.to_numpy(zero_copy_only=False)
                    data = x.astype(self.dtype).tobytes()
                    files[-1][2] += len(data)
                    out.write(data)
        finally:
            if out:
                out.close()
        return Part(number, [tuple(f) for f in files])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = arrow_fs.FileSystem.from_uri(self.path)
        parts = [f for m in sorted((m for m in messages if m), key=lambda m: m.number) for f in m.files]
        with fs.open_output_stream(f"{root}/_raster-{self.job}.json", compression=None) as f:
            f.write(json.dumps({"parts": parts}).encode())
        for p in self.old:
            fs.delete_file(p)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Tasks that failed wrote files too: all of this job go. What a task that is still being killed writes later has no manifest, and is never read."""
        fs, root = arrow_fs.FileSystem.from_uri(self.path)
        for i in fs.get_file_info(arrow_fs.FileSelector(root)):
            if i.base_name.startswith(f"_part-{self.job}-"):
                fs.delete_file(i.path)


class RasterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "flat_raster"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return RasterReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return RasterWriter(self.options, overwrite)


def read_raster(spark: SparkSession, path: str, width: int, dtype: str = "<f4", bands: int = 1, interleave: str = "pixel", split: int = SPLIT) -> DataFrame:
    """file, band, row, re and im of a raster, of all rasters of a folder, or of what :func:`write_ordered` wrote."""
    spark.dataSource.register(RasterSource)
    options = {"width": width, "dtype": dtype, "bands": bands, "interleave": interleave, "splitbytes": split}
    return spark.read.format("flat_raster").options(**{k: str(v) for k, v in options.items()}).load(path)


def write_ordered(rows: DataFrame, keys: list[str], path: str, dtype: str = "<f4") -> None:
    """Write rows (re and, for complex types, im: arrays; part_of) in order of ``keys``, within each value of part_of."""
    rows.sparkSession.dataSource.register(RasterSource)
    by = (["part_of"] if "part_of" in rows.columns else []) + keys
    kept = [c for c in ("part_of", "re", "im") if c in rows.columns]
    ordered = rows.select(*by, *(c for c in kept if c not in by)).repartitionByRange(*by).sortWithinPartitions(*by)
    ordered.select(*kept).write.format("flat_raster").option("dtype", dtype).mode("overwrite").save(path)


def layout(properties: DataFrame) -> DataFrame:
    """file, width, length, dtype and bands of rasters from what their XML states (file, name, value); a missing type is FLOAT, a missing count of bands 1."""
    of = lambda n: F.max(F.when(F.col("name") == n, F.col("value")))
    types = F.create_map(*(F.lit(x) for kv in DTYPES.items() for x in kv))
    out = properties.groupBy("file").agg(*(of(n).alias(n) for n in ("width", "length", "data_type", "number_bands")))
    number = lambda c, d: F.coalesce(F.col(c).try_cast("int"), F.lit(d))
    return out.select("file", number("width", 0).alias("width"), number("length", 0).alias("length"), types[F.upper(F.coalesce("data_type", F.lit("FLOAT")))].alias("dtype"), number("number_bands", 1).alias("bands"))


def incidence(spark: SparkSession, path: str, width: int, length: int, dtype: str | None = None, split: int = SPLIT) -> DataFrame:
    """row and re (degrees) of an incidence raster, whose layout its size tells.

    Two bands of 4 bytes are interleaved by pixel or by band, whichever has more incidences between 10 and 70 degrees (by pixel if equal). One band of
    8 bytes has the same size, so it must be told by ``dtype`` "<f8" (the XML's DOUBLE). Of any other size, every value is :data:`INCIDENCE`.
    """
    fs, root = arrow_fs.FileSystem.from_uri(path)
    size = fs.get_file_info(root).size
    if size == width * length * 8 and dtype == "<f8":
        return read_raster(spark, path, width, "<f8", split=split).select("row", "re")
    if size == width * length * 8:
        plausible = F.aggregate("re", F.lit(0).cast("long"), lambda n, x: n + F.when((x > 10) & (x < 70), 1).otherwise(0))
        forms = {k: read_raster(spark, path, width, "<f4", 2, k, split).where("band = 0") for k in ("pixel", "band")}
        good = {k: df.agg(F.coalesce(F.sum(plausible), F.lit(0))).head()[0] for k, df in forms.items()}
        return forms["pixel" if good["pixel"] >= good["band"] else "band"].select("row", "re")
    return spark.range(length).select(F.col("id").alias("row"), F.array_repeat(F.lit(INCIDENCE), width).alias("re"))


def numbered(df: DataFrame, keys: list[str], name: str = "id") -> DataFrame:
    """Add ``name``, the place from 1 of a row in order of ``keys``: ranges are counted and number their own rows, no task sees all.

    The rows are stored in their ranges first: bounds are drawn from a sample, and another run of the same plan may draw others.
    """
    from strataflux.session import staged

    own = staged(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_mid", 33)
    counts = own.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    counts = counts.select("_part", (before - F.col("_first") + 1).alias("_shift"))
    return own.withColumn("_part", part).join(F.broadcast(counts), "_part").withColumn(name, F.col("_mid") + F.col("_shift")).drop("_mid", "_part", "_shift")


def candidate_inputs(candidates: DataFrame, path: str) -> DataFrame:
    """Write the inputs of a persistent-scatterer run: places (text), longitude and latitude, heights, phases by date, dispersions (text), all in order of row and column; gives the numbered candidates.

    candidates: row, col, lon, lat, height, da, and arrays re and im of phases over the dates. The phase file has all candidates of the first date, then of the next.
    """
    c = numbered(candidates, ["row", "col"])
    lines = lambda text, name: c.orderBy("id").select(text.alias("value")).write.mode("overwrite").text(f"{path}/{name}")
    lines(F.concat_ws(" ", F.col("id").cast("string"), F.col("row").cast("string"), F.col("col").cast("string")), "pscands.1.ij")
    lines(F.format_string("%.6f", "da"), "pscands.1.da")
    write_ordered(c.select("id", F.array("lon", "lat").alias("re")), ["id"], f"{path}/pscands.1.ll")
    write_ordered(c.select("id", F.array("height").alias("re")), ["id"], f"{path}/pscands.1.hgt")
    each = c.select("id", F.posexplode(F.arrays_zip(F.col("re").alias("a"), F.col("im").alias("b"))).alias("date", "p")).select("id", "date", F.array("p.a").alias("re"), F.array("p.b").alias("im"))
    write_ordered(each, ["date", "id"], f"{path}/pscands.1.ph", "<c8")
    return c


def window_meta(dates: DataFrame, incidences: DataFrame, least: int = 60) -> DataFrame:
    """tile, n_dates, inc_mean (of positive values) and done: whether a window has dates enough to be worked on. dates: tile, date; incidences: tile, re."""
    n = dates.groupBy("tile").agg(F.count_distinct("date").alias("n_dates"))
    value = incidences.select("tile", F.explode("re").alias("x")).where("x > 0").groupBy("tile").agg(F.avg("x").alias("inc_mean"))
    return n.join(value, "tile", "left").withColumn("done", F.col("n_dates") >= least)
