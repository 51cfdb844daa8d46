"""The structure registry: selected rows, derived columns, processing tiles and their area."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataflux.functions.expr import METRES_PER_DEGREE, class_label

# Fixed names of the registry's columns.
COLUMNS = {
    "name": "교량명", "class_code": "시설물종별등급구분", "province": "시도명", "district": "시군구명", "lat1": "교량시작점위도", "lon1": "교량시작점경도", "lat2": "교량종료점위도",
    "lon2": "교량종료점경도", "length": "교량연장", "width": "교량폭", "height": "교량높이", "kind": "상부구조형식", "year": "교량준공연도", "inspected": "최종안전점검일자",
    "grade": "최종안전점검결과", "road": "도로종류", "route": "도로노선명", "load": "설계활하중", "organisation": "관리기관명", "phone": "관리기관전화번호",
}
NUMBERS = ("lat1", "lon1", "lat2", "lon2", "length", "width", "height")


def structures(raw: DataFrame, province: str | None = None, districts: list[str] | str | None = None, least_length: float = 0.0, ordinal: str = "ordinal") -> DataFrame:
    """Structures of a province (a pattern) and districts, from rows with the registry's own column names and their ordinal.

    A missing end is the start; a missing length is 0; a missing text stays null. Rows without a start have no place and go.
    """
    df = raw.select(F.col(ordinal).alias("ordinal"), *(F.col(f"`{c}`").alias(k) for k, c in COLUMNS.items() if c in raw.columns))
    df = df.withColumns({k: F.expr(f"try_cast({k} AS double)") for k in NUMBERS if k in df.columns} | {k: F.expr(f"try_cast(try_cast({k} AS double) AS int)") for k in ("class_code", "year") if k in df.columns})
    if province:
        df = df.where(F.col("province").rlike(province))
    if districts:
        df = df.where(F.col("district").isin([districts] if isinstance(districts, str) else list(districts)))
    df = df.where(F.col("lat1").isNotNull() & F.col("lon1").isNotNull())
    no_end = F.col("lat2").isNull() | F.col("lon2").isNull()
    df = df.withColumns({"lat2": F.when(no_end, F.col("lat1")).otherwise(F.col("lat2")), "lon2": F.when(no_end, F.col("lon1")).otherwise(F.col("lon2")), "length": F.coalesce("length", F.lit(0.0))})
    out = df.where(F.col("length") >= least_length)
    return out.withColumns(
        {
            "id": F.format_string("r%05d", F.col("ordinal").cast("int")),
            "stable_id": F.hex(F.xxhash64("name", "lat1", "lon1")),
            "lat": F.round((F.col("lat1") + F.col("lat2")) / 2, 6),
            "lon": F.round((F.col("lon1") + F.col("lon2")) / 2, 6),
            "class": class_label(F.col("class_code")),
        }
    )


def tiles(structures: DataFrame, size_m: float = 1500.0, margin_m: float = 300.0, least_half_m: float = 800.0) -> tuple[DataFrame, DataFrame]:
    """(tiles with their window, structure to tile). Cells are squares of the projection at the mean latitude of all structures."""
    mean = structures.agg(F.avg("lat").alias("_lat0"))
    scale = F.cos(F.radians("_lat0")) * METRES_PER_DEGREE
    df = structures.crossJoin(F.broadcast(mean))  # one row
    df = df.withColumns({"cx": F.floor((F.col("lon") - 120) * scale / size_m), "cy": F.floor((F.col("lat") - 30) * METRES_PER_DEGREE / size_m), "_ke": scale})
    df = df.withColumn("tile", F.format_string("t%d_%d", F.col("cx"), F.col("cy")))
    box = df.groupBy("tile").agg(
        F.count("*").alias("n_structures"), F.first("_ke").alias("_ke"),
        F.min(F.least("lat1", "lat2")).alias("_s"), F.max(F.greatest("lat1", "lat2")).alias("_n"), F.min(F.least("lon1", "lon2")).alias("_w"), F.max(F.greatest("lon1", "lon2")).alias("_e"),
    )
    clat, clon = (F.col("_s") + F.col("_n")) / 2, (F.col("_w") + F.col("_e")) / 2
    half_y = F.greatest((F.col("_n") - F.col("_s")) / 2 * METRES_PER_DEGREE + margin_m, F.lit(least_half_m)) / METRES_PER_DEGREE
    half_x = F.greatest((F.col("_e") - F.col("_w")) / 2 * F.col("_ke") + margin_m, F.lit(least_half_m)) / F.col("_ke")
    box = box.select("tile", "n_structures", clat.alias("clat"), clon.alias("clon"), (clat - half_y).alias("S"), (clat + half_y).alias("N"), (clon - half_x).alias("W"), (clon + half_x).alias("E"))
    return box, df.select("id", "tile")


def area(tiles: DataFrame, pad_deg: float = 0.01) -> DataFrame:
    """The area of interest as padded boxes; a place is inside if any box holds it."""
    return tiles.select("tile", (F.col("S") - pad_deg).alias("S"), (F.col("N") + pad_deg).alias("N"), (F.col("W") - pad_deg).alias("W"), (F.col("E") + pad_deg).alias("E"))
