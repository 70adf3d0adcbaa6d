"""Nearest point of a table of points, for any number of rows and points.

Places are points of the unit sphere, where the straight distance rises with the great-circle
distance, so there are no poles and no date line. Space is cut into cubes, each level four
times finer in every direction. Pairs (cube of rows, cube of points) start at the cube that
holds everything and are refined level by level: a pair is kept while the least distance of
its cubes does not exceed the smallest greatest distance that its rows' cube has to any cube
of points. What is left out provably holds no nearest point. A cube of few points is refined
no further; once a cube of rows is left with such cubes only, its rows are compared with
the points in them.

Only cubes are paired, whose number does not grow with the rows of a place: no cross join, and
rows are joined with the candidates of their cube, dealt where a cube holds much of the table.
Equal points are one. Points that are equally far from a cube (a circle around it) are all
candidates of it. A row without a place, or any row if there are no points, gets NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.durable import durable, forget
from plumbline.functions.joins import attach
from plumbline.operators.features import haversine_km
from plumbline.schema import quoted, require_columns

#: Bits of a coordinate at the finest level, and bits added by a level.
FINEST, STEP = 20, 2
#: Points of a cube that is refined no further.
FEW_POINTS = 32
#: Room for rounding, as a squared distance on the unit sphere.
ROUNDING = 1e-12
AXES = ("x", "y", "z")


def _fine_cells(latitude: Column, longitude: Column) -> dict[str, Column]:
    """Coordinates on the unit sphere as whole numbers of FINEST bits."""
    lat, lon = F.radians(latitude), F.radians(longitude)
    unit = {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}
    most = F.lit((1 << FINEST) - 1).cast("long")
    return {
        axis: F.least(F.greatest(F.floor((c + 1.0) * float(1 << (FINEST - 1))).cast("long"), F.lit(0).cast("long")), most)
        for axis, c in unit.items()
    }


def _at(df: DataFrame, bits: int, name: str) -> DataFrame:
    """The cells with their cube at a level."""
    return df.withColumn("_bits", F.lit(bits)).withColumn(name, _packed("_bits")).drop("_bits")


def _packed(bits: str) -> Column:
    parts = [F.expr(f"shiftright({axis}, {FINEST} - {bits})") for axis in AXES]
    return parts[0] * F.lit(1 << (2 * FINEST)) + parts[1] * F.lit(1 << FINEST) + parts[2]


def _edges(cube: str, bits: Column) -> list[tuple[Column, Column]]:
    """Lower and upper side of a cube along each axis."""
    mask, side = F.lit((1 << FINEST) - 1).cast("long"), F.lit(2.0) / F.pow(F.lit(2.0), bits)
    found = []
    for shift in (2 * FINEST, FINEST, 0):
        place = F.shiftright(F.col(cube), shift).bitwiseAND(mask).cast("double")
        found.append((place * side - 1.0, (place + 1.0) * side - 1.0))
    return found


def _distances(row_bits: Column, point_bits: Column) -> tuple[Column, Column]:
    """Least and greatest squared distance of a cube of rows and a cube of points."""
    least, most = [], []
    for (a, b), (c, d) in zip(_edges("rows_cube", row_bits), _edges("points_cube", point_bits), strict=True):
        gap = F.greatest(a - d, c - b, F.lit(0.0))
        reach = F.greatest(b - c, d - a)
        least.append(gap * gap)
        most.append(reach * reach)
    return reduce(lambda p, q: p + q, least), reduce(lambda p, q: p + q, most)


def nearest_point(
    df: DataFrame,
    latitude: str,
    longitude: str,
    points: DataFrame,
    point_latitude: str = "latitude",
    point_longitude: str = "longitude",
    output: str = "nearest_distance_km",
) -> DataFrame:
    """The rows with the distance to the nearest of the points, which may be any number."""
    require_columns(df, [latitude, longitude], "nearest point")
    require_columns(points, [point_latitude, point_longitude], "points")
    lat, lon = quoted(latitude).cast("double"), quoted(longitude).cast("double")
    place = F.struct(quoted(point_latitude).cast("double").alias("lat"), quoted(point_longitude).cast("double").alias("lon"))
    spots = points.select(place.alias("p")).where("p.lat is not null and p.lon is not null and not isnan(p.lat) and not isnan(p.lon)")
    spots = durable(spots.distinct().withColumns(_fine_cells(F.col("p.lat"), F.col("p.lon"))))
    cells = df.where(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))
    cells = durable(cells.select(lat.alias("lat"), lon.alias("lon")).select(*[c.alias(a) for a, c in _fine_cells(F.col("lat"), F.col("lon")).items()]).distinct())

    finished = _candidates(cells, spots)
    made = finished.join(_leaf_points(spots, finished), ["point_bits", "points_cube"]).groupBy("row_bits", "rows_cube").agg(
        F.flatten(F.collect_list("held")).alias("_near")
    )
    made = durable(made)
    # Each fine cell of rows has one finished cube; the finest level that it may have is known.
    levels = [r[0] for r in made.select("row_bits").distinct().collect()]
    if not levels:
        return df.withColumn(output, F.lit(None).cast("double"))
    keyed = made.select(F.col("row_bits").alias("_level"), F.col("rows_cube").alias("_cube"), "_near")
    distance = F.array_min(F.transform("_near", lambda p: haversine_km(lat, lon, p["lat"], p["lon"])))
    mapped = None
    for bits in levels:
        here = _at(cells, bits, "_cube").join(
            made.where(F.col("row_bits") == bits).select(F.col("rows_cube").alias("_cube")), "_cube", "left_semi"
        )
        here = here.select(*AXES, "_cube", F.lit(bits).alias("_level"))
        mapped = here if mapped is None else mapped.unionByName(here)
    mapped = durable(mapped.select(*[F.col(a).alias(f"_{a}") for a in AXES], "_cube", "_level"))
    deal = [quoted(c) for c in df.columns]
    placed = df.withColumns({f"_{a}": c for a, c in _fine_cells(lat, lon).items()})
    placed = attach(placed, mapped, [f"_{a}" for a in AXES], deal, mapped.count())
    found = attach(placed, keyed, ["_cube", "_level"], deal, _points_held(made))
    here = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return found.withColumn(output, F.when(here, distance)).drop("_near", "_cube", "_level", *[f"_{a}" for a in AXES])


def _points_held(made: DataFrame) -> int:
    """Candidate points of all cubes, which is what a broadcast of them would hold."""
    return int(made.agg(F.sum(F.size("_near"))).first()[0] or 0)


def _candidates(cells: DataFrame, spots: DataFrame) -> DataFrame:
    """row_bits, rows_cube, point_bits, points_cube: cubes of few points that may hold the nearest point of a row."""
    spark = cells.sparkSession
    total = spots.count()
    schema = "rows_cube long, points_cube long, point_bits int, leaf boolean"
    first = [(0, 0, 0, total <= FEW_POINTS)] if total and not cells.isEmpty() else []
    pairs = spark.createDataFrame(first, schema)
    finished = spark.createDataFrame([], "row_bits int, rows_cube long, point_bits int, points_cube long")
    bits = 0
    while True:
        # A cube of rows is finished when all its cubes of points are leaves.
        open_ = pairs.where("not leaf").select("rows_cube").distinct()
        done = pairs.join(open_, "rows_cube", "left_anti")
        finished = finished.unionByName(done.select(F.lit(bits).alias("row_bits"), "rows_cube", "point_bits", "points_cube"))
        active = pairs.join(open_, "rows_cube", "left_semi")
        if bits >= FINEST or active.isEmpty():
            break
        below = bits + STEP
        row_children = _at(_at(cells, bits, "rows_cube"), below, "_child").select("rows_cube", "_child").distinct()
        active = active.join(row_children, "rows_cube").drop("rows_cube").withColumnRenamed("_child", "rows_cube")
        point_children = _at(_at(spots, bits, "points_cube"), below, "_child").groupBy("points_cube", "_child").agg(
            F.count(F.lit(1)).alias("_n")
        )
        finer = active.where("not leaf").join(point_children, "points_cube").select(
            "rows_cube", F.col("_child").alias("points_cube"), F.lit(below).alias("point_bits"),
            ((F.col("_n") <= FEW_POINTS) | F.lit(below >= FINEST)).alias("leaf"),
        )
        every = durable(active.where("leaf").unionByName(finer))
        least, most = _distances(F.lit(below), F.col("point_bits"))
        bound = every.withColumn("_most", most).groupBy("rows_cube").agg(F.min("_most").alias("_bound"))
        kept = every.join(bound, "rows_cube").where(least <= F.col("_bound") * (1 + ROUNDING) + ROUNDING).drop("_bound")
        pairs = durable(kept)
        forget(every)
        bits = below
    return durable(finished)


def _leaf_points(spots: DataFrame, finished: DataFrame) -> DataFrame:
    """point_bits, points_cube, held: the points of each leaf that is a candidate."""
    leaves = durable(finished.select("point_bits", "points_cube").distinct())
    found = None
    for bits in [r[0] for r in leaves.select("point_bits").distinct().collect()] or [0]:
        own = _at(spots, bits, "points_cube").select("points_cube", F.lit(bits).alias("point_bits"), "p")
        own = own.join(leaves, ["point_bits", "points_cube"]).groupBy("point_bits", "points_cube").agg(F.collect_list("p").alias("held"))
        found = own if found is None else found.unionByName(own)
    return found
