"""The k stations nearest to each place, by great-circle distance.

Places and stations are both trees of cubes over the unit sphere, and pairs of cubes are walked down together: the box of
a place cube against the box of a station cube bounds the distances of all places in one to all stations in the other, so
one bound serves a whole cube. Only place cubes that still have many candidates are split further, into halves along each
axis, so that a pair has few pairs of children. What is left is compared in one of two ways that give the same answer: places
and candidates as joined rows, or (``array``) the candidates of a cube as one array, which every place in it sorts in its own row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline import fixed_values as fv
from firnline.functions import measure
from firnline.operators.ranking import smallest_per_key
from firnline.session import stage

# Cube edges are 2 ** -level of the unit sphere's radius; the last is about 24 m.
LEVELS = tuple(range(4, 19))
# A place cube with at most this many candidate stations is not split further.
FEW_STATIONS = 256
# Slack for rounding when a cube is ruled out: relative, and as a squared chord length (0.2 m).
_RELATIVE, _SLACK = 1e-9, 1e-15

PLACE = ["Longitude", "latitude"]


def nearest_stations(
    places: DataFrame, stations: DataFrame, k: int = fv.NEAREST_STATIONS, method: str = "cubes"
) -> DataFrame:
    """Add ``stations``: an array of (distance_km, name, station_id, station_triplet), nearest
    first, equal distances in order of name then id.

    ``places`` holds distinct ``Longitude``, ``latitude``. ``method`` is ``cubes``, or ``array`` where no 24 m of ground
    hold more stations than fit in one row (thousands, not millions).

    Stage the result when it is read more than once, and unnest the array with an outer explode.
    """
    # Only the first k of the stations sharing a spot can be among the k nearest to anything.
    spots = smallest_per_key(
        stations.select(
            F.col("longitude").alias("s_lon"), F.col("latitude").alias("s_lat"),
            "name", "station_id", "station_triplet",
        ),
        ["s_lon", "s_lat"], ["name", "station_id"], k,
    ).select("*", *_on_sphere("s_lon", "s_lat"))
    here = places.select(*PLACE, *_on_sphere("Longitude", "latitude"))
    left, used = _candidate_cubes(here, spots, k)

    def at_levels(points: DataFrame, name: str) -> DataFrame:
        named = F.array(*[F.struct(F.lit(v).alias("level"), _cube(v).alias(name)) for v in used])
        return points.select("*", F.inline(named)).drop("x", "y", "z")

    # A place is in one settled cube, of whatever level.
    compare = _by_array if method == "array" else _by_rows
    found = places.join(compare(left, at_levels(here, "p_cube"), at_levels(spots, "s_cube"), k), PLACE, "left")
    return found.withColumn("stations", F.coalesce("stations", F.array())) if method == "array" else found


def _by_array(left: DataFrame, here: DataFrame, spots: DataFrame, k: int) -> DataFrame:
    """(Longitude, latitude, stations): a cube's candidates travel as one array, sorted in each place's own row."""
    packed = left.join(spots, ["level", "s_cube"]).groupBy("level", "p_cube").agg(
        F.collect_list(
            F.struct(
                F.radians("s_lon").alias("lon"),
                F.radians("s_lat").alias("lat"),
                "name", "station_id", "station_triplet",
            )
        ).alias("__all")
    )

    def by_distance(s: Column) -> Column:
        distance = measure.haversine_km_radians(
            F.col("__lon"), F.col("__lat"), s["lon"], s["lat"]
        )
        return F.struct(
            distance.alias("distance_km"),
            s["name"].alias("name"),
            s["station_id"].alias("station_id"),
            s["station_triplet"].alias("station_triplet"),
        )

    return (
        here.join(packed, ["level", "p_cube"])
        .withColumns({"__lon": F.radians("Longitude"), "__lat": F.radians("latitude")})
        .select(*PLACE, F.slice(F.sort_array(F.transform("__all", by_distance)), 1, k).alias("stations"))
    )


def _by_rows(left: DataFrame, here: DataFrame, spots: DataFrame, k: int) -> DataFrame:
    """(Longitude, latitude, stations): places and their candidates as joined rows."""
    candidates = (
        left.join(here, ["level", "p_cube"]).join(spots, ["level", "s_cube"])
        .withColumn(
            "distance_km",
            measure.haversine_km(
                F.col("Longitude"), F.col("latitude"), F.col("s_lon"), F.col("s_lat")
            ),
        )
        .select(*PLACE, "distance_km", "name", "station_id", "station_triplet")
    )
    best = smallest_per_key(candidates, PLACE, ["distance_km", "name", "station_id"], k)
    # At most k rows reach each list.
    return best.groupBy(*PLACE).agg(
        F.array_sort(
            F.collect_list(F.struct("distance_km", "name", "station_id", "station_triplet"))
        ).alias("stations")
    )


def _on_sphere(lon: str, lat: str) -> list[Column]:
    around, up = F.radians(lon), F.radians(lat)
    return [
        (F.cos(up) * F.cos(around)).alias("x"),
        (F.cos(up) * F.sin(around)).alias("y"),
        F.sin(up).alias("z"),
    ]


def _cube(level: int) -> Column:
    """Number of the cube a point lies in: 20 bits an axis."""
    index = [F.floor((F.col(axis) + 1.0) * float(2**level)).cast("long") for axis in "xyz"]
    return reduce(lambda key, i: F.shiftleft(key, 20).bitwiseOR(i), index)


def _candidate_cubes(here: DataFrame, spots: DataFrame, k: int) -> tuple[DataFrame, tuple[int, ...]]:
    """(level, p_cube, s_cube): for every place the station cubes to compare it with, under the one place cube it is settled in;
    and the levels there are. Walks pairs of (place cube, station cube) from level to level."""
    points = stage(here.select(F.lit("p_").alias("side"), "x", "y", "z").union(
        spots.select(F.lit("s_").alias("side"), "x", "y", "z")), "points")
    settled, open_pairs, above = [], None, None
    for level in LEVELS:
        # Every occupied cube of the level with the box of its points; levels that nothing needs are never made.
        cubes = stage(points.groupBy(
            "side", _cube(level).alias("cube"), (_cube(above) if above else F.lit(0).cast("long")).alias("parent")).agg(
                F.count("*").alias("n"),
                *[f(axis).alias(f"{name}{axis}") for axis in "xyz" for f, name in ((F.min, "lo"), (F.max, "hi"))]), "cubes")
        p, s = (cubes.filter(F.col("side") == side).select(*[F.col(c).alias(side + c) for c in cubes.columns if c != "side"])
                for side in ("p_", "s_"))
        if open_pairs is None:
            # The first level has a few thousand cubes at most (33 along an axis, on a sphere): they travel as one array.
            packed = s.agg(F.collect_list(F.struct(*s.columns))).scalar()
            pairs = p.select("*", F.inline(packed))
        else:
            # A pair of parents becomes the pairs of their children.
            pairs = open_pairs.join(p, "p_parent").join(s, "s_parent")
        judged = stage(_narrow(pairs, k), "cube-pairs")
        few = (F.col("held") <= FEW_STATIONS) if level != LEVELS[-1] else F.lit(True)
        settled.append(judged.filter(few).select(F.lit(level).alias("level"), "p_cube", "s_cube"))
        open_pairs = judged.filter(~few).select(F.col("p_cube").alias("p_parent"), F.col("s_cube").alias("s_parent"))
        above = level
        if level != LEVELS[-1] and open_pairs.isEmpty():
            break
    return reduce(DataFrame.unionByName, settled), LEVELS[:len(settled)]


def _narrow(pairs: DataFrame, k: int) -> DataFrame:
    """(p_cube, s_cube, held): of each place cube's station cubes, those that can hold one of the k nearest to any of its
    places; ``held`` is how many stations they hold together."""
    near, far = [], []
    for axis in "xyz":
        p_lo, p_hi, s_lo, s_hi = (F.col(f"{tag}_{end}{axis}") for tag in "ps" for end in ("lo", "hi"))
        apart = F.greatest(s_lo - p_hi, p_lo - s_hi, F.lit(0.0))
        reach = F.greatest(s_hi - p_lo, p_hi - s_lo)
        near.append(apart * apart)
        far.append(reach * reach)
    bounded = pairs.select("p_cube", "s_cube", "s_n", sum(near[1:], near[0]).alias("near"), sum(far[1:], far[0]).alias("far"))
    # The reach of the nearest cubes that hold k stations together bounds the k-th distance of every place.
    by_reach = W.partitionBy("p_cube").orderBy("far").rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy("p_cube")
    bound = F.min(F.when(F.col("upto") >= k, F.col("far"))).over(everything)
    return (
        bounded.withColumn("upto", F.sum("s_n").over(by_reach)).withColumn("bound", bound)
        .filter(F.col("bound").isNull() | (F.col("near") <= F.col("bound") * (1 + _RELATIVE) + _SLACK))
        .select("p_cube", "s_cube", F.sum("s_n").over(everything).alias("held"))
    )


def with_station_lists(df: DataFrame) -> DataFrame:
    """Replace the station array by two comma-separated texts, nearest first."""
    from firnline.functions.text import fixed

    return df.withColumns(
        {
            "nearest_stations": F.concat_ws(
                ",", F.transform("stations", lambda s: s["station_triplet"])
            ),
            "nearest_distances": F.concat_ws(
                ",", F.transform("stations", lambda s: fixed(s["distance_km"], 1))
            ),
        }
    ).drop("stations")
