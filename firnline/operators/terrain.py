"""Elevation, slope and aspect of places from a grid of elevation cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline import fixed_values as fv
from firnline.functions import measure
from firnline.operators.nearest import PLACE

CELL = ["tile_row", "tile_col", "row", "col"]


@dataclass(frozen=True)
class Grid:
    """Where a grid lies: the outer corner of cell (0, 0) and the cell size in degrees.

    ``tile`` is the edge of the square of cells stored together.
    """

    x0: float
    dx: float
    y0: float
    dy: float
    tile: int = 256
    nodata: float = fv.GRID_NODATA

    def row(self, lat: Column) -> Column:
        return F.floor((self.y0 - lat) / self.dy).cast("int")

    def col(self, lon: Column) -> Column:
        return F.floor((lon - self.x0) / self.dx).cast("int")

    def tile_of(self, index: Column) -> Column:
        return F.floor(index / self.tile).cast("int")

    def centre_lat(self, row: Column) -> Column:
        return self.y0 - (row + 0.5) * self.dy

    def centre_lon(self, col: Column) -> Column:
        return self.x0 + (col + 0.5) * self.dx


def to_cell(places: DataFrame, grid: Grid, rows: Column, cols: Column) -> DataFrame:
    """Add ``row`` and ``col``; both null outside a grid of rows × cols cells."""
    row, col = grid.row(F.col("latitude")), grid.col(F.col("Longitude"))
    inside = (row >= 0) & (row < rows) & (col >= 0) & (col < cols)
    return places.withColumns({"row": F.when(inside, row), "col": F.when(inside, col)})


def elevation_of(value: Column, grid: Grid) -> Column:
    return F.when((value != grid.nodata) & (value >= fv.GRID_FLOOR) & ~F.isnan(value), value)


def tiled(cells: DataFrame, grid: Grid) -> DataFrame:
    """Add the tile columns a stored grid is partitioned by."""
    return cells.select(
        grid.tile_of(F.col("row")).alias("tile_row"),
        grid.tile_of(F.col("col")).alias("tile_col"),
        F.col("row").cast("int").alias("row"),
        F.col("col").cast("int").alias("col"),
        F.col("elevation").cast("double").alias("elevation"),
    )


def at_points(places: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    """Add the raw value of the cell each place lies in; null outside the grid."""
    cells = measure.nans_to_null(cells)
    located = places.withColumns(
        {"row": grid.row(F.col("latitude")), "col": grid.col(F.col("Longitude"))}
    ).withColumns(
        {"tile_row": grid.tile_of(F.col("row")), "tile_col": grid.tile_of(F.col("col"))}
    )
    return located.join(cells, CELL, "left").drop("tile_row", "tile_col")


def windows(wanted: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    """The 3×3 window of each distinct (row, col): its centre and both gradients.

    Gradients are the weighted differences before division by the cell size, which depends on the
    place and not on the cell. They are null unless all nine cells exist and hold a reading.
    """
    span = F.array(F.lit(-1), F.lit(0), F.lit(1))
    spread = (
        wanted.select(F.col("row").alias("at_row"), F.col("col").alias("at_col"))
        .withColumn("dr", F.explode(span))
        .withColumn("dc", F.explode(span))
        .withColumns({"row": F.col("at_row") + F.col("dr"), "col": F.col("at_col") + F.col("dc")})
        .withColumns(
            {"tile_row": grid.tile_of(F.col("row")), "tile_col": grid.tile_of(F.col("col"))}
        )
    )
    reading = (F.col("elevation") != grid.nodata) & ~F.isnan("elevation")

    def at(dr: int, dc: int) -> Column:
        here = (F.col("dr") == dr) & (F.col("dc") == dc)
        return F.max(F.when(here, F.col("elevation")))

    def edge(cells_of_edge: list[tuple[int, int]]) -> Column:
        """Horn's weights along one edge: corners once, the middle twice."""
        first, middle, last = cells_of_edge
        return at(*first) + 2.0 * at(*middle) + at(*last)

    east = edge([(-1, 1), (0, 1), (1, 1)]) - edge([(-1, -1), (0, -1), (1, -1)])
    south = edge([(1, -1), (1, 0), (1, 1)]) - edge([(-1, -1), (-1, 0), (-1, 1)])
    whole = F.count(F.when(reading, F.lit(1))) == 9
    return (
        spread.join(measure.nans_to_null(cells), CELL)
        .groupBy("at_row", "at_col")
        .agg(
            at(0, 0).alias("centre"),
            F.when(whole, east).alias("east"),
            F.when(whole, south).alias("south"),
        )
        .select(F.col("at_row").alias("row"), F.col("at_col").alias("col"),
                "centre", "east", "south")
    )


def dense(cells: DataFrame, grid: Grid) -> DataFrame:
    """Elevation, slope, aspect and its compass name of every cell, one row per cell of ``cells``.

    Each tile gets a margin of one cell from its neighbours (the halo): a cell on an edge is sent to the tiles beside it
    as well, an inner cell to its own only. One shuffle by tile then serves both passes of the stencil, first along the rows,
    then along the columns. Cell sizes are those at the middle of the row. (row, col) is unique.
    """
    def tiles(index: str) -> Column:
        return F.sequence(grid.tile_of(F.col(index) - 1), grid.tile_of(F.col(index) + 1))

    held = measure.nans_to_null(cells).select(
        F.explode(tiles("row")).alias("tile_row"), "row", "col", "elevation"
    ).select(
        "tile_row", F.explode(tiles("col")).alias("tile_col"), "row", "col", "elevation",
        F.when(F.col("elevation") != grid.nodata, F.col("elevation")).alias("z"),
    ).repartition("tile_row", "tile_col")
    along = W.partitionBy("tile_row", "tile_col", "row").orderBy("col")
    down = W.partitionBy("tile_row", "tile_col", "col").orderBy("row")

    def beside(order, at: str, name: str, step: int) -> Column:
        """The neighbour's value, null where there is no such cell."""
        return F.when(F.lag(at, -step).over(order) == F.col(at) + step, F.lag(name, -step).over(order))

    rows = held.withColumns({"west": beside(along, "col", "z", -1), "east": beside(along, "col", "z", 1)}).withColumns(
        {"across": F.col("east") - F.col("west"), "smooth": F.col("west") + 2.0 * F.col("z") + F.col("east")}
    )
    # All three rows have to be whole; ``smooth`` is null where one of its three cells has no reading.
    whole = F.col("smooth").isNotNull()
    east = beside(down, "row", "across", -1) + 2.0 * F.col("across") + beside(down, "row", "across", 1)
    south = beside(down, "row", "smooth", 1) - beside(down, "row", "smooth", -1)
    own = (F.col("tile_row") == grid.tile_of(F.col("row"))) & (F.col("tile_col") == grid.tile_of(F.col("col")))
    step = measure.cell_size_m(grid.centre_lat(F.col("row")), grid.dx) * 8.0
    return (
        rows.withColumns({"gx": east, "gy": south}).filter(own)
        .withColumns({"gx": F.when(whole & F.col("gy").isNotNull(), F.col("gx") / step),
                      "gy": F.when(whole & F.col("gx").isNotNull(), F.col("gy") / step)})
        .select(
            "row", "col", elevation_of(F.col("elevation"), grid).alias("elevation"),
            measure.slope_degrees(F.col("gx"), F.col("gy")).alias("slope"),
            measure.bearing_of_gradient(F.col("gx"), F.col("gy")).alias("aspect_degrees"),
        )
        .withColumn("aspect_cardinal", measure.compass_name(F.col("aspect_degrees")))
    )


def terrain_at(places: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    """Elevation, slope, aspect and its compass name for distinct places."""
    located = places.withColumns(
        {"row": grid.row(F.col("latitude")), "col": grid.col(F.col("Longitude"))}
    )
    return _measured(located, cells, grid).drop("row", "col")


def _measured(located: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    """Windows are built once per distinct cell, then joined back to the places in it."""
    found = windows(
        located.select("row", "col").dropna().distinct(), cells, grid
    )
    step = measure.cell_size_m(F.col("latitude"), grid.dx) * 8.0
    return (
        located.join(found, ["row", "col"], "left")
        .withColumns({"dz_dx": F.col("east") / step, "dz_dy": F.col("south") / step})
        .withColumns(
            {
                "elevation": elevation_of(F.col("centre"), grid),
                "slope": measure.slope_degrees(F.col("dz_dx"), F.col("dz_dy")),
                "aspect_degrees": measure.bearing_of_gradient(F.col("dz_dx"), F.col("dz_dy")),
            }
        )
        .withColumn("aspect_cardinal", measure.compass_name(F.col("aspect_degrees")))
        .drop("centre", "east", "south", "dz_dx", "dz_dy")
    )


def patch(places: DataFrame, cells: DataFrame, grid: Grid, half_width: float = 0.005) -> DataFrame:
    """Terrain of the middle cell of a box of ``half_width`` degrees round each place.

    The patch is the block of cells whose centres lie in the box. Its middle cell (the later one
    of an even count) gives the elevation; slope and aspect also need the 3×3 window to lie within
    the patch, and the middle cell to hold a reading. Cell sizes are metric, as elsewhere.
    """
    lat, lon = F.col("latitude"), F.col("Longitude")
    bounds = places.withColumns(
        {
            "r0": F.ceil((grid.y0 - lat - half_width) / grid.dy - 0.5).cast("int"),
            "r1": F.floor((grid.y0 - lat + half_width) / grid.dy - 0.5).cast("int"),
            "c0": F.ceil((lon - half_width - grid.x0) / grid.dx - 0.5).cast("int"),
            "c1": F.floor((lon + half_width - grid.x0) / grid.dx - 0.5).cast("int"),
        }
    ).withColumns(
        {"tall": F.col("r1") - F.col("r0") + 1, "broad": F.col("c1") - F.col("c0") + 1}
    )
    some = (F.col("tall") >= 1) & (F.col("broad") >= 1)
    located = bounds.withColumns(
        {
            "row": F.when(some, F.col("r0") + F.floor(F.col("tall") / 2).cast("int")),
            "col": F.when(some, F.col("c0") + F.floor(F.col("broad") / 2).cast("int")),
        }
    )
    usable = (
        (F.col("tall") >= 3) & (F.col("broad") >= 3) & F.col("elevation").isNotNull()
    )
    return (
        _measured(located, cells, grid)
        .withColumns(
            {c: F.when(usable, F.col(c)) for c in ("slope", "aspect_degrees", "aspect_cardinal")}
        )
        .drop("r0", "r1", "c0", "c1", "tall", "broad", "row", "col")
    )
