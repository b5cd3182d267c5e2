"""Slope and aspect on small grids."""

import math

import pytest

from firnline.operators import terrain

GRID = terrain.Grid(x0=-106.0, dx=0.001, y0=40.0, dy=0.001, tile=4)


def cells(spark, height, rows=5, cols=5):
    data = [(r, c, float(height(r, c))) for r in range(rows) for c in range(cols)]
    return terrain.tiled(spark.createDataFrame(data, "row int, col int, elevation double"), GRID)


def place(spark, row=2, col=2):
    return spark.createDataFrame(
        [(GRID.x0 + (col + 0.5) * GRID.dx, GRID.y0 - (row + 0.5) * GRID.dy)],
        "Longitude double, latitude double",
    )


def measured(spark, height, row=2, col=2):
    return terrain.terrain_at(place(spark, row, col), cells(spark, height), GRID).first()


@pytest.mark.parametrize("drop, name, bearing", [
    # Height grows with the row (south) and column (east); a slope faces where it descends, with
    # the row axis taken as the mathematical y axis.
    ((0, 1), "W", 270.0), ((0, -1), "E", 90.0), ((1, 0), "N", 0.0), ((-1, 0), "S", 180.0),
    ((1, 1), "NW", 315.0), ((1, -1), "NE", 45.0), ((-1, 1), "SW", 225.0), ((-1, -1), "SE", 135.0),
])
def test_tilted_planes(spark, drop, name, bearing):
    row = measured(spark, lambda r, c: 1000 + 10 * (drop[0] * r + drop[1] * c))
    size = (111320 * math.cos(math.radians(40 - 2.5 * 0.001)) + 111320) / 2 * 0.001
    rise = 10 * math.hypot(*drop) / size
    assert row["slope"] == pytest.approx(math.degrees(math.atan(rise)))
    assert row["aspect_degrees"] % 360 == pytest.approx(bearing)
    assert row["aspect_cardinal"] == name


def test_flat_ground(spark):
    row = measured(spark, lambda r, c: 2000.1)
    assert (row["slope"], row["aspect_degrees"], row["aspect_cardinal"]) == (0.0, 270.0, "W")


def test_no_reading_in_the_middle(spark):
    row = measured(spark, lambda r, c: -32768 if (r, c) == (2, 2) else 1)
    assert row["elevation"] is None and row["slope"] is None


def test_no_reading_next_door(spark):
    row = measured(spark, lambda r, c: -32768 if (r, c) == (1, 2) else 1)
    assert row["elevation"] == 1.0 and row["slope"] is None and row["aspect_cardinal"] is None


def test_edge_keeps_its_elevation(spark):
    row = measured(spark, lambda r, c: r, row=0)
    assert row["elevation"] == 0.0 and row["slope"] is None


def test_outside_the_grid(spark):
    row = measured(spark, lambda r, c: r, row=40)
    assert row["elevation"] is None and row["slope"] is None


def test_patch(spark):
    grid = cells(spark, lambda r, c: 1000 + 10 * c, 9, 9)
    whole = terrain.patch(place(spark, 4, 4), grid, GRID, half_width=0.0016).first()
    assert whole["elevation"] == 1040.0 and whole["aspect_cardinal"] == "W"
    small = terrain.patch(place(spark, 4, 4), grid, GRID, half_width=0.0006).first()
    assert small["elevation"] == 1040.0 and small["slope"] is None
