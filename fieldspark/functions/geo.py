"""Distances, grids and containment as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
KM_PER_DEGREE_LAT, KM_PER_DEGREE_LON = 110.574, 111.320


@dataclass(frozen=True)
class Box:
    """A closed box of latitudes and longitudes."""

    south: float
    north: float
    west: float
    east: float

    def covers(self, lat: Column, lon: Column) -> Column:
        return lat.between(self.south, self.north) & lon.between(self.west, self.east)

    def wkt(self) -> str:
        corners = [(self.west, self.south), (self.east, self.south), (self.east, self.north), (self.west, self.north), (self.west, self.south)]
        return "POLYGON((" + ",".join(f"{x} {y}" for x, y in corners) + "))"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; the sine's square is held to 1, where rounding would make the arcus sine NaN."""
    half = lambda a, b: F.pow(F.sin((F.radians(b) - F.radians(a)) / 2), F.lit(2.0))
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return haversine_km(lat1, lon1, lat2, lon2) * 1000


def grid_cell(lat: Column, lon: Column, cell_km: float) -> tuple[Column, Column]:
    """Row and column of a planar grid of about ``cell_km``."""
    row = F.floor(lat * KM_PER_DEGREE_LAT / cell_km)
    col = F.floor(lon * KM_PER_DEGREE_LON * F.cos(F.radians(lat)) / cell_km)
    return row.cast("long"), col.cast("long")


def degree_cell(lat: Column, lon: Column, step: float) -> Column:
    """Name of a cell of ``step`` degrees: row and column, south-west corner counted from zero."""
    return F.concat_ws(":", F.floor(lat / step).cast("string"), F.floor(lon / step).cast("string"))


def region_label(lat: Column, lon: Column) -> Column:
    """Whole-degree region, halves rounded to even."""
    return F.concat_ws(":", F.bround(lat, 0).cast("int").cast("string"), F.bround(lon, 0).cast("int").cast("string"))


def repair_coordinates(lat: Column, lon: Column, box: Box, infer_west: Column) -> Column:
    """Struct ``lat, lon, transform`` of the coordinates that lie in the box, or null.

    Coordinates inside stay. Otherwise they are swapped, and where ``infer_west`` holds a missing west sign is tried
    with and without a swap; exactly one distinct place must lie inside. The last of equal places names the transform.
    """
    place = lambda a, b, name: F.struct(a.alias("lat"), b.alias("lon"), F.lit(name).alias("transform"))
    tries = [
        (lon, lat, "SWAPPED_LAT_LON", F.lit(True)),
        (lat, -lon, "WEST_SIGN_INFERRED", infer_west),
        (lon, -lat, "SWAPPED_LAT_LON_WEST_SIGN_INFERRED", infer_west),
    ]
    found = F.array_compact(F.array(*[F.when(box.covers(a, b) & allowed, place(a, b, name)) for a, b, name, allowed in tries]))
    places = F.array_distinct(F.transform(found, lambda x: F.struct(x["lat"], x["lon"])))
    repaired = F.when(F.size(places) == 1, F.element_at(found, -1))
    return F.when(box.covers(lat, lon), place(lat, lon, "NONE")).otherwise(repaired)


def polygon_covers(lat: Column, lon: Column, rings: list[list[tuple[float, float]]]) -> Column:
    """Even-odd test of (lat, lon) against rings of vertices; points on an edge are inside.

    Each edge is an expression, which keeps the test in the JVM; meant for reviewed domains of some hundred vertices.
    """
    crossings, on_edge = F.lit(0), F.lit(False)
    for ring in rings:
        for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1], strict=True):
            cross = (lon - x1) * (y2 - y1) - (lat - y1) * (x2 - x1)
            inside_box = lat.between(min(y1, y2), max(y1, y2)) & lon.between(min(x1, x2), max(x1, x2))
            on_edge = on_edge | ((cross == 0) & inside_box)
            if y1 != y2:
                straddles = (lat >= min(y1, y2)) & (lat < max(y1, y2))
                east = (x2 - x1) * (lat - y1) / (y2 - y1) + x1
                crossings = crossings + F.when(straddles & (lon < east), 1).otherwise(0)
    return on_edge | (crossings % 2 == 1)


def map_zoom(span: Column) -> Column:
    """Zoom of a map that shows ``span`` degrees, between 1 and 7."""
    return F.greatest(F.lit(1.0), F.least(F.lit(7.0), F.log2(F.lit(360.0) / F.greatest(span, F.lit(0.01)))))
