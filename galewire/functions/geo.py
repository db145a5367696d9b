"""Column helpers for positions on the globe."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius, and kilometres per degree of latitude.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), 2
    )
    # Rounding may push antipodal points above 1.
    chord = F.least(chord, F.lit(1.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))


def place_centroid(geo: Column) -> Column:
    """Centre of a place: mean of a four-number bounding box, else the mean of the first ring."""
    bbox = geo["bbox"]
    boxed = F.struct(
        ((F.get(bbox, F.lit(1)) + F.get(bbox, F.lit(3))) / 2).alias("lat"),
        ((F.get(bbox, F.lit(0)) + F.get(bbox, F.lit(2))) / 2).alias("lon"),
    )
    ring = F.filter(F.get(geo["coordinates"], F.lit(0)), lambda p: F.size(p) >= 2)

    def mean(axis: int) -> Column:
        total = F.aggregate(ring, F.lit(0.0), lambda acc, p: acc + F.get(p, F.lit(axis)))
        return total / F.size(ring)

    ringed = F.struct(mean(1).alias("lat"), mean(0).alias("lon"))
    return F.when(F.size(bbox) == 4, boxed).when(F.size(ring) > 0, ringed)


def grid_row(lat: Column, cell_degrees: float) -> Column:
    return F.floor(lat / cell_degrees).cast("int")


def grid_column(lon: Column, cell_degrees: float) -> Column:
    """Longitude cells wrap around the date line."""
    return F.pmod(F.floor(lon / cell_degrees), F.lit(round(360 / cell_degrees))).cast("int")


def cells_within(lat: Column, lon: Column, radius_km: float, cell_degrees: float) -> Column:
    """All grid cells a circle can touch, as ``array<struct<cell_row, cell_col>>``.

    The box is widened in longitude by the cosine of its most polar latitude and spans every
    longitude when it reaches a pole.
    """
    dlat = radius_km / KM_PER_DEGREE + 0.01
    polar = F.abs(lat) + dlat
    dlon = F.when(polar >= 89.5, F.lit(180.0)).otherwise(
        F.least(F.lit(180.0), dlat / F.cos(F.radians(polar)))
    )
    rows = F.sequence(
        F.floor((lat - dlat) / cell_degrees).cast("int"),
        F.floor((lat + dlat) / cell_degrees).cast("int"),
    )
    cols = F.array_distinct(
        F.transform(
            F.sequence(
                F.floor((lon - dlon) / cell_degrees).cast("int"),
                F.floor((lon + dlon) / cell_degrees).cast("int"),
            ),
            lambda c: F.pmod(c, F.lit(round(360 / cell_degrees))),
        )
    )
    return F.flatten(
        F.transform(
            rows,
            lambda r: F.transform(cols, lambda c: F.struct(r.alias("cell_row"), c.alias("cell_col"))),
        )
    )
