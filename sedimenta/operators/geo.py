"""Coordinates: a closed-form transform of projected to geographic ones, and checks of the axis order."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.scalars import in_box, let, prefix_class

#: A transform takes the columns (easting, northing) and returns (longitude, latitude).
Transform = Callable[[Column, Column], tuple[Column, Column]]


class GeoError(ValueError):
    """Coordinates that must not be transformed."""


#: WGS 84: semi-major axis and inverse flattening.
WGS84 = (6378137.0, 298.257223563)
# Krueger's series of the transverse Mercator projection to the sixth order of the third flattening n.
# Row j holds the coefficients of n^j, n^(j+1), ... of the term of sin(2 j x).
FORWARD_SERIES = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
INVERSE_SERIES = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)


def _sums(series: tuple, n: float) -> list[float]:
    return [sum(c * n ** (j + i) for i, c in enumerate(row)) for j, row in enumerate(series, 1)]


def _earth_centred(lat: Column, lon: Column, a: float, e2: float, height: Column | float = 0.0) -> tuple[Column, Column, Column]:
    """Geodetic radians and metres above the ellipsoid to metres from the centre."""
    n = a / F.sqrt(1 - e2 * F.sin(lat) ** 2)
    return (n + height) * F.cos(lat) * F.cos(lon), (n + height) * F.cos(lat) * F.sin(lon), (n * (1 - e2) + height) * F.sin(lat)


def _geodetic(v: Column, a: float, f: float) -> tuple[Column, Column]:
    """(lon, lat) in radians of a struct x, y, z of metres from the centre, for points near the ellipsoid."""
    e2, b = f * (2 - f), a * (1 - f)
    p = F.sqrt(v["x"] ** 2 + v["y"] ** 2)
    theta = F.atan2(v["z"] * a, p * b)
    return F.atan2(v["y"], v["x"]), F.atan2(v["z"] + e2 / (1 - e2) * b * F.sin(theta) ** 3, p - e2 * a * F.cos(theta) ** 3)


@dataclass(frozen=True)
class TransverseMercator:
    """A transverse Mercator projection on an ellipsoid, and the shift of its datum to WGS 84.

    shift: dx, dy, dz in metres; rx, ry, rz in seconds of arc (position vector); scale in parts per million.
    All transforms are expressions of built-in functions; each step is computed once and named.
    """

    a: float
    inverse_flattening: float
    lat0: float
    lon0: float
    scale: float
    false_easting: float
    false_northing: float
    shift: tuple[float, float, float, float, float, float, float]

    def _ellipsoid(self) -> tuple[float, float, float, float]:
        """(flattening, squared eccentricity, third flattening, radius of the rectifying sphere)"""
        f = 1 / self.inverse_flattening
        n = f / (2 - f)
        return f, f * (2 - f), n, self.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)

    def _origin(self) -> float:
        """The rectified latitude of the origin."""
        _, e2, n, _ = self._ellipsoid()
        e, phi = math.sqrt(e2), math.radians(self.lat0)
        xi = math.atan(math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi))))
        return xi + sum(c * math.sin(2 * j * xi) for j, c in enumerate(_sums(FORWARD_SERIES, n), 1))

    def project(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """(easting, northing) of degrees on the projection's own datum."""
        _, e2, n, radius = self._ellipsoid()
        e, k, origin = math.sqrt(e2), self.scale * radius, self._origin()

        def sphere(v: Column) -> Column:
            sin = F.sin(v["lat"])
            tau = F.sinh(F.atanh(sin) - e * F.atanh(e * sin))
            xi = F.atan2(tau, F.cos(v["lon"]))
            return F.struct(xi.alias("xi"), F.atanh(F.sin(v["lon"]) / F.sqrt(1 + tau**2)).alias("eta"))

        def plane(v: Column) -> Column:
            xi, eta = v["xi"], v["eta"]
            for j, c in enumerate(_sums(FORWARD_SERIES, n), 1):
                xi, eta = xi + c * F.sin(2 * j * v["xi"]) * F.cosh(2 * j * v["eta"]), eta + c * F.cos(2 * j * v["xi"]) * F.sinh(2 * j * v["eta"])
            return F.struct((self.false_easting + k * eta).alias("x"), (self.false_northing + k * (xi - origin)).alias("y"))

        start = F.struct(F.radians(lat).alias("lat"), F.radians(lon - self.lon0).alias("lon"))
        out = let(start, lambda v: let(sphere(v), plane))
        return out["x"], out["y"]

    def unproject(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(longitude, latitude) in degrees on the projection's own datum."""
        _, e2, n, radius = self._ellipsoid()
        e, k, origin = math.sqrt(e2), self.scale * radius, self._origin()

        def sphere(v: Column) -> Column:
            xi, eta = v["xi"], v["eta"]
            for j, c in enumerate(_sums(INVERSE_SERIES, n), 1):
                xi, eta = xi - c * F.sin(2 * j * v["xi"]) * F.cosh(2 * j * v["eta"]), eta - c * F.cos(2 * j * v["xi"]) * F.sinh(2 * j * v["eta"])
            return F.struct(xi.alias("xi"), eta.alias("eta"))

        def conformal(v: Column) -> Column:
            lat = F.asin(F.sin(v["xi"]) / F.cosh(v["eta"]))
            return F.struct(F.atan2(F.sinh(v["eta"]), F.cos(v["xi"])).alias("lon"), F.atanh(F.sin(lat)).alias("q"), lat.alias("lat"))

        def closer(v: Column) -> Column:
            # the isometric latitude is q = atanh(sin lat) - e atanh(e sin lat); each turn shrinks the error some 150 times
            return F.struct(v["lon"].alias("lon"), v["q"].alias("q"), F.asin(F.tanh(v["q"] + e * F.atanh(e * F.sin(v["lat"])))).alias("lat"))

        start = F.struct((origin + (y - self.false_northing) / k).alias("xi"), ((x - self.false_easting) / k).alias("eta"))
        out = let(start, lambda v: let(sphere(v), conformal))
        for _ in range(7):
            out = let(out, closer)
        return let(out, lambda v: F.degrees(v["lon"]) + self.lon0), let(out, lambda v: F.degrees(v["lat"]))

    def _turned(self) -> tuple[tuple[float, float, float], list[list[float]]]:
        """The datum shift as an offset and a matrix."""
        dx, dy, dz, *angles, ppm = self.shift
        rx, ry, rz = (math.radians(v / 3600) for v in angles)
        s = 1 + ppm * 1e-6
        return (dx, dy, dz), [[s, -s * rz, s * ry], [s * rz, s, -s * rx], [-s * ry, s * rx, s]]

    def to_wgs84(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(longitude, latitude) in degrees on WGS 84 of projected metres."""
        offset, turn = self._turned()
        f, e2, _, _ = self._ellipsoid()

        def shifted(v: Column) -> Column:
            from_centre = _earth_centred(v["lat"], v["lon"], self.a, e2)
            return F.struct(*[(d + sum(m * c for m, c in zip(row, from_centre, strict=True))).alias(axis) for axis, d, row in zip("xyz", offset, turn, strict=True)])

        def degrees(v: Column) -> Column:
            lon, lat = _geodetic(v, WGS84[0], 1 / WGS84[1])
            return F.struct(F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat"))

        lon, lat = self.unproject(x, y)
        own = F.struct(F.radians(lon).alias("lon"), F.radians(lat).alias("lat"))
        out = let(own, lambda v: let(shifted(v), degrees))
        return out["lon"], out["lat"]

    def from_wgs84(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """(easting, northing) in metres of degrees on WGS 84: the inverse of to_wgs84.

        Projected points lie on their own ellipsoid, at some height above that of WGS 84: the first shift tells it, the second uses it.
        """
        offset, turn = self._turned()
        back = _inverse(turn)
        f, e2, _, _ = self._ellipsoid()
        we2 = (2 - 1 / WGS84[1]) / WGS84[1]

        def shifted(v: Column) -> Column:
            from_centre = [c - d for c, d in zip(_earth_centred(v["lat"], v["lon"], WGS84[0], we2, v["height"]), offset, strict=True)]
            return F.struct(*[sum(m * c for m, c in zip(row, from_centre, strict=True)).alias(axis) for axis, row in zip("xyz", back, strict=True)])

        def above(v: Column) -> Column:
            _, lat = _geodetic(v, self.a, f)
            return let(lat, lambda phi: F.hypot(v["x"], v["y"]) * F.cos(phi) + v["z"] * F.sin(phi) - self.a * F.sqrt(1 - e2 * F.sin(phi) ** 2))

        def plane(v: Column) -> Column:
            own_lon, own_lat = _geodetic(v, self.a, f)
            x, y = self.project(F.degrees(own_lon), F.degrees(own_lat))
            return F.struct(x.alias("x"), y.alias("y"))

        own = F.struct(F.radians(lon).alias("lon"), F.radians(lat).alias("lat"), F.lit(0.0).alias("height"))
        level = lambda v: F.struct(v["lon"].alias("lon"), v["lat"].alias("lat"), (-let(shifted(v), above)).alias("height"))
        out = let(own, lambda v: let(level(v), lambda w: let(shifted(w), plane)))
        return out["x"], out["y"]


def _inverse(m: list[list[float]]) -> list[list[float]]:
    """The inverse of a 3 by 3 matrix."""
    minor = lambda i, j: m[(i + 1) % 3][(j + 1) % 3] * m[(i + 2) % 3][(j + 2) % 3] - m[(i + 1) % 3][(j + 2) % 3] * m[(i + 2) % 3][(j + 1) % 3]
    whole = sum(m[0][j] * minor(0, j) for j in range(3))
    return [[minor(j, i) / whole for j in range(3)] for i in range(3)]


# Fixed values of a public registry: Korean 1985 / Modified Central Belt (EPSG:5174) and its usual shift.
MODIFIED_CENTRAL_BELT = TransverseMercator(6377397.155, 299.1528128, 38.0, 127.0028902777778, 1.0, 200000.0, 500000.0, (-115.80, 474.99, 674.11, 1.16, -2.31, -1.63, 6.43))
CRS_INFO = {
    "EPSG:5174": {"name": "Korean 1985 / Modified Central Belt", "axes": ("northing", "easting"), "unit": "metre", "area": "onshore between 126 and 128 degrees east", "bounds": (126.0, 33.96, 128.0, 38.33)},
    "EPSG:4326": {"name": "WGS 84", "axes": ("latitude", "longitude"), "unit": "degree", "area": "world", "bounds": (-180.0, -90.0, 180.0, 90.0)},
}
# Boxes (west, south, east, north) of the country and its macro regions, and the prefixes of their addresses.
COUNTRY_BOX = (124.0, 32.0, 132.0, 40.0)
REGION_BOXES = {
    "capital": (125.5, 36.0, 128.5, 38.8),
    "gangwon": (127.0, 36.5, 130.0, 39.0),
    "chungcheong": (125.8, 35.0, 128.7, 37.5),
    "jeolla": (125.0, 33.8, 128.3, 36.5),
    "gyeongsang": (127.0, 34.0, 130.8, 37.3),
    "jeju": (125.8, 32.8, 127.3, 34.0),
}
REGION_PREFIXES = {
    "capital": ("서울특별시", "인천광역시", "경기도"),
    "gangwon": ("강원특별자치도", "강원도"),
    "chungcheong": ("충청북도", "충청남도", "대전광역시", "세종특별자치시"),
    "jeolla": ("전북특별자치도", "전라북도", "전라남도", "광주광역시"),
    "gyeongsang": ("경상북도", "경상남도", "대구광역시", "부산광역시", "울산광역시"),
    "jeju": ("제주특별자치도", "제주도"),
}


def in_area(lon: Column, lat: Column, crs: str = "EPSG:5174") -> Column:
    """Whether degrees lie in the reference system's area of use, edges included; false for null and non-finite ones."""
    return in_box(lon, lat, *CRS_INFO[crs]["bounds"])


def identity(x: Column, y: Column) -> tuple[Column, Column]:
    """For coordinates that are geographic already."""
    return x, y


def _projected(df: DataFrame, x: str, y: str, transform: Transform, to: str = "__g") -> DataFrame:
    """df with a column of the transformed pair, so that it is computed once however often it is used."""
    lon, lat = transform(F.col(x), F.col(y))
    return df.withColumn(to, F.struct(lon.alias("lon"), lat.alias("lat")))


def transform_counters(df: DataFrame, x: str, y: str, transform: Transform = MODIFIED_CENTRAL_BELT.to_wgs84, box: tuple = COUNTRY_BOX) -> DataFrame:
    """(transformed, missing, partial, not_finite, outside): pairs by what becomes of them, one scan."""
    df = _projected(df, x, y, transform)
    a, b, lon, lat = F.col(x), F.col(y), F.col("__g.lon"), F.col("__g.lat")
    both = a.isNotNull() & b.isNotNull()
    finite = both & ~F.isnan(lon) & ~F.isnan(lat) & (F.abs(lon) < float("inf")) & (F.abs(lat) < float("inf"))
    inside = in_box(lon, lat, *box)
    return df.agg(
        F.count_if(finite & inside).alias("transformed"),
        F.count_if(a.isNull() & b.isNull()).alias("missing"),
        F.count_if(a.isNull() != b.isNull()).alias("partial"),
        F.count_if(both & ~finite).alias("not_finite"),
        F.count_if(finite & ~inside).alias("outside"),
    )


def with_geographic(df: DataFrame, x: str, y: str, transform: Transform = MODIFIED_CENTRAL_BELT.to_wgs84, box: tuple = COUNTRY_BOX) -> DataFrame:
    """The sidecar columns wgs84_longitude, wgs84_latitude and coordinate_quality; null pairs are MISSING_SOURCE_COORDINATES.

    Partial pairs and results that aren't finite or lie outside the box raise while the frame is computed.
    """
    df = _projected(df, x, y, transform)
    a, b, lon, lat = F.col(x), F.col(y), F.col("__g.lon"), F.col("__g.lat")
    whole, none = a.isNotNull() & b.isNotNull(), a.isNull() & b.isNull()
    stop = lambda why: F.raise_error(F.lit(why)).cast("double")
    guard = lambda v: F.when(none, None).when(~whole, stop("half of a pair of coordinates is missing")).when(~in_box(lon, lat, *box), stop("a pair of coordinates lies outside the box")).otherwise(v)
    return df.withColumns({"wgs84_longitude": guard(lon), "wgs84_latitude": guard(lat), "coordinate_quality": F.when(none, "MISSING_SOURCE_COORDINATES").otherwise("TRANSFORMED")}).drop("__g")


def axis_probe(df: DataFrame, x: str, y: str, address: str, transform: Transform = MODIFIED_CENTRAL_BELT.to_wgs84, box: tuple = COUNTRY_BOX, regions: Mapping[str, tuple] = REGION_BOXES, prefixes: Mapping[str, tuple] = REGION_PREFIXES) -> DataFrame:
    """Both axis orders against the country's box and the box of the address's region: pairs, hits of either, both and none."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("__region", prefix_class(F.col(address), prefixes))
    pairs = _projected(_projected(pairs, x, y, transform, "__xy"), y, x, transform, "__yx")
    region = F.col("__region")

    def hits(pair: str) -> tuple[Column, Column]:
        lon, lat = F.col(f"{pair}.lon"), F.col(f"{pair}.lat")
        inside = F.lit(None).cast("boolean")
        for name, own in regions.items():
            inside = F.when(region == name, in_box(lon, lat, *own)).otherwise(inside)
        return in_box(lon, lat, *box), F.coalesce(inside, F.lit(False))

    (xy, xy_region), (yx, yx_region) = hits("__xy"), hits("__yx")
    return pairs.agg(
        F.count("*").alias("sampled"),
        F.count_if(xy).alias("xy_inside"),
        F.count_if(yx).alias("yx_inside"),
        F.count_if(xy & yx).alias("both_inside"),
        F.count_if(~xy & ~yx).alias("none_inside"),
        F.count_if(region.isNotNull()).alias("eligible"),
        F.count_if(xy_region).alias("xy_region"),
        F.count_if(yx_region).alias("yx_region"),
        F.count_if(xy_region & yx_region).alias("both_region"),
        F.count_if(region.isNotNull() & ~xy_region & ~yx_region).alias("none_region"),
    )


#: Evidence of the axis order, best first: (hits, pairs that count, least number of pairs, least rate, least lead over the other order).
AXIS_EVIDENCE = (("region", "eligible", 100, 0.90, 0.40), ("inside", "sampled", 100, 0.95, 0.50))
AXIS_ORDERS = {"xy": "X_IS_EASTING", "yx": "X_IS_NORTHING"}


def assess_axes(probe: DataFrame) -> DataFrame:
    """The probe with its verdict: the first evidence that is large and clear enough names the order; else AMBIGUOUS, or INSUFFICIENT_SAMPLE below its pairs."""
    clear = []
    for hits, pairs, least, rate, lead in AXIS_EVIDENCE:
        for order, verdict in AXIS_ORDERS.items():
            other = next(o for o in AXIS_ORDERS if o != order)
            share = lambda o: F.col(f"{o}_{hits}") / F.nullif(F.col(pairs), F.lit(0))  # noqa: B023, E731
            clear.append(F.when((F.col(pairs) >= least) & (share(order) >= rate) & (share(order) - share(other) >= lead), verdict))
    _, pairs, least, _, _ = AXIS_EVIDENCE[-1]
    return probe.withColumn("assessment", F.coalesce(*clear, F.when(F.col(pairs) < least, "INSUFFICIENT_SAMPLE").otherwise("AMBIGUOUS")))
