"""Column geometry: angles, distances, projections, light phases."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_M = 6_371_008.8
WGS84_A, WGS84_E2 = 6_378_137.0, 6.69437999014e-3


def wrap(angle: Column) -> Column:
    """Radians to (-pi, pi]."""
    return F.atan2(F.sin(angle), F.cos(angle))


def turn_degrees(heading_in: Column, heading_out: Column) -> Column:
    """Signed heading change in degrees; positive is left."""
    return F.degrees(wrap(heading_out - heading_in))


def yaw(qx: Column, qy: Column, qz: Column, qw: Column) -> Column:
    """Heading of a quaternion."""
    return F.atan2(2 * (qw * qz + qx * qy), 1 - 2 * (qy * qy + qz * qz))


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points on the sphere."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def project(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """struct(x, y): azimuthal equidistant metres around an origin, on the sphere."""
    p, p0, d = F.radians(lat), F.radians(lat0), F.radians(lon - lon0)
    c = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.sin(p0) * F.sin(p) + F.cos(p0) * F.cos(p) * F.cos(d))))
    k = F.when(c < 1e-12, F.lit(1.0)).otherwise(c / F.sin(c)) * EARTH_M
    return F.struct((k * F.cos(p) * F.sin(d)).alias("x"), (k * (F.cos(p0) * F.sin(p) - F.sin(p0) * F.cos(p) * F.cos(d))).alias("y"))


def unproject(x: Column, y: Column, lat0: Column, lon0: Column) -> Column:
    """struct(lat, lon): the inverse of project."""
    rho = F.sqrt(x * x + y * y)
    c, p0 = rho / EARTH_M, F.radians(lat0)
    safe = F.when(rho == 0, F.lit(1.0)).otherwise(rho)
    lat = F.when(rho == 0, lat0).otherwise(F.degrees(F.asin(F.cos(c) * F.sin(p0) + y * F.sin(c) * F.cos(p0) / safe)))
    lon = F.when(rho == 0, lon0).otherwise(lon0 + F.degrees(F.atan2(x * F.sin(c), safe * F.cos(p0) * F.cos(c) - y * F.sin(p0) * F.sin(c))))
    return F.struct(lat.alias("lat"), lon.alias("lon"))


def ecef(lat: Column, lon: Column, height: Column) -> Column:
    """struct(x, y, z) of a WGS84 position."""
    p, q = F.radians(lat), F.radians(lon)
    n = WGS84_A / F.sqrt(1 - WGS84_E2 * F.pow(F.sin(p), 2))
    return F.struct(((n + height) * F.cos(p) * F.cos(q)).alias("x"), ((n + height) * F.cos(p) * F.sin(q)).alias("y"), ((n * (1 - WGS84_E2) + height) * F.sin(p)).alias("z"))


def light_colour(t: Column, offset: Column, cycle: Column, green: Column, yellow: Column) -> Column:
    """Green, then yellow, red for the rest of the cycle."""
    phase = F.pmod(t - offset, cycle)
    return F.when(phase < green, "green").when(phase < green + yellow, "yellow").otherwise("red")


def seconds_to_green(t: Column, offset: Column, cycle: Column, green: Column) -> Column:
    """0 while green, else what is left of the cycle."""
    phase = F.pmod(t - offset, cycle)
    return F.when(phase < green, F.lit(0.0)).otherwise(cycle - phase)


def green_overlap(start_a: Column, green_a: Column, start_b: Column, green_b: Column, cycle: Column) -> Column:
    """Seconds that two green windows of one cycle share, over the cycle's wrap."""
    a, b = F.pmod(start_a, cycle), F.pmod(start_b, cycle)
    parts = [F.greatest(F.lit(0.0), F.least(a + green_a, b + green_b + k * cycle) - F.greatest(a, b + k * cycle)) for k in (-1, 0, 1)]
    return parts[0] + parts[1] + parts[2]


def exact_rate(hz: Column) -> Column:
    """Whether one step is a whole number of microseconds."""
    micros = F.lit(1e6) / hz
    return F.abs(micros - F.round(micros)) < 1e-9


def polyline_length(points: Column) -> Column:
    """Length of array(struct(x, y)); 0 for fewer than two points."""
    step = lambda a, b: F.sqrt(F.pow(b["x"] - a["x"], 2) + F.pow(b["y"] - a["y"], 2))
    n = F.greatest(F.size(points) - 1, F.lit(0))
    return F.aggregate(F.zip_with(F.slice(points, F.lit(1), n), F.slice(points, F.lit(2), n), step), F.lit(0.0), lambda s, d: s + d)
