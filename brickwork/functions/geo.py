"""British National Grid (EPSG:27700) easting/northing -> WGS84 lat/lon.

Inverse transverse Mercator on the Airy 1830 ellipsoid (fixed iterations for
the footpoint latitude), then a 7-parameter Helmert shift to WGS84 and an
iterative geodetic latitude.  Helmert is good to a few metres; no grid-file
correction.

Spark side: one native Column expression; intermediate values are bound
once with ``transform(array(v), x -> ...)`` and the fixed iterations run as
``aggregate`` over a sequence, so the expression stays linear in size (no
Python per row).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
AIRY_A, AIRY_B = 6377563.396, 6356256.909
F0 = 0.9996012717
LAT0, LON0 = math.radians(49.0), math.radians(-2.0)
N0, E0 = -100000.0, 400000.0
# Helmert OSGB36 -> WGS84 (position vector): metres, ppm, arc-seconds
TX, TY, TZ = 446.448, -125.157, 542.060
S_PPM = -20.4894
RX, RY, RZ = 0.1502, 0.2470, 0.8421
WGS_A, WGS_B = 6378137.0, 6356752.314245
# ---------------------------------------------------------------- /fixed values

_E2 = 1 - AIRY_B**2 / AIRY_A**2
_N = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
_WE2 = 1 - WGS_B**2 / WGS_A**2
_SEC = math.pi / (180 * 3600)
_FOOT_ITER = 6
_GEO_ITER = 5


def _let(value, body):
    """Bind ``value`` once and use it in ``body`` (``transform(array(v),
    x -> body(x))[0]``): keeps the expression tree linear however often
    the value is used, also after the optimizer inlines aliases (e.g. when a
    filter on the result is pushed below the projection)."""
    return F.get(F.transform(F.array(value), body), 0)


def _arc(phi):
    n, n2, n3 = _N, _N**2, _N**3
    d, s = phi - F.lit(LAT0), phi + F.lit(LAT0)
    return F.lit(AIRY_B * F0) * (
        F.lit(1 + n + 1.25 * n2 + 1.25 * n3) * d
        - F.lit(3 * n + 3 * n2 + 21 / 8 * n3) * F.sin(d) * F.cos(s)
        + F.lit(15 / 8 * n2 + 15 / 8 * n3) * F.sin(d * 2) * F.cos(s * 2)
        - F.lit(35 / 24 * n3) * F.sin(d * 3) * F.cos(s * 3)
    )


def bng_to_wgs84(easting, northing):
    """Column struct ``(lat, lon)`` in WGS84 degrees from grid columns."""
    e = (F.col(easting) if isinstance(easting, str) else easting).cast("double")
    n = (F.col(northing) if isinstance(northing, str) else northing).cast("double")
    aF0 = AIRY_A * F0
    phi0 = (n - F.lit(N0)) / F.lit(aF0) + F.lit(LAT0)
    # footpoint latitude: fixed iterations (converged far below 0.01 mm)
    phi = F.aggregate(
        F.sequence(F.lit(1), F.lit(_FOOT_ITER)),
        phi0,
        lambda acc, _i: acc + (n - F.lit(N0) - _arc(acc)) / F.lit(aF0),
    )

    def on_phi(p):
        sn, t = F.sin(p), F.tan(p)
        q = F.lit(1.0) - F.lit(_E2) * sn * sn
        return F.struct(
            p.alias("p"),
            t.alias("t"),
            (F.lit(1.0) / F.cos(p)).alias("sec"),
            (F.lit(aF0) / F.sqrt(q)).alias("nu"),
            (F.lit(aF0 * (1 - _E2)) / F.pow(q, 1.5)).alias("rho"),
            (e - F.lit(E0)).alias("de"),
        )

    def latlon_osgb(v):
        t, sec, nu, rho, de = v["t"], v["sec"], v["nu"], v["rho"], v["de"]
        eta2 = nu / rho - F.lit(1.0)
        t2 = t * t
        vii = t / (rho * nu * 2)
        viii = t / (rho * F.pow(nu, 3) * 24) * (t2 * 3 + eta2 - t2 * eta2 * 9 + 5)
        ix = t / (rho * F.pow(nu, 5) * 720) * (t2 * 90 + F.pow(t, 4) * 45 + 61)
        x = sec / nu
        xi = sec / (F.pow(nu, 3) * 6) * (nu / rho + t2 * 2)
        xii = sec / (F.pow(nu, 5) * 120) * (t2 * 28 + F.pow(t, 4) * 24 + 5)
        xiia = sec / (F.pow(nu, 7) * 5040) * (t2 * 662 + F.pow(t, 4) * 1320 + F.pow(t, 6) * 720 + 61)
        la = v["p"] - vii * F.pow(de, 2) + viii * F.pow(de, 4) - ix * F.pow(de, 6)
        lo = F.lit(LON0) + x * de - xi * F.pow(de, 3) + xii * F.pow(de, 5) - xiia * F.pow(de, 7)
        return F.struct(la.alias("la"), lo.alias("lo"))

    def cartesian(g):
        la, lo = g["la"], g["lo"]
        nu2 = F.lit(AIRY_A) / F.sqrt(F.lit(1.0) - F.lit(_E2) * F.sin(la) * F.sin(la))
        return F.struct(
            (nu2 * F.cos(la) * F.cos(lo)).alias("x"),
            (nu2 * F.cos(la) * F.sin(lo)).alias("y"),
            (F.lit(1 - _E2) * nu2 * F.sin(la)).alias("z"),
        )

    s1 = 1 + S_PPM * 1e-6
    rx, ry, rz = RX * _SEC, RY * _SEC, RZ * _SEC

    def helmert(c):
        x, y, z = c["x"], c["y"], c["z"]
        return F.struct(
            (F.lit(TX) + F.lit(s1) * x - F.lit(rz) * y + F.lit(ry) * z).alias("x"),
            (F.lit(TY) + F.lit(rz) * x + F.lit(s1) * y - F.lit(rx) * z).alias("y"),
            (F.lit(TZ) - F.lit(ry) * x + F.lit(rx) * y + F.lit(s1) * z).alias("z"),
        )

    def geodetic(w):
        x, y, z = w["x"], w["y"], w["z"]
        pp = F.sqrt(x * x + y * y)
        lat = F.aggregate(
            F.sequence(F.lit(1), F.lit(_GEO_ITER)),
            F.atan2(z, pp * F.lit(1 - _WE2)),
            lambda acc, _i: F.atan2(
                z + F.lit(_WE2) * (F.lit(WGS_A) / F.sqrt(F.lit(1.0) - F.lit(_WE2) * F.sin(acc) * F.sin(acc))) * F.sin(acc), pp
            ),
        )
        return F.struct(F.degrees(lat).alias("lat"), F.degrees(F.atan2(y, x)).alias("lon"))

    v = _let(phi, on_phi)
    g = _let(v, latlon_osgb)
    c = _let(g, cartesian)
    w = _let(c, helmert)
    return _let(w, geodetic)


def with_lat_lon(df: DataFrame, easting: str, northing: str, lat: str = "LATITUDE", lon: str = "LONGITUDE") -> DataFrame:
    """Append WGS84 ``lat``/``lon`` columns computed from grid columns."""
    out = df.withColumn("__ll", bng_to_wgs84(easting, northing))
    return out.withColumns({lat: F.col("__ll.lat"), lon: F.col("__ll.lon")}).drop("__ll")
