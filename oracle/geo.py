"""Grid to latitude and longitude as nested DuckDB sub-queries (oracle side), with constants of its own."""

from __future__ import annotations

import math

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


def _meridional_arc(lat: str) -> str:
    n, n2, n3 = _N, _N**2, _N**3
    d, s = f"({lat} - {LAT0!r})", f"({lat} + {LAT0!r})"
    return (
        f"({AIRY_B * F0!r} * ("
        f"{1 + n + 1.25 * n2 + 1.25 * n3!r} * {d}"
        f" - {3 * n + 3 * n2 + 21 / 8 * n3!r} * sin({d}) * cos({s})"
        f" + {15 / 8 * n2 + 15 / 8 * n3!r} * sin(2 * {d}) * cos(2 * {s})"
        f" - {35 / 24 * n3!r} * sin(3 * {d}) * cos(3 * {s})))"
    )


def steps(e: str, n: str) -> list[list[tuple[str, str]]]:
    """Projection steps; each is a list of ``(name, sql_expr)`` that may use
    names defined in earlier steps.  The final step defines ``_lat``/``_lon``
    in degrees."""
    aF0 = AIRY_A * F0
    out: list[list[tuple[str, str]]] = [[("_e", f"cast({e} as double)"), ("_n", f"cast({n} as double)")]]
    out.append([("_p0", f"(_n - {N0!r}) / {aF0!r} + {LAT0!r}")])
    prev = "_p0"
    for i in range(1, _FOOT_ITER + 1):
        cur = f"_p{i}"
        out.append([(cur, f"{prev} + (_n - {N0!r} - {_meridional_arc(prev)}) / {aF0!r}")])
        prev = cur
    phi = prev
    out.append(
        [
            ("_sn", f"sin({phi})"),
            ("_t", f"tan({phi})"),
            ("_sec", f"1.0 / cos({phi})"),
            ("_de", f"_e - {E0!r}"),
        ]
    )
    out.append(
        [
            ("_nu", f"{aF0!r} / sqrt(1 - {_E2!r} * _sn * _sn)"),
            ("_rho", f"{aF0 * (1 - _E2)!r} / pow(1 - {_E2!r} * _sn * _sn, 1.5)"),
        ]
    )
    out.append([("_eta2", "_nu / _rho - 1")])
    out.append(
        [
            ("_vii", "_t / (2 * _rho * _nu)"),
            ("_viii", "_t / (24 * _rho * pow(_nu, 3)) * (5 + 3 * _t * _t + _eta2 - 9 * _t * _t * _eta2)"),
            ("_ix", "_t / (720 * _rho * pow(_nu, 5)) * (61 + 90 * _t * _t + 45 * pow(_t, 4))"),
            ("_x", "_sec / _nu"),
            ("_xi", "_sec / (6 * pow(_nu, 3)) * (_nu / _rho + 2 * _t * _t)"),
            ("_xii", "_sec / (120 * pow(_nu, 5)) * (5 + 28 * _t * _t + 24 * pow(_t, 4))"),
            ("_xiia", "_sec / (5040 * pow(_nu, 7)) * (61 + 662 * _t * _t + 1320 * pow(_t, 4) + 720 * pow(_t, 6))"),
        ]
    )
    out.append(
        [
            ("_la", f"{phi} - _vii * pow(_de, 2) + _viii * pow(_de, 4) - _ix * pow(_de, 6)"),
            ("_lo", f"{LON0!r} + _x * _de - _xi * pow(_de, 3) + _xii * pow(_de, 5) - _xiia * pow(_de, 7)"),
        ]
    )
    # OSGB36 geodetic -> cartesian (height 0)
    out.append([("_nu2", f"{AIRY_A!r} / sqrt(1 - {_E2!r} * sin(_la) * sin(_la))")])
    out.append(
        [
            ("_cx", "_nu2 * cos(_la) * cos(_lo)"),
            ("_cy", "_nu2 * cos(_la) * sin(_lo)"),
            ("_cz", f"{1 - _E2!r} * _nu2 * sin(_la)"),
        ]
    )
    s1 = 1 + S_PPM * 1e-6
    rx, ry, rz = RX * _SEC, RY * _SEC, RZ * _SEC
    out.append(
        [
            ("_wx", f"{TX!r} + {s1!r} * _cx - {rz!r} * _cy + {ry!r} * _cz"),
            ("_wy", f"{TY!r} + {rz!r} * _cx + {s1!r} * _cy - {rx!r} * _cz"),
            ("_wz", f"{TZ!r} - {ry!r} * _cx + {rx!r} * _cy + {s1!r} * _cz"),
        ]
    )
    out.append([("_pp", "sqrt(_wx * _wx + _wy * _wy)")])
    out.append([("_g0", f"atan2(_wz, _pp * {1 - _WE2!r})")])
    prev = "_g0"
    for i in range(1, _GEO_ITER + 1):
        cur = f"_g{i}"
        nu = f"({WGS_A!r} / sqrt(1 - {_WE2!r} * sin({prev}) * sin({prev})))"
        out.append([(cur, f"atan2(_wz + {_WE2!r} * {nu} * sin({prev}), _pp)")])
        prev = cur
    out.append([("_lat", f"degrees({prev})"), ("_lon", "degrees(atan2(_wy, _wx))")])
    return out


def duckdb_lat_lon_sql(source_sql: str, easting: str, northing: str, keep: list[str], lat: str, lon: str) -> str:
    """The same steps as nested DuckDB sub-queries over ``source_sql``."""
    sql = source_sql
    for step in steps(f'"{easting}"', f'"{northing}"'):
        cols = ", ".join(f"{expr} AS {name}" for name, expr in step)
        sql = f"SELECT *, {cols} FROM ({sql})"
    keep_sql = ", ".join(f'"{k}"' for k in keep)
    return f"SELECT {keep_sql}, _lat AS \"{lat}\", _lon AS \"{lon}\" FROM ({sql})"
