"""SQL-text math backend: prints the library's column formulas as DuckDB SQL for the oracles."""

from __future__ import annotations

from types import SimpleNamespace


class S:
    """A SQL expression string with arithmetic operators."""

    def __init__(self, text: str):
        self.t = text

    @staticmethod
    def of(x) -> "S":
        if isinstance(x, S):
            return x
        if isinstance(x, float):
            return S(f"({x!r}::DOUBLE)")
        if isinstance(x, int):
            return S(f"({x}::DOUBLE)")
        return S(str(x))

    def _bin(self, op, other, rev=False):
        a, b = (S.of(other), self) if rev else (self, S.of(other))
        return S(f"({a.t} {op} {b.t})")

    def __add__(self, o): return self._bin("+", o)
    def __radd__(self, o): return self._bin("+", o, True)
    def __sub__(self, o): return self._bin("-", o)
    def __rsub__(self, o): return self._bin("-", o, True)
    def __mul__(self, o): return self._bin("*", o)
    def __rmul__(self, o): return self._bin("*", o, True)
    def __truediv__(self, o): return self._bin("/", o)
    def __rtruediv__(self, o): return self._bin("/", o, True)
    def __neg__(self): return S(f"(-{self.t})")

    def __str__(self):
        return self.t


def _f(name):
    return lambda *a: S(f"{name}(" + ", ".join(S.of(x).t for x in a) + ")")


SQL_MATH = SimpleNamespace(
    lit=S.of, sin=_f("sin"), cos=_f("cos"), sinh=_f("sinh"), cosh=_f("cosh"), atanh=_f("atanh"), asinh=_f("asinh"),
    asin=_f("asin"), atan2=_f("atan2"), sqrt=_f("sqrt"), radians=_f("radians"), degrees=_f("degrees"), col=S.of,
    floor=_f("floor"),
)


def utm_sql(lon: str, lat: str, zone: str) -> tuple[str, str]:
    from ..functions.geo import project_utm

    x, y = project_utm(S(lon), S(lat), S(zone), m=SQL_MATH)
    return x.t, y.t


def unutm_sql(x: str, y: str, zone: str) -> tuple[str, str]:
    from ..functions.geo import unproject_utm

    lon, lat = unproject_utm(S(x), S(y), S(zone), m=SQL_MATH)
    return lon.t, lat.t


def zone_sql(table: str, lon: str = "longitude") -> str:
    return f"(SELECT CAST(floor((avg({lon}) + 180) / 6) + 1 AS INTEGER) FROM {table})"


def seg_dist_sql(px, py, x1, y1, x2, y2) -> str:
    dx, dy = f"(({x2}) - ({x1}))", f"(({y2}) - ({y1}))"
    len2 = f"({dx}*{dx} + {dy}*{dy})"
    t = f"(CASE WHEN {len2} > 0 THEN greatest(0.0, least(1.0, ((({px}) - ({x1}))*{dx} + (({py}) - ({y1}))*{dy}) / {len2})) ELSE 0.0 END)"
    qx, qy = f"(({x1}) + {t}*{dx})", f"(({y1}) + {t}*{dy})"
    return f"sqrt((({px}) - {qx})*(({px}) - {qx}) + (({py}) - {qy})*(({py}) - {qy}))"
