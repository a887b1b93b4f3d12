"""Small builders and brute-force counterparts for the tests."""

from __future__ import annotations

import re

from gridzonal.schema import ZONES


def make_zones(spark, zones: dict[int, list[tuple[str, list[tuple[float, float]]]]]):
    """{zone_id: [(role, [(lon, lat), ...]), ...]} as a zone table."""
    rows = [
        (zone_id, [(role, [(float(x), float(y)) for x, y in pts]) for role, pts in rings])
        for zone_id, rings in zones.items()
    ]
    return spark.createDataFrame(rows, ZONES)


def rectangle(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def ring_area(points):
    total = 0.0
    for (x0, y0), (x1, y1) in zip(points, points[1:] + points[:1]):
        total += x0 * y1 - x1 * y0
    return abs(total) / 2


def clip(points, x0, y0, x1, y1):
    """Polygon clipped to a box, side by side of the box; its area is exact for concave rings too."""
    sides = [
        (lambda p: p[0] >= x0, lambda a, b: (x0, a[1] + (b[1] - a[1]) * (x0 - a[0]) / (b[0] - a[0]))),
        (lambda p: p[0] <= x1, lambda a, b: (x1, a[1] + (b[1] - a[1]) * (x1 - a[0]) / (b[0] - a[0]))),
        (lambda p: p[1] >= y0, lambda a, b: (a[0] + (b[0] - a[0]) * (y0 - a[1]) / (b[1] - a[1]), y0)),
        (lambda p: p[1] <= y1, lambda a, b: (a[0] + (b[0] - a[0]) * (y1 - a[1]) / (b[1] - a[1]), y1)),
    ]
    for inside, cross in sides:
        kept = []
        for a, b in zip(points, points[1:] + points[:1]):
            if inside(a):
                kept.append(a)
            if inside(a) != inside(b):
                kept.append(cross(a, b))
        points = kept
        if not points:
            break
    return points


def brute_fractions(rings, spec):
    """{(iy, ix): covered fraction} from clipping every ring to every cell."""
    result = {}
    for iy in range(spec.ny):
        for ix in range(spec.nx):
            x0, y0 = spec.lon0 + ix * spec.dlon, spec.lat0 + iy * spec.dlat
            area = 0.0
            for role, points in rings:
                piece = clip(list(points), x0, y0, x0 + spec.dlon, y0 + spec.dlat)
                area += ring_area(piece) * (-1 if role == "hole" else 1) if piece else 0.0
            fraction = area / (spec.dlon * spec.dlat)
            if fraction > 1e-9:
                result[iy, ix] = fraction
    return result


def plan_of(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
