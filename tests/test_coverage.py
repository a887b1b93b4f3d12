import math
import random

import pytest
from helpers import brute_fractions, clip, make_zones, plan_of, rectangle, ring_area

from gridzonal.operators.coverage import Footprint, footprint, validate_zones, zone_edges, zone_weights
from gridzonal.schema import GridSpec

UNIT = GridSpec("unit", 0.0, 0.0, 1.0, 1.0, 2, 1)


def fractions(spark, zones, spec):
    rows = zone_weights(make_zones(spark, zones), spec).collect()
    found = {}
    for row in rows:
        assert (row.iy, row.ix) not in found.setdefault(row.zone_id, {})
        found[row.zone_id][row.iy, row.ix] = row.fraction
    return found


def assert_same(found, expected):
    assert set(found) == set(expected)
    for cell, fraction in expected.items():
        assert found[cell] == pytest.approx(fraction, abs=1e-9)


def test_half_covered_cell(spark):
    got = fractions(spark, {1: [("shell", rectangle(0, 0, 1.5, 1))]}, UNIT)
    assert_same(got[1], {(0, 0): 1.0, (0, 1): 0.5})


@pytest.mark.parametrize("flip_shell", [False, True])
@pytest.mark.parametrize("flip_hole", [False, True])
@pytest.mark.parametrize("closed", [False, True])
def test_hole_whatever_the_winding(spark, flip_shell, flip_hole, closed):
    shell, hole = rectangle(0, 0, 1, 1), rectangle(0.25, 0.25, 0.75, 0.75)
    shell = shell[::-1] if flip_shell else shell
    hole = hole[::-1] if flip_hole else hole
    if closed:
        shell, hole = shell + shell[:1], hole + hole[:1]
    got = fractions(spark, {1: [("shell", shell), ("hole", hole)]}, UNIT)
    assert_same(got[1], {(0, 0): 0.75})


def star(rng, cx, cy, size, n):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [
        (cx + size * (r := rng.uniform(0.3, 1)) * math.cos(a), cy + size * r * math.sin(a)) for a in angles
    ]


def shrunk(points, cx, cy, factor):
    return [(cx + (x - cx) * factor, cy + (y - cy) * factor) for x, y in points]


def test_random_polygons_with_holes_match_clipping(spark):
    """Concave shells with holes, inside the grid and hanging over each of its borders."""
    rng = random.Random(7)
    spec = GridSpec("r", -3.0, 1.0, 0.7, 0.45, 13, 17)
    zones = {}
    for zone_id in range(60):
        cx, cy = rng.uniform(-4, 7), rng.uniform(0, 10)
        # A star around its centre stays simple when every gap between angles is under 180 degrees.
        shell = star(rng, cx, cy, rng.uniform(0.2, 5), rng.randint(9, 40))
        hole = shrunk(shell, cx, cy, rng.uniform(0.2, 0.6))
        zones[zone_id] = [("shell", shell), ("hole", hole[::-1] if zone_id % 2 else hole)]
    got = fractions(spark, zones, spec)
    for zone_id, rings in zones.items():
        assert_same(got.get(zone_id, {}), brute_fractions(rings, spec))


def test_borders_exactly_on_cell_borders(spark):
    spec = GridSpec("b", 0.0, 0.0, 0.1, 0.7, 20, 10)
    zones = {
        1: [("shell", rectangle(0.3, 2.1, 1.1, 4.2))],
        2: [("shell", rectangle(-5, -5, 50, 50))],
        3: [("shell", [(0.0, 0.0), (2.0, 0.0), (2.0, 7.0)])],
    }
    got = fractions(spark, zones, spec)
    for zone_id, rings in zones.items():
        assert_same(got[zone_id], brute_fractions(rings, spec))
    assert len(got[2]) == 200


def test_disjoint_parts_and_island_in_a_lake(spark):
    spec = GridSpec("p", 0.0, 0.0, 1.0, 1.0, 12, 12)
    rings = [
        ("shell", rectangle(0.5, 0.5, 9.5, 9.5)),
        ("hole", rectangle(2.2, 2.2, 7.8, 7.8)),
        ("shell", rectangle(4.1, 4.1, 5.9, 5.9)),
        ("shell", rectangle(10.2, 0.1, 11.9, 11.8)),
    ]
    assert_same(fractions(spark, {5: rings}, spec)[5], brute_fractions(rings, spec))


def test_area_is_kept_and_splitting_adds_up(spark):
    spec = GridSpec("a", 0.0, 0.0, 0.75, 0.75, 40, 40)
    whole = [(3.3, 2.1), (25.2, 4.4), (21.7, 27.9), (12.4, 13.3), (5.5, 26.1)]
    west, east = clip(whole, 0, 0, 14.3, 30), clip(whole, 14.3, 0, 30, 30)
    got = fractions(
        spark, {1: [("shell", whole)], 2: [("shell", west)], 3: [("shell", east)]}, spec
    )
    area = {k: sum(v.values()) * 0.75 * 0.75 for k, v in got.items()}
    assert area[1] == pytest.approx(ring_area(whole), abs=1e-9)
    assert area[2] + area[3] == pytest.approx(area[1], abs=1e-9)
    assert all(0 < f <= 1 + 1e-12 for zone in got.values() for f in zone.values())


def test_zone_off_the_grid_has_no_weights(spark):
    zones = {1: [("shell", rectangle(5, 5, 6, 6))], 2: [("shell", rectangle(-3, -3, -1, -1))]}
    assert fractions(spark, zones, UNIT) == {}


def test_footprint_bounds_the_weights(spark):
    spec = GridSpec("f", 0.0, 0.0, 1.0, 1.0, 10, 10)
    zones = make_zones(
        spark,
        {
            1: [("shell", [(1.5, 1.5), (4.5, 2.5), (2.5, 6.5)])],
            2: [("shell", rectangle(7.2, 8.2, 30, 30))],
            3: [("shell", rectangle(20, 20, 30, 30))],
        },
    )
    box = footprint(zones, spec)
    assert box == Footprint(rows=4 * 6 + 3 * 2, iy_min=1, iy_max=9, ix_min=1, ix_max=9, zones=3)
    assert zone_weights(zones, spec).count() <= box.rows


def test_footprint_of_nothing(spark):
    box = footprint(make_zones(spark, {1: [("shell", rectangle(20, 20, 30, 30))]}), UNIT)
    assert box.rows == 0


def test_edges_carry_winding(spark):
    zones = make_zones(
        spark,
        {1: [("shell", rectangle(0, 0, 4, 4)), ("hole", rectangle(1, 1, 2, 2)), ("hole", rectangle(2, 2, 3, 3)[::-1])]},
    )
    weights = {(r.ring, r.weight) for r in zone_edges(zones).collect()}
    assert weights == {(0, -1), (1, 1), (2, -1)}


def test_validation(spark):
    zones = make_zones(
        spark,
        {
            1: [("shell", rectangle(0, 0, 1, 1))],
            2: [("shell", rectangle(179, 0, 181, 1))],
            3: [("shell", rectangle(-179, 0, 179, 1))],
            4: [("shell", [(0, 0), (1, 1)])],
            5: [("shell", rectangle(0, 0, 1, 95))],
        },
    )
    rows = {r.zone_id: r for r in validate_zones(zones).collect()}
    assert [rows[i].valid for i in range(1, 6)] == [True, False, False, False, False]
    assert (rows[2].n_outside, rows[3].n_long_edges, rows[5].n_outside) == (2, 2, 2)
    assert "Exchange" not in plan_of(validate_zones(zones))


def test_no_pairwise_join_in_the_plan(spark):
    plan = plan_of(zone_weights(make_zones(spark, {1: [("shell", rectangle(0, 0, 1, 1))]}), UNIT))
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_winding_is_worked_out_once_per_ring(spark):
    """Above the explode, the shoelace sum would run over the whole ring for every edge."""
    zones = make_zones(spark, {1: [("shell", rectangle(0, 0, 1, 1))]})
    lines = plan_of(zone_weights(zones, UNIT)).splitlines()
    explode = next(i for i, line in enumerate(lines) if "posexplode(pairs" in line)
    assert [i for i, line in enumerate(lines) if "SIGNUM" in line] > [explode]


def test_large_ring(spark):
    """20,000 vertices over a grid of 200 x 200; the area is that of the ring."""
    n = 20_000
    points = [
        ((r := 90 + 5 * math.sin(37 * a)) * math.cos(a) + 100, r * math.sin(a) + 100)
        for a in (2 * math.pi * k / n for k in range(n))
    ]
    spec = GridSpec("l", 0.0, 0.0, 1.0, 1.0, 200, 200)
    total = zone_weights(make_zones(spark, {1: [("shell", points)]}), spec).selectExpr(
        "sum(fraction) AS area", "max(fraction) AS top"
    ).first()
    assert total.area == pytest.approx(ring_area(points), abs=1e-6)
    assert total.top <= 1 + 1e-9


def test_a_zone_of_one_metre_keeps_its_weights(spark):
    spec = GridSpec("w", -180.375, -90.375, 0.75, 0.75, 480, 241)
    side = 1e-5
    zones = make_zones(spark, {1: [("shell", rectangle(10.1, 20.1, 10.1 + side, 20.1 + side))]})
    rows = zone_weights(zones, spec).collect()
    assert len(rows) == 1 and rows[0].fraction == pytest.approx(side * side / 0.75**2, rel=1e-4)


@pytest.mark.parametrize("west, east", [(179.0, 180.0), (179.7, 179.9), (-180.0, -179.5)])
def test_global_grid_closes(spark, west, east):
    spec = GridSpec("w", -180.375, -90.375, 0.75, 0.75, 480, 241)
    zones = make_zones(spark, {1: [("shell", rectangle(west, 0.0, east, 1.0))]})
    rows = zone_weights(zones, spec).collect()
    assert sum(r.fraction for r in rows) * 0.75**2 == pytest.approx(east - west)
    assert all(0 <= r.ix < 480 for r in rows)
    box = footprint(zones, spec)
    assert box.rows >= len(rows) and all(box.ix_min <= r.ix <= box.ix_max for r in rows)


def test_zones_are_dealt_out_before_rings_are_cut(spark, tmp_path):
    path = str(tmp_path / "zones")
    zones = {number: [("shell", rectangle(0.5, 0, 2, 1 + number % 2))] for number in range(40)}
    make_zones(spark, zones).coalesce(1).write.parquet(path)
    weights = zone_weights(spark.read.parquet(path), GridSpec("g", 0.0, 0.0, 1.0, 1.0, 4, 4))
    lines = plan_of(weights).splitlines()
    cut = max(at for at, line in enumerate(lines) if "Generate" in line)
    assert any("Exchange" in line for line in lines[cut:])
    areas = dict(map(tuple, weights.groupBy("zone_id").sum("fraction").collect()))
    assert areas == pytest.approx({number: 1.5 * (1 + number % 2) for number in zones})
