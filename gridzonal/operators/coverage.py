"""Polygon x grid overlay: the exact fraction of each cell that a zone covers.

The area under a polygon's boundary is a signed sum over its edges. Each edge is cut first
at the cell columns it spans and then at the cell rows it crosses, so the work is the number of
boundary crossings. A cut piece adds a partial area to the cells it runs through and its whole
width to every cell below it in that column. The second part is not written out per cell: one
running sum down each (zone, column) supplies it, and the gaps between boundary cells, where
the covered width is constant, are expanded at the end. Total rows are boundary crossings plus
result cells, and a zone of any size is spread over tasks by column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.schema import GridSpec

# What is left of terms that cancel is rounding noise up to this part of their sizes, and so is what the rounding of
# coordinates alone can make; beyond that the size of a zone plays no role.
NOISE = 1e-12
# Pieces flatter than this are integrated as horizontal.
FLAT = 1e-9


def zone_edges(zones: DataFrame) -> DataFrame:
    """One row per ring edge, with the ring's winding folded into ``weight``.

    ``weight`` makes the area under the edges come out positive for shells and negative for
    holes, whichever way the source winds its rings. Rings may be closed or left open.
    """
    rings = zones.selectExpr("zone_id", "posexplode(rings) AS (ring, r)").where("size(r.pts) >= 3")
    paired = rings.selectExpr(
        "zone_id",
        "ring",
        "r.role AS role",
        "zip_with(r.pts, concat(slice(r.pts, 2, size(r.pts) - 1), slice(r.pts, 1, 1)), (a, b) -> struct(a, b)) AS pairs",
    )
    # Twice the shoelace area. Coordinates relative to the first vertex keep it well conditioned.
    twice_area = """aggregate(pairs, 0D, (total, p) -> total
        + (p.a.lon - pairs[0].a.lon) * (p.b.lat - pairs[0].a.lat)
        - (p.b.lon - pairs[0].a.lon) * (p.a.lat - pairs[0].a.lat))"""
    # A step of its own: next to the explode it would be worked out again for every edge.
    wound = paired.selectExpr(
        "zone_id", "ring", "role", "pairs", f"CAST(-signum({twice_area}) * if(role = 'hole', -1, 1) AS INT) AS weight"
    )
    return wound.selectExpr("zone_id", "ring", "role", "weight", "posexplode(pairs) AS (edge, e)").selectExpr(
        "zone_id",
        "ring",
        "role",
        "edge",
        "e.a.lon AS lon_a",
        "e.a.lat AS lat_a",
        "e.b.lon AS lon_b",
        "e.b.lat AS lat_b",
        "weight",
    )


def _double(number: float) -> str:
    return f"({float(number)!r}D)"


def _index(position: str, origin: float, step: float) -> str:
    return f"CAST(floor(({position} - {_double(origin)}) / {_double(step)}) AS INT)"


def _column_pieces(edges: DataFrame, spec: GridSpec) -> DataFrame:
    """Edges cut at column borders, left end first: (zone_id, ix, sign, width, ya, yb)."""
    ends = edges.where("lon_a <> lon_b").selectExpr(
        "zone_id",
        "CAST(if(lon_a < lon_b, weight, -weight) AS DOUBLE) AS sign",
        "least(lon_a, lon_b) AS lx",
        "greatest(lon_a, lon_b) AS hx",
        "if(lon_a < lon_b, lat_a, lat_b) AS ly",
        "if(lon_a < lon_b, lat_b, lat_a) AS hy",
    )
    spanned = (
        ends.selectExpr(
            "*",
            # The columns of a closed grid go on around the globe.
            f"{_index('lx', spec.lon0, spec.dlon)} AS first" if spec.closed
            else f"greatest({_index('lx', spec.lon0, spec.dlon)}, 0) AS first",
            f"{_index('hx', spec.lon0, spec.dlon)} AS last" if spec.closed
            else f"least({_index('hx', spec.lon0, spec.dlon)}, {spec.nx - 1}) AS last",
        )
        .where("first <= last")
        .selectExpr("zone_id", "sign", "lx", "hx", "ly", "hy", "explode(sequence(first, last)) AS ix")
    )
    lon0, dlon = _double(spec.lon0), _double(spec.dlon)
    return (
        spanned.selectExpr(
            "*",
            f"greatest(lx, {lon0} + ix * {dlon}) AS xa",
            f"least(hx, {lon0} + (ix + 1) * {dlon}) AS xb",
        )
        .where("xa < xb")
        .selectExpr(
            "zone_id",
            f"CAST(pmod(ix, {spec.nx}) AS INT) AS ix",
            "sign",
            "xb - xa AS width",
            "ly + (hy - ly) / (hx - lx) * (xa - lx) AS ya",
            "ly + (hy - ly) / (hx - lx) * (xb - lx) AS yb",
        )
    )


def _row_pieces(pieces: DataFrame, spec: GridSpec) -> DataFrame:
    """Column pieces cut at row borders: (zone_id, ix, iy, part, below).

    ``part`` is signed area inside cell (iy, ix) and ``below`` the signed width to add to every
    cell further down. Row ``ny`` stands for everything above the grid.
    """
    low, high = (_index(f"{pick}(ya, yb)", spec.lat0, spec.dlat) for pick in ("least", "greatest"))
    height, ny = _double(spec.dlat), spec.ny
    # ua and ub are the heights of the piece's ends over the cell's southern border.
    crossed = (
        pieces.selectExpr("*", f"{low} AS low", f"{high} AS high")
        .where("high >= 0")
        .selectExpr(
            "zone_id", "ix", "sign", "width", "ya", "yb", "low",
            f"""explode(sequence(least(greatest(low, 0), {ny}),
                greatest(least(high, {ny - 1}), least(greatest(low, 0), {ny})))) AS iy""",
        )
        .selectExpr(
            "*",
            f"ya - ({_double(spec.lat0)} + iy * {height}) AS ua",
            f"yb - ({_double(spec.lat0)} + iy * {height}) AS ub",
        )
    )

    def integral(u: str) -> str:
        """Integral of the height under u inside the cell, clamped to its rows."""
        return f"""CASE WHEN {u} <= 0 THEN 0D WHEN {u} < {height} THEN {u} * {u} / 2
            ELSE {height} * ({u} - {height} / 2) END"""

    area = f"""CASE WHEN abs(ub - ua) < {_double(FLAT)}
        THEN least(greatest((ua + ub) / 2, 0D), {height}) * width
        ELSE width / (ub - ua) * ({integral('ub')} - {integral('ua')}) END"""
    return crossed.selectExpr(
        "zone_id",
        "ix",
        "iy",
        f"if(iy = {ny}, 0D, sign * {area}) AS part",
        f"if(iy = low OR iy = {ny}, sign * width, 0D) AS below",
    )


def edge_weights(edges: DataFrame, spec: GridSpec) -> DataFrame:
    """Cell fractions from edges: (grid_id, zone_id, iy, ix, fraction)."""
    boundary = (
        _row_pieces(_column_pieces(edges, spec), spec)
        .groupBy("zone_id", "ix", "iy")
        .agg(
            F.sum("part").alias("part"),
            F.sum("below").alias("below"),
            F.sum(F.abs("part")).alias("part_size"),
            F.sum(F.abs("below")).alias("below_size"),
        )
    )
    down = "(PARTITION BY zone_id, ix ORDER BY iy DESC"
    height, width = _double(spec.dlat), _double(spec.dlon)
    # Each boundary cell is a run of its own, followed downwards by the gap to the next one.
    runs = boundary.selectExpr(
        "zone_id",
        "ix",
        "iy",
        "part",
        f"coalesce(sum(below) OVER {down} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) AS before",
        f"sum(below) OVER {down} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after",
        f"lead(iy, 1, -1) OVER {down}) AS next_iy",
        "part_size",
        f"coalesce(sum(below_size) OVER {down} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) AS before_size",
        f"sum(below_size) OVER {down} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS after_size",
    ).selectExpr(
        "zone_id",
        "ix",
        f"""stack(2, iy, iy, (part / {height} + before) / {width}, (part_size / {height} + before_size) / {width},
            iy - 1, next_iy + 1, after / {width}, after_size / {width}) AS (top, bottom, fraction, terms)""",
    )
    # The gap is empty when the next boundary cell is adjacent. Below the last one it reaches to the
    # grid's southern border; it has no width left there unless the zone goes on beyond that.
    return runs.where(
        f"bottom <= top AND top < {spec.ny} AND fraction > {_double(NOISE)} * terms + {_double(spec.rounding)}"
    ).select(
        F.lit(spec.grid_id).alias("grid_id"),
        "zone_id",
        F.expr("explode(sequence(bottom, top))").alias("iy"),
        "ix",
        "fraction",
    )


def spread_zones(zones: DataFrame) -> DataFrame:
    """(zone_id, rings), dealt over tasks before rings are cut.

    A row group is read by one task, and rings are small next to the cells they cross: without this, one task would
    hold the cells of all zones of a row group. The hash is of whole rows, so that parts of one zone are spread too.
    """
    return zones.select("zone_id", "rings").repartition(F.xxhash64("zone_id", "rings"))


def zone_weights(zones: DataFrame, spec: GridSpec) -> DataFrame:
    """Coverage fraction of every cell a zone touches; constant per (grid, zone layer)."""
    return edge_weights(zone_edges(spread_zones(zones)), spec)


@dataclass(frozen=True)
class Footprint:
    """Where the zones lie on the grid, and an upper bound on the number of weight rows."""

    rows: int
    iy_min: int
    iy_max: int
    ix_min: int
    ix_max: int
    zones: int = 0

    @property
    def cells(self) -> int:
        """Cells of the bounding box."""
        return (self.iy_max - self.iy_min + 1) * (self.ix_max - self.ix_min + 1)


def footprint(zones: DataFrame, spec: GridSpec) -> Footprint:
    """Bounding cells of the zone layer and the sum of its zones' box sizes.

    Runs one job over the zone table and brings back a single row. A zone cannot cover more cells
    than its box, so ``rows`` proves how large the weights can get before they are computed.
    """

    def extreme(pick: str, axis: str) -> str:
        return f"array_{pick}(transform(rings, r -> array_{pick}(transform(r.pts, p -> p.{axis}))))"

    def low(axis: str, origin: float, step: float) -> str:
        index = _index(extreme("min", axis), origin, step)
        return index if axis == "lon" and spec.closed else f"greatest({index}, 0)"

    def high(axis: str, origin: float, step: float, n: int) -> str:
        index = _index(extreme("max", axis), origin, step)
        return index if axis == "lon" and spec.closed else f"least({index}, {n - 1})"

    box = zones.selectExpr(
        f"{low('lon', spec.lon0, spec.dlon)} AS w",
        f"{high('lon', spec.lon0, spec.dlon, spec.nx)} AS e",
        f"{low('lat', spec.lat0, spec.dlat)} AS s",
        f"{high('lat', spec.lat0, spec.dlat, spec.ny)} AS n",
    )
    on_grid = "w <= e AND s <= n"
    row = (
        box.selectExpr("*", f"{on_grid} AS hit")
        .selectExpr("hit", "if(hit, w, NULL) AS w", "if(hit, e, NULL) AS e", "if(hit, s, NULL) AS s", "if(hit, n, NULL) AS n")
        .selectExpr(
            "count(1) AS zones",
            f"sum(CAST(least(e - w + 1, {spec.nx}) AS BIGINT) * (n - s + 1)) AS rows",
            "min(s) AS s",
            "max(n) AS n",
            "min(w) AS w",
            "max(e) AS e",
        )
        .first()
    )
    if row["rows"] is None:
        return Footprint(0, 0, -1, 0, -1, row["zones"])
    if row["w"] < 0 or row["e"] >= spec.nx:
        # Some zone lies across the seam of a closed grid.
        return Footprint(row["rows"], row["s"], row["n"], 0, spec.nx - 1, row["zones"])
    return Footprint(row["rows"], row["s"], row["n"], row["w"], row["e"], row["zones"])


def validate_zones(zones: DataFrame) -> DataFrame:
    """Per zone: vertices outside lon/lat range, edges longer than 180 degrees, and a verdict.

    A zone that crosses the antimeridian shows up as a long edge and must be split by the caller.
    Everything is counted inside the zone's own row, without a shuffle.
    """

    return zones.selectExpr("zone_id", *[f"{sql} AS {name}" for name, sql in _fault_counts().items()]).selectExpr(
        "zone_id",
        "n_vertices",
        "n_outside",
        "n_long_edges",
        "n_short_rings",
        "n_vertices > 0 AND n_outside = 0 AND n_long_edges = 0 AND n_short_rings = 0 AS valid",
    )


def _fault_counts() -> dict[str, str]:
    """What is counted in a zone's rings: SQL by name."""

    def total(per_ring: str) -> str:
        return f"CAST(coalesce(aggregate(rings, 0, (n, r) -> n + {per_ring}), 0) AS BIGINT)"

    outside = "p.lon IS NULL OR p.lat IS NULL OR NOT (abs(p.lon) <= 180 AND abs(p.lat) <= 90) OR isnan(p.lon) OR isnan(p.lat)"
    following = "concat(slice(r.pts, 2, greatest(size(r.pts) - 1, 0)), slice(r.pts, 1, 1))"
    return {
        "n_vertices": total("size(r.pts)"),
        "n_outside": total(f"size(filter(r.pts, p -> {outside}))"),
        "n_long_edges": total(f"size(filter(zip_with(r.pts, {following}, (a, b) -> abs(b.lon - a.lon)), d -> d > 180))"),
        "n_short_rings": total("if(size(r.pts) < 3, 1, 0)"),
    }


def require_valid(zones: DataFrame) -> DataFrame:
    """``zones`` as they are; a zone that ``validate_zones`` faults stops the job with its id and counts.

    The checks are expressions over the zone's own row, so there is no second scan and no shuffle.
    """
    checked = zones.withColumns({name: F.expr(sql) for name, sql in _fault_counts().items()})
    faults = F.concat_ws(", ", *[F.concat(F.lit(f"{name} "), F.col(name).cast("string")) for name in _fault_counts()])
    bad = F.raise_error(F.concat(F.lit("zone "), F.coalesce(F.col("zone_id").cast("string"), F.lit("NULL")), F.lit(" is not valid: "), faults))
    sound = "n_vertices > 0 AND n_outside = 0 AND n_long_edges = 0 AND n_short_rings = 0"
    return checked.select("zone_id", F.when(F.expr(sound), F.col("rings")).otherwise(bad).alias("rings"))
