"""Polygon rings as nested arrays: bounds, area, clipping, intersection, audit, text forms.

A polygon is ``array<array<struct<x,y>>>``: the outer ring first, then holes, each closed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tilelake.functions.grid import box
from tilelake.functions.let import bind
from tilelake.schemas import RING


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Counter-clockwise rectangle, starting at the lower-right corner."""
    return F.array(
        F.array(
            point(maxx, miny), point(maxx, maxy), point(minx, maxy), point(minx, miny),
            point(maxx, miny),
        )
    )


def ring_bounds(rings: Column) -> Column:
    """Bounds of all vertices; NULL without any."""

    def of(vertices: Column) -> Column:
        xs = F.transform(vertices, lambda p: p["x"])
        ys = F.transform(vertices, lambda p: p["y"])
        bounds = box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
        return F.when(F.size(vertices) > 0, bounds)

    return bind(F.flatten(rings), of)


def is_box(rings: Column, bounds: Column) -> Column:
    """True for a polygon that equals its bounds."""
    extent = (bounds["maxx"] - bounds["minx"]) * (bounds["maxy"] - bounds["miny"])
    return (F.size(rings) == 1) & (planar_area(rings) == extent)


def _pairs(ring: Column, make) -> Column:
    """``make(p, q)`` over consecutive vertices."""
    count = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), count), F.slice(ring, F.lit(2), count), make)


def _signed_area(ring: Column) -> Column:
    """Shoelace sum about the first vertex, which keeps the products small."""
    x0, y0 = ring[0]["x"], ring[0]["y"]
    twice = _pairs(
        ring,
        lambda p, q: (p["x"] - x0) * (q["y"] - y0) - (q["x"] - x0) * (p["y"] - y0),
    )
    return F.aggregate(twice, F.lit(0.0), lambda total, v: total + v) / 2


def planar_area(rings: Column) -> Column:
    """Outer area minus holes, in squared units; 0 for points and lines."""
    areas = F.transform(rings, lambda r: F.when(F.size(r) > 0, F.abs(_signed_area(r))).otherwise(0.0))
    holes = F.aggregate(
        F.slice(areas, 2, F.greatest(F.size(areas) - 1, F.lit(0))), F.lit(0.0), lambda t, v: t + v
    )
    return F.when(F.size(rings) > 0, areas[0] - holes).otherwise(F.lit(0.0))


def area_km2(rings: Column) -> Column:
    """Area of a lon/lat polygon in its metric CRS."""
    from tilelake.functions.projections import metric_crs, rings_to_metric

    return planar_area(rings_to_metric(rings, metric_crs(ring_bounds(rings)))) / 1_000_000.0


def _clip_half_plane(ring: Column, side: Column) -> Column:
    """One Sutherland-Hodgman pass keeping ``a*x + b*y + c >= 0`` for an axis-aligned side."""

    def edge(p: Column, q: Column) -> Column:
        dp = side["a"] * p["x"] + side["b"] * p["y"] + side["c"]
        dq = side["a"] * q["x"] + side["b"] * q["y"] + side["c"]
        t = dp / (dp - dq)
        bound = -side["c"] / (side["a"] + side["b"])
        cut = point(
            F.when(side["a"] != 0, bound).otherwise(p["x"] + t * (q["x"] - p["x"])),
            F.when(side["b"] != 0, bound).otherwise(p["y"] + t * (q["y"] - p["y"])),
        )
        none = F.array().cast(RING)
        kept = F.when(dp >= 0, F.array(point(p["x"], p["y"]))).otherwise(none)
        crossing = F.when((dp >= 0) != (dq >= 0), F.array(cut)).otherwise(none)
        return F.concat(kept, crossing)

    return bind(
        F.flatten(_pairs(ring, edge)),
        lambda out: F.when(F.size(out) > 0, F.concat(out, F.slice(out, 1, 1))).otherwise(out),
    )


def _sides(bounds: Column) -> Column:
    def side(a: float, b: float, c: Column) -> Column:
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), c.cast("double").alias("c"))

    return F.array(
        side(1.0, 0.0, -bounds["minx"]), side(-1.0, 0.0, bounds["maxx"]),
        side(0.0, 1.0, -bounds["miny"]), side(0.0, -1.0, bounds["maxy"]),
    )


def clip_to_box(rings: Column, bounds: Column) -> Column:
    """Polygonal part of a polygon inside a box; holes are clipped alike.

    A concave ring may leave zero-width bridges along the box edge: its area is right, but
    intersection tests should use the original ring.
    """
    clip_ring = lambda r: F.aggregate(_sides(bounds), r, _clip_half_plane)
    clipped = F.transform(rings, clip_ring)
    # An empty outer ring means nothing is left; empty holes are simply dropped.
    return bind(
        clipped,
        lambda c: F.when(F.size(c[0]) == 0, F.slice(c, 1, 0)).otherwise(
            F.filter(c, lambda r: F.size(r) > 0)
        ),
    )


def _orient(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def _within(a: Column, b: Column, v: Column) -> Column:
    return (v >= F.least(a, b)) & (v <= F.greatest(a, b))


def _on_segment(p: Column, q: Column, x: Column, y: Column) -> Column:
    return (
        (_orient(p["x"], p["y"], q["x"], q["y"], x, y) == 0)
        & _within(p["x"], q["x"], x) & _within(p["y"], q["y"], y)
    )


def edges(rings: Column) -> Column:
    edge = lambda p, q: F.struct(p.alias("p"), q.alias("q"))
    return F.flatten(F.transform(rings, lambda r: _pairs(r, edge)))


def _on_edges(x: Column, y: Column, border: Column) -> Column:
    return F.exists(border, lambda e: _on_segment(e["p"], e["q"], x, y))


def _inside_or_on(x: Column, y: Column, border: Column) -> Column:
    def crosses(e: Column) -> Column:
        p, q = e["p"], e["q"]
        at = p["x"] + (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) * (q["x"] - p["x"])
        return ((p["y"] > y) != (q["y"] > y)) & F.coalesce(x < at, F.lit(False))

    return (F.size(F.filter(border, crosses)) % 2 == 1) | _on_edges(x, y, border)


def point_in_polygon(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd test with the boundary counted as inside; holes follow from the parity."""
    return bind(edges(rings), lambda border: _inside_or_on(x, y, border))


def segments_touch(e: Column, f: Column) -> Column:
    p, q, r, s = e["p"], e["q"], f["p"], f["q"]
    apart = (
        (F.greatest(p["x"], q["x"]) < F.least(r["x"], s["x"]))
        | (F.greatest(r["x"], s["x"]) < F.least(p["x"], q["x"]))
        | (F.greatest(p["y"], q["y"]) < F.least(r["y"], s["y"]))
        | (F.greatest(r["y"], s["y"]) < F.least(p["y"], q["y"]))
    )
    side = lambda a, b, c: F.signum(
        _orient(a["x"], a["y"], b["x"], b["y"], c["x"], c["y"])
    )
    # Bounding boxes overlap and neither segment lies strictly on one side of the other.
    return ~apart & (side(p, q, r) * side(p, q, s) <= 0) & (side(r, s, p) * side(r, s, q) <= 0)


def edges_meet(rings: Column, border: Column) -> Column:
    """True when an edge of the polygon touches one of the border, or a border edge starts in the polygon."""

    def test(own: Column) -> Column:
        touching = F.exists(own, lambda ea: F.exists(border, lambda eb: segments_touch(ea, eb)))
        return touching | F.exists(border, lambda e: _inside_or_on(e["p"]["x"], e["p"]["y"], own))

    return bind(edges(rings), test)


def polygons_intersect(a: Column, b: Column, b_edges: Column | None = None) -> Column:
    """True when two polygons share at least one point (touching counts).

    ``b_edges`` may hold ``edges(b)``, computed once where ``b`` meets many partners.
    """
    # Without a crossing, either a ring of one lies in the other or nothing is shared. Looking at
    # a vertex of every ring covers geometries of several parts.
    starts_in = lambda rings, border: F.exists(
        rings, lambda r: _inside_or_on(r[0]["x"], r[0]["y"], border)
    )
    border = edges(b) if b_edges is None else b_edges

    def test(e: Column) -> Column:
        crossing = F.exists(
            e["a"], lambda ea: F.exists(e["b"], lambda eb: segments_touch(ea, eb))
        )
        return starts_in(a, e["b"]) | starts_in(b, e["a"]) | crossing

    return bind(F.struct(edges(a).alias("a"), border.alias("b")), test)


def polygons_overlap(a: Column, b: Column) -> Column:
    """True when two polygons share area, not just a border.

    Looks for a proper edge crossing, or for a vertex, an edge midpoint or the vertex mean of
    one that lies strictly inside the other.
    """

    def strictly_inside(x: Column, y: Column, rings: Column) -> Column:
        return point_in_polygon(x, y, rings) & ~_on_edges(x, y, edges(rings))

    def probes(rings: Column) -> Column:
        outer = F.slice(rings[0], F.lit(1), F.size(rings[0]) - 1)
        mean = lambda axis: F.aggregate(
            outer, F.lit(0.0), lambda t, p: t + p[axis]
        ) / F.size(outer)
        middles = _pairs(
            rings[0], lambda p, q: point((p["x"] + q["x"]) / 2, (p["y"] + q["y"]) / 2)
        )
        return F.concat(
            outer, middles,
            F.filter(
                F.array(point(mean("x"), mean("y"))),
                lambda p: point_in_polygon(p["x"], p["y"], rings),
            ),
        )

    def crosses(e: Column, f: Column) -> Column:
        p, q, r, s = e["p"], e["q"], f["p"], f["q"]
        side = lambda u, v, w: F.signum(
            _orient(u["x"], u["y"], v["x"], v["y"], w["x"], w["y"])
        )
        return (side(p, q, r) * side(p, q, s) < 0) & (side(r, s, p) * side(r, s, q) < 0)

    any_inside = lambda u, v: F.exists(
        probes(u), lambda p: strictly_inside(p["x"], p["y"], v)
    )
    crossing = bind(
        F.struct(edges(a).alias("a"), edges(b).alias("b")),
        lambda e: F.exists(e["a"], lambda ea: F.exists(e["b"], lambda eb: crosses(ea, eb))),
    )
    return any_inside(a, b) | any_inside(b, a) | crossing


def adjacent(i: Column, j: Column, count: Column) -> Column:
    """Whether edge ``j``, after ``i``, follows it in a closed ring of ``count`` edges."""
    return (j <= i + 1) | ((i == 0) & (j == count - 1))


def geometry_audit(rings: Column, crossing: Column | None = None) -> Column:
    """Names of the defects that a repair library would have to mend.

    ``crossing`` says whether a ring crosses itself, where that is known; else all pairs of a ring's
    edges are looked at, which suits rings of some dozens (``spatial.audit`` takes any).
    """
    unclosed = F.exists(
        rings, lambda r: (r[0]["x"] != r[F.size(r) - 1]["x"]) | (r[0]["y"] != r[F.size(r) - 1]["y"])
    )
    short = F.exists(rings, lambda r: F.size(r) < 4)

    def crosses_itself(ring: Column) -> Column:
        numbered = F.transform(
            _pairs(ring, lambda p, q: F.struct(p.alias("p"), q.alias("q"))),
            lambda e, i: F.struct(e["p"].alias("p"), e["q"].alias("q"), i.alias("i")),
        )
        return bind(
            numbered,
            lambda es: F.exists(
                es,
                lambda e: F.exists(
                    es,
                    lambda f: (f["i"] > e["i"]) & ~adjacent(e["i"], f["i"], F.size(es)) & segments_touch(e, f),
                ),
            ),
        )

    checks = (
        (F.size(rings) == 0, "empty"),
        (unclosed, "unclosed"),
        (short, "too_few_points"),
        (F.exists(rings, crosses_itself) if crossing is None else crossing, "self_crossing"),
        (planar_area(rings) == 0, "zero_area"),
    )
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in checks]))


def to_geojson(rings: Column) -> Column:
    """Polygon geometry text in lon/lat order."""
    coordinates = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")))


_FRAME = r"(?is)^\s*(MULTI|)POLYGON(?:\s+(?:ZM|Z|M))?\s*(\(.*\))\s*$"
_NUMBER = r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?$"


def wkt_polygons(text: Column) -> Column:
    """Array of polygons from POLYGON or MULTIPOLYGON text; NULL when it is neither.

    Only short patterns are matched: brackets and commas cut the text, and each number is tested by
    itself, so a ring may have any number of vertices.
    """
    many = F.regexp_extract(text, _FRAME, 1) != ""
    tight = F.regexp_replace(F.regexp_extract(text, _FRAME, 2), r"\s*([(),])\s*", "$1")
    body = F.when(many, tight).otherwise(F.concat(F.lit("("), tight, F.lit(")")))
    inner = F.substring(body, F.lit(4), F.greatest(F.char_length(body) - 6, F.lit(0)))
    parts = F.transform(F.split(inner, r"\)\),\(\(", -1), lambda p: F.transform(F.split(p, r"\),\(", -1), lambda r: F.transform(
        F.split(r, ",", -1), lambda v: F.split(v, r"\s+", -1))))
    vertices = F.flatten(F.flatten(parts))
    sound = (
        text.rlike(_FRAME) & F.startswith(body, F.lit("(((")) & F.endswith(body, F.lit(")))"))
        & (many | (F.size(parts) == 1))
        & F.forall(vertices, lambda v: F.size(v).between(2, 4) & F.forall(v, lambda n: n.rlike(_NUMBER)))
    )
    at = lambda v, i: F.get(v, F.lit(i)).try_cast("double")
    polygons = F.transform(parts, lambda p: F.transform(p, lambda r: F.transform(r, lambda v: point(at(v, 0), at(v, 1)))))
    # A ring has to close, as the text format requires.
    closed = F.forall(
        polygons,
        lambda rs: F.forall(
            rs,
            lambda r: (r[0]["x"] == r[F.size(r) - 1]["x"]) & (r[0]["y"] == r[F.size(r) - 1]["y"])
            & (F.size(r) >= 4),
        ),
    )
    return F.when(sound, F.when(closed, polygons))
