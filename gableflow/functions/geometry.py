"""Geometry kernels as native expressions over nested arrays: no Python worker, no shuffle, a fixed order of summation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = 1e-10


def let(value: Column, body) -> Column:
    """body(value) with value computed once: an expression written several times would be evaluated as often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pairs(ring: Column, f) -> Column:
    """f(p, q) for every edge of a closed ring."""
    n = F.size(ring)
    return F.when(n >= 2, F.zip_with(F.slice(ring, 1, n - 1), F.slice(ring, 2, n - 1), f))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def newell(ring: Column, shift_origin: bool = True) -> Column:
    """Newell vector struct(x, y, z) of a closed ring, from differences to its first point; null below two edges."""

    def about(ring: Column, o: Column | None) -> Column:
        at = (lambda p, c: p[c] - o[c]) if shift_origin else (lambda p, c: p[c])
        part = lambda a, b: _total(_pairs(ring, lambda p, q: (p[a] - q[a]) * (at(p, b) + at(q, b))))
        return F.struct(part("y", "z").alias("x"), part("z", "x").alias("y"), part("x", "y").alias("z"))

    own = lambda r: F.when(F.size(r) >= 3, let(F.element_at(r, 1), lambda o: about(r, o)))
    return let(ring, own)


def length(v: Column) -> Column:
    return F.sqrt(v["x"] * v["x"] + v["y"] * v["y"] + v["z"] * v["z"])


def scaled(v: Column, by: Column) -> Column:
    return F.struct(*((v[c] * by).alias(c) for c in "xyz"))


def unit(v: Column) -> Column:
    """v / |v|; null for a degenerate face."""
    by = lambda v: let(length(v), lambda m: F.when(m > ZERO, F.struct(*((v[c] / m).alias(c) for c in "xyz"))))
    return let(v, by)


def plane(ring: Column, shift_origin: bool = True) -> Column:
    """struct(newell, normal) of a closed ring, null for a degenerate one: one expression, so that a filter on it stays cheap."""
    own = lambda v: let(unit(v), lambda u: F.when(u.isNotNull(), F.struct(v.alias("newell"), u.alias("normal"))))
    return let(newell(ring, shift_origin), own)


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def surface_area(polygon: Column, normal: Column) -> Column:
    """Area in the plane of the unit normal: exterior minus holes; null where anything is null."""
    half = lambda ring: let(newell(ring), lambda v: F.abs(dot(v, normal)) / 2)
    flat = half(F.element_at(polygon, 1)) - _total(F.transform(_holes(polygon), half))
    # a face that flattens to nothing: its height times its largest extent in the plane
    return let(flat, lambda a: F.when(a == 0.0, height(polygon) * max_distance_2d(F.element_at(polygon, 1))).otherwise(a))


def _holes(polygon: Column) -> Column:
    return F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0)))


def max_distance_2d(ring: Column) -> Column:
    return F.array_max(F.flatten(F.transform(ring, lambda p: F.transform(ring, lambda q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))))))


def height(polygon: Column) -> Column:
    return let(F.transform(F.flatten(polygon), lambda p: p["z"]), lambda z: F.array_max(z) - F.array_min(z))


def tilt(normal: Column) -> Column:
    """0 for a vertical face, 90 for a level one."""
    return F.degrees(F.asin(F.least(F.abs(normal["z"]), F.lit(1.0))))


def azimuth(normal: Column, convergence: float = 0.0) -> Column:
    """Clockwise from north; -1 for faces that are nearly level."""
    angle = F.pmod(F.lit(450.0 + convergence) - F.degrees(F.atan2(normal["y"], normal["x"])), F.lit(360.0))
    return F.when(F.abs(normal["z"]) > 0.985, F.lit(-1.0)).otherwise(F.round(angle, 2))


def _cross(ring: Column, o: Column) -> Column:
    return _pairs(ring, lambda p, q: (p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"]))


def ring_area_2d(ring: Column) -> Column:
    return let(F.element_at(ring, 1), lambda o: F.abs(_total(_cross(ring, o))) / 2)


def polygon_area_2d(polygon: Column) -> Column:
    """Shoelace area of the projection: exterior minus holes."""
    return ring_area_2d(F.element_at(polygon, 1)) - _total(F.transform(_holes(polygon), ring_area_2d))


def area_2d(multipolygon: Column) -> Column:
    return _total(F.transform(multipolygon, polygon_area_2d))


def _moments(ring: Column, o: Column, sign: Column | int) -> Column:
    """struct(a, x, y): area and first moments about o, positive whatever the ring's direction, times sign."""
    cross = lambda p, q: (p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"])
    a = _total(_pairs(ring, cross)) / 2
    x = _total(_pairs(ring, lambda p, q: (p["x"] + q["x"] - 2 * o["x"]) * cross(p, q))) / 6
    y = _total(_pairs(ring, lambda p, q: (p["y"] + q["y"] - 2 * o["y"]) * cross(p, q))) / 6
    by = lambda m: F.when(m["a"] < 0, -1.0).otherwise(1.0) * sign
    return let(F.struct(a.alias("a"), x.alias("x"), y.alias("y")), lambda m: F.struct(*((m[c] * by(m)).alias(c) for c in "axy")))


def centroid_2d(multipolygon: Column) -> Column:
    """struct(x, y): area-weighted; for a projection without area, such as a wall's, weighted by edge lengths."""

    def about(o: Column) -> Column:
        parts = F.flatten(F.transform(multipolygon, lambda polygon: F.transform(polygon, lambda ring, i: _moments(ring, o, F.when(i == 0, 1.0).otherwise(-1.0)))))
        zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
        sums = F.aggregate(parts, zero, lambda acc, p: F.struct((acc["a"] + p["a"]).alias("a"), (acc["x"] + p["x"]).alias("x"), (acc["y"] + p["y"]).alias("y")))
        long = lambda p, q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))
        rings = F.transform(multipolygon, lambda polygon: F.element_at(polygon, 1))
        over = lambda f: _total(F.transform(rings, lambda ring: _total(_pairs(ring, f))))
        middle = lambda c, total: F.when(total > 0, o[c] + over(lambda p, q: (p[c] + q[c] - 2 * o[c]) / 2 * long(p, q)) / total).otherwise(o[c]).alias(c)
        by_length = let(over(long), lambda total: F.struct(middle("x", total), middle("y", total)))
        return let(sums, lambda m: F.when(m["a"] > ZERO, F.struct((o["x"] + m["x"] / m["a"]).alias("x"), (o["y"] + m["y"] / m["a"]).alias("y"))).otherwise(by_length))

    return F.when(F.size(multipolygon) > 0, let(F.element_at(F.element_at(F.element_at(multipolygon, 1), 1), 1), about))


def interior_point(multipolygon: Column) -> Column:
    """struct(x, y) inside: the middle of the widest inner stretch at half height; null without an inner stretch."""

    def at(mid: Column) -> Column:
        hit = lambda p, q: F.when(((p["y"] <= mid) & (q["y"] > mid)) | ((q["y"] <= mid) & (p["y"] > mid)), p["x"] + (mid - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) * (q["x"] - p["x"]))
        found = F.sort_array(F.filter(F.flatten(F.transform(F.flatten(multipolygon), lambda ring: _pairs(ring, hit))), lambda x: x.isNotNull()))

        def widest(xs: Column) -> Column:
            span = lambda i: F.struct((F.element_at(xs, 2 * i) - F.element_at(xs, 2 * i - 1)).alias("w"), ((F.element_at(xs, 2 * i) + F.element_at(xs, 2 * i - 1)) / 2).alias("x"))
            spans = F.transform(F.sequence(F.lit(1), F.floor(F.size(xs) / 2).cast("int")), span)
            return F.when(F.size(xs) >= 2, F.struct(F.array_max(spans)["x"].alias("x"), mid.alias("y")))

        return let(found, widest)

    ys = F.transform(F.flatten(F.flatten(multipolygon)), lambda p: p["y"])
    return let(let(ys, lambda y: (F.array_min(y) + F.array_max(y)) / 2), at)


def points(multipolygon: Column) -> Column:
    """Closed-ring points over all rings; a rectangle has five."""
    return _total(F.transform(F.flatten(multipolygon), lambda ring: F.size(ring).cast("double"))).cast("int")


def complexity(n: Column) -> Column:
    """0 up to 4 points, 1 up to 10, else 2; null is 2."""
    return F.when(n <= 4, 0).when((n >= 5) & (n <= 10), 1).otherwise(2)


def bbox(multipolygon: Column) -> Column:
    """struct(xmin, ymin, zmin, xmax, ymax, zmax)."""
    side = lambda p, f, c: f(F.transform(p, lambda q: q[c])).alias(c + f.__name__.removeprefix("array_"))
    return let(F.flatten(F.flatten(multipolygon)), lambda p: F.struct(*(side(p, F.array_min, c) for c in "xyz"), *(side(p, F.array_max, c) for c in "xyz")))


def cells(box: Column, size: float, pad: float = 0.0) -> Column:
    """array<struct(cx, cy)>: grid cells, aligned to multiples of size, that the box grown by pad meets."""
    axis = lambda c: F.sequence(F.floor((box[f"{c}min"] - pad) / size).cast("int"), F.floor((box[f"{c}max"] + pad) / size).cast("int"))
    return F.flatten(F.transform(axis("x"), lambda cx: F.transform(axis("y"), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def rotated(ring: Column, nx: Column, ny: Column, nz: Column) -> Column:
    """The ring turned about x, then y, so that the normal points up; for parity tests of the closed form."""
    about_x = F.atan2(ny, nz)
    about_y = -F.atan2(nx, F.sqrt(ny * ny + nz * nz))
    turn = lambda p: F.struct(p["x"].alias("x"), (p["y"] * F.cos(about_x) - p["z"] * F.sin(about_x)).alias("y"), (p["y"] * F.sin(about_x) + p["z"] * F.cos(about_x)).alias("z"))
    tip = lambda p: F.struct((p["x"] * F.cos(about_y) + p["z"] * F.sin(about_y)).alias("x"), p["y"].alias("y"), (-p["x"] * F.sin(about_y) + p["z"] * F.cos(about_y)).alias("z"))
    return F.transform(F.transform(ring, turn), tip)


def collapses_2d(ring: Column) -> Column:
    """Whether the projection has fewer than three corners: all points on the line from the first to the one farthest from it."""

    def about(o: Column) -> Column:
        off = lambda p: (p["x"] - o["x"]) * (p["x"] - o["x"]) + (p["y"] - o["y"]) * (p["y"] - o["y"])
        farthest = F.array_max(F.transform(ring, lambda p: F.struct(off(p).alias("d"), p["x"].alias("x"), p["y"].alias("y"))))
        return let(farthest, lambda q: F.array_max(F.transform(ring, lambda p: F.abs((p["x"] - o["x"]) * (q["y"] - o["y"]) - (q["x"] - o["x"]) * (p["y"] - o["y"])))) == 0.0)

    return let(F.element_at(ring, 1), about)


def corners(ring: Column) -> Column:
    """A closed ring in the plane without repeated points and without points on the line between their neighbours."""

    def bent(pts: Column) -> Column:
        n = F.size(pts)
        at = lambda i: F.element_at(pts, (F.pmod(i, n) + 1).cast("int"))
        turn = lambda a, p, b: (p["x"] - a["x"]) * (b["y"] - p["y"]) - (b["x"] - p["x"]) * (p["y"] - a["y"])
        return let(F.filter(pts, lambda p, i: turn(at(i - 1), p, at(i + 1)) != 0.0), lambda kept: F.concat(kept, F.slice(kept, 1, 1)))

    flat = F.transform(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return let(flat, lambda pts: let(F.filter(pts, lambda p, i: p != F.element_at(pts, (F.pmod(i - 1, F.size(pts)) + 1).cast("int"))), bent))


def same_outline(a: Column, b: Column) -> Column:
    """Equal as planar rings, whatever their start, direction, heights and points on straight edges: equal sets of undirected edges."""
    key = lambda p, q: F.array_sort(F.array(p, q))
    edges = lambda g: F.array_sort(F.flatten(F.filter(F.transform(F.flatten(g), lambda ring: _pairs(corners(ring), key)), lambda e: e.isNotNull())))
    return edges(a) == edges(b)


def envelope(multipolygon: Column) -> Column:
    """The bounding rectangle in the plane as a multipolygon; null without points."""

    def around(b: Column) -> Column:
        corner = lambda x, y: F.struct(b[x].alias("x"), b[y].alias("y"), F.lit(0.0).alias("z"))
        ring = F.array(corner("xmin", "ymin"), corner("xmin", "ymax"), corner("xmax", "ymax"), corner("xmax", "ymin"), corner("xmin", "ymin"))
        return F.when(b["xmin"].isNotNull(), F.array(F.array(ring)))

    return let(bbox(multipolygon), around)


#: Share of the products' size below which the sign of a difference of products is not certain.
DOUBT = 1e-12


def certain_checks(polygon: Column) -> Column:
    """struct(valid, planar) where plain arithmetic is certain, null where only an exact kernel can tell.

    Vertical walls, level faces and faces of three points are planar; walls of two places in the plane have no area and
    are not valid; a ring that turns strictly one way and once around is valid. Points surely off the plane of the first
    three make a face not planar; on a grid of sixteenths the arithmetic is exact.
    """
    pts = F.flatten(polygon)
    diff = lambda p, o: F.struct(*((p[c] - o[c]).alias(c) for c in "xyz"))

    def planar(pts: Column, places: Column) -> Column:
        z = F.transform(pts, lambda p: p["z"])
        easy = (F.array_max(z) == F.array_min(z)) | (F.size(places) <= 2) | (F.size(F.array_distinct(pts)) <= 3)
        whole = lambda v: (v * 16 == F.floor(v * 16)) & (F.abs(v) < 4096)
        exact = lambda vs: F.forall(vs, lambda v: whole(v["x"]) & whole(v["y"]) & whole(v["z"]))

        def off(vs: Column) -> Column:
            u, w = F.element_at(vs, 2), F.element_at(vs, 3)
            cross = lambda a, b: (u[a] * w[b] - u[b] * w[a], F.abs(u[a] * w[b]) + F.abs(u[b] * w[a]))
            (nx, sx), (ny, sy), (nz, sz) = cross("y", "z"), cross("z", "x"), cross("x", "y")
            sure = lambda n, s: F.abs(n) > s * DOUBT
            n = F.struct(nx.alias("x"), ny.alias("y"), nz.alias("z"), (sx + sy + sz).alias("s"), (sure(nx, sx) | sure(ny, sy) | sure(nz, sz)).alias("ok"))

            def against(n: Column) -> Column:
                away = F.transform(vs, lambda v: F.struct(F.abs(n["x"] * v["x"] + n["y"] * v["y"] + n["z"] * v["z"]).alias("d"), (n["s"] * (F.abs(v["x"]) + F.abs(v["y"]) + F.abs(v["z"]))).alias("s")))
                return let(away, lambda d: F.when(n["ok"] & F.exists(d, lambda x: x["d"] > x["s"] * DOUBT), False).when(n["ok"] & F.forall(d, lambda x: x["d"] == 0.0) & exact(vs), True))

            return let(n, against)

        return F.when(easy, True).when(F.size(pts) >= 4, let(F.transform(pts, lambda p: diff(p, F.element_at(pts, 1))), off))

    def valid(pts: Column, places: Column) -> Column:
        ring = F.element_at(polygon, 1)

        def turning(edges: Column) -> Column:
            n = F.size(edges)
            after = lambda i: F.element_at(edges, (F.pmod(i + 1, n) + 1).cast("int"))
            low = lambda e: (e["y"] < 0) | ((e["y"] == 0) & (e["x"] < 0))
            each = F.transform(edges, lambda e, i: let(after(i), lambda f: F.struct((e["x"] * f["y"] - e["y"] * f["x"]).alias("t"), ((F.abs(e["x"] * f["y"]) + F.abs(e["y"] * f["x"])) * DOUBT).alias("s"), (low(e) != low(f)).cast("int").alias("h"))))
            once = lambda ts: F.aggregate(ts, F.lit(0), lambda acc, x: acc + x["h"]) == 2
            one_way = lambda ts: F.forall(ts, lambda x: x["t"] > x["s"]) | F.forall(ts, lambda x: x["t"] < -x["s"])
            return let(each, lambda ts: F.when(one_way(ts) & once(ts), True))

        alone = (F.size(polygon) == 1) & (F.size(ring) >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1))
        return F.when(F.size(places) <= 2, False).when(alone, let(_pairs(ring, lambda p, q: F.struct((q["x"] - p["x"]).alias("x"), (q["y"] - p["y"]).alias("y"))), turning))

    places = F.array_distinct(F.transform(pts, lambda p: F.struct(p["x"], p["y"])))
    return let(places, lambda pl: let(pts, lambda ps: F.struct(valid(ps, pl).alias("valid"), planar(ps, pl).alias("planar"))))
