"""Hand-made solids as nested rows."""


def pt(x, y, z):
    return {"x": float(x), "y": float(y), "z": float(z)}


def face(*corners):
    return [[pt(*c) for c in (*corners, corners[0])]]


def box(w, d, h, x=0.0, y=0.0):
    a, b, c, e = (x, y), (x + w, y), (x + w, y + d), (x, y + d)
    side = lambda p, q: face((*p, 0), (*q, 0), (*q, h), (*p, h))
    return [("GroundSurface", face(*((*p, 0) for p in (a, b, c, e)))), *(("WallSurface", side(p, q)) for p, q in ((a, b), (b, c), (c, e), (e, a))), ("RoofSurface", face(*((*p, h) for p in (a, b, c, e))))]


def gable(w, d, h, r):
    m = w / 2
    return [
        ("GroundSurface", face((0, 0, 0), (w, 0, 0), (w, d, 0), (0, d, 0))),
        ("WallSurface", face((0, 0, 0), (w, 0, 0), (w, 0, h), (m, 0, h + r), (0, 0, h))),
        ("WallSurface", face((w, d, 0), (0, d, 0), (0, d, h), (m, d, h + r), (w, d, h))),
        ("WallSurface", face((0, d, 0), (0, 0, 0), (0, 0, h), (0, d, h))),
        ("WallSurface", face((w, 0, 0), (w, d, 0), (w, d, h), (w, 0, h))),
        ("RoofSurface", face((0, 0, h), (m, 0, h + r), (m, d, h + r), (0, d, h))),
        ("RoofSurface", face((m, 0, h + r), (w, 0, h), (w, d, h), (m, d, h + r))),
    ]


CODES = {"GroundSurface": 710, "WallSurface": 709, "RoofSurface": 712}


def child_rows(solid, building=1, flip=False):
    rows = []
    for i, (name, polygon) in enumerate(solid):
        own = [ring[::-1] for ring in polygon] if flip else polygon
        rows.append((f"{building}:{i}", 2, building, building * 100 + i, f"B{building}", f"S{building}-{i}", CODES[name], name, [own]))
    return rows


def child_frame(spark, rows):
    from gableflow import schema

    return spark.createDataFrame(rows, schema.CHILD_FEATURE)
