"""Golden values of hand-made solids: faces and building records."""

import math

import pytest

from gableflow.operators import buildings as B
from gableflow.operators import faces as FA

from .solids import box, child_frame, child_rows, gable


def features(spark, rows):
    raw = FA.face_attributes(FA.explode_faces(child_frame(spark, rows)))
    return raw, B.storeys(B.volumes(B.aggregate_buildings(raw)))


@pytest.mark.parametrize("flip", [False, True])
def test_box(spark, flip):
    raw, built = features(spark, child_rows(box(10, 8, 5), flip=flip))
    walls = sorted((r.azimuth, r.surface_area, r.tilt, r.height) for r in raw.where("classname = 'WallSurface'").collect())
    assert walls == [(0.0, 50.0, 0.0, 5.0), (90.0, 40.0, 0.0, 5.0), (180.0, 50.0, 0.0, 5.0), (270.0, 40.0, 0.0, 5.0)]
    level = raw.where("classname <> 'WallSurface'").collect()
    assert {(r.surface_area, r.tilt, r.azimuth, r.height) for r in level} == {(80.0, 90.0, -1.0, 0.0)}
    assert {r.classname: (r.is_valid, r.is_planar) for r in raw.collect()} == {"GroundSurface": (True, True), "RoofSurface": (True, True), "WallSurface": (False, True)}
    b = built.first()
    assert (b.footprint_area, b.area_total_roof, b.area_total_wall, b.area_total_floor) == (80.0, 80.0, 180.0, 160.0)
    assert (b.min_height, b.max_height, b.min_volume, b.max_volume, b.number_of_storeys) == (5.0, 5.0, 400.0, 400.0, 2)
    assert (b.footprint_complexity, b.roof_complexity, b.surface_count_floor) == (1, 0, 0)
    assert (b.building_centroid.x, b.building_centroid.y) == (5.0, 4.0)


@pytest.mark.parametrize("flip", [False, True])
def test_gable_counts_the_rise_twice(spark, flip):
    raw, built = features(spark, child_rows(gable(10, 8, 5, 5), flip=flip))
    roofs = sorted((r.azimuth, r.surface_area, r.tilt, r.height) for r in raw.where("classname = 'RoofSurface'").collect())
    assert roofs == [(90.0, 56.57, 45.0, 5.0), (270.0, 56.57, 45.0, 5.0)]
    ends = {(r.azimuth, r.surface_area, r.height) for r in raw.where("surface_area = 75").collect()}
    assert ends == {(180.0, 75.0, 10.0), (0.0, 75.0, 10.0)}
    b = built.first()
    assert (b.min_height, b.max_height, b.number_of_storeys, b.min_volume, b.max_volume, b.area_total_floor) == (10.0, 15.0, 4, 800.0, 1200.0, 320.0)
    assert (b.area_total_roof, b.area_total_wall, b.footprint_complexity, b.roof_complexity) == (113.14, 230.0, 1, 1)


def test_without_ground_walls_turn(spark):
    rows = [r for r in child_rows(gable(10, 8, 5, 5)) if r[7] != "GroundSurface"]
    raw, built = features(spark, rows)
    assert sorted(r.azimuth for r in raw.where("surface_area = 75").collect()) == [0.0, 180.0]
    kept = FA.face_attributes(FA.explode_faces(child_frame(spark, rows)), missing_ground_flip=1.0)
    turn = {r.surface_feature_id: r.azimuth for r in raw.where("classname = 'WallSurface'").collect()}
    same = {r.surface_feature_id: r.azimuth for r in kept.where("classname = 'WallSurface'").collect()}
    assert all(math.isclose((turn[k] - same[k]) % 360, 180.0) for k in turn)
    b = built.first()
    assert b.footprint_area is None and b.min_volume is None and b.area_total_floor is None and b.footprint_complexity == 2


@pytest.mark.parametrize(("height", "storeys"), [(6.25, 2), (8.75, 4)])
def test_storeys_round_half_to_even(spark, height, storeys):
    assert features(spark, child_rows(box(10, 8, height)))[1].first().number_of_storeys == storeys


def test_hole_and_far_coordinates(spark):
    from .solids import face

    hole = [[{"x": p["x"] + 5e5, "y": p["y"] + 5e6, "z": p["z"]} for p in ring] for ring in (face((0, 0, 0), (10, 0, 0), (10, 10, 0), (0, 10, 0))[0], face((2, 2, 0), (2, 4, 0), (4, 4, 0), (4, 2, 0))[0])]
    raw, built = features(spark, child_rows([("GroundSurface", hole)]))
    assert raw.first().surface_area == 96.0 and raw.first().is_valid
    b = built.first()
    assert (b.footprint_area, b.footprint_complexity, b.roof_complexity, b.number_of_storeys) == (96.0, 1, 2, 1)
    assert b.max_height is None and b.area_total_wall == 0.0


def test_degenerate_face_is_dropped(spark):
    from .solids import face

    raw, _ = features(spark, child_rows([*box(4, 4, 3), ("WallSurface", face((0, 0, 0), (1, 0, 0), (2, 0, 0)))]))
    assert raw.count() == 6


def test_window_and_higher_order_normals_agree(spark, data):
    from gableflow.plans import fixtures

    faces = FA.explode_faces(fixtures.child_features(spark, data))
    keys = ("building_feature_id", "surface_feature_id", "face_idx")
    a = {tuple(r[k] for k in keys): (r.nx, r.ny, r.nz) for r in FA.newell_relational(faces, *keys).collect()}
    b = {tuple(r[k] for k in keys): r.newell for r in FA.normals(faces).collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k][i] - b[k][c]) < 1e-6 for k in a for i, c in enumerate("xyz"))
