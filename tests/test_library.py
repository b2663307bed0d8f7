"""Scalars, rows, corrections, validation, sources, workspace and streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gableflow import schema
from gableflow.functions import geometry as G
from gableflow.functions import scalars
from gableflow.operators import buildings as B
from gableflow.operators import corrections as C
from gableflow.operators import faces as FA
from gableflow.operators import matching as M
from gableflow.operators import rows as R
from gableflow.operators import spatial as S
from gableflow.operators import validation as V
from gableflow.plans import cli, fixtures
from gableflow.plans.pipeline import Config, Workspace, extract_features
from gableflow.sources import readers
from gableflow.streaming import corrections as stream

from .solids import box, child_frame, child_rows, face, gable, pt


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_scalars(spark):
    r = one(spark, scalars.r2(F.lit(2.675)).alias("a"), scalars.half_even(F.lit(2.5)).alias("b"), scalars.half_even(F.lit(3.5)).alias("c"), scalars.circular_difference(F.lit(350.0), F.lit(10.0)).alias("d"), scalars.country_code(F.lit(" Czechia ")).alias("e"), scalars.country_code(F.lit("Czech Republic")).alias("f"))
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == (2.68, 2, 4, -20.0, "CZ", None)
    assert scalars.parse_srid("EPSG:25832") == 25832 == scalars.parse_srid("25832")
    for bad in ("", "EPSG:", "-1", "0", "abc"):
        with pytest.raises(ValueError):
            scalars.parse_srid(bad)
    with pytest.raises(ValueError):
        scalars.supported_country("finland")


def test_numeric(spark):
    rows = spark.createDataFrame([(1.5, 2, "3"), (None, 2, "3"), (None, None, "3.5e2"), (None, None, "n/a"), (None, None, None), (None, None, "-.5")], "a double, b long, c string")
    assert [r[0] for r in rows.select(scalars.numeric(F.col("a"), F.col("b"), F.col("c"))).collect()] == [1.5, 2.0, 350.0, None, None, -0.5]


def test_rotation_keeps_the_area(spark):
    tilted = face((0, 0, 0), (4, 0, 3), (4, 5, 3), (0, 5, 0))
    df = spark.createDataFrame([(tilted,)], fixtures_schema()).withColumn("n", G.unit(G.newell(F.element_at("g", 1))))
    turned = G.rotated(F.element_at("g", 1), F.col("n.x"), F.col("n.y"), F.col("n.z"))
    r = df.select(G.surface_area(F.col("g"), F.col("n")).alias("a"), G.ring_area_2d(turned).alias("b"), G.collapses_2d(F.element_at("g", 1)).alias("c")).first()
    assert r.a == pytest.approx(25.0) and r.b == pytest.approx(25.0) and r.c is False


def fixtures_schema():
    return schema.T.StructType([schema.T.StructField("g", schema.POLYGON)])


def test_outline_equality(spark):
    kind = schema.T.StructType([schema.T.StructField("a", schema.MULTIPOLYGON), schema.T.StructField("b", schema.MULTIPOLYGON)])
    square = [pt(0, 0, 0), pt(1, 0, 0), pt(1, 1, 0), pt(0, 1, 0), pt(0, 0, 0)]
    turned = [pt(1, 1, 7), pt(1, 0, 7), pt(0, 0, 7), pt(0, 1, 7), pt(1, 1, 7)]
    other = [pt(0, 0, 0), pt(2, 0, 0), pt(2, 1, 0), pt(0, 1, 0), pt(0, 0, 0)]
    rows = spark.createDataFrame([([[square]], [[turned]]), ([[square]], [[other]])], kind)
    assert [r[0] for r in rows.select(G.same_outline(F.col("a"), F.col("b"))).collect()] == [True, False]


def built(spark, height=6.0, n=1):
    rows = [r for i in range(n) for r in child_rows(box(10, 10, height, x=20.0 * i), building=i + 1)]
    return B.storeys(B.volumes(B.aggregate_buildings(FA.face_attributes(FA.explode_faces(child_frame(spark, rows)), validate=False))))


def test_corrections(spark):
    own = built(spark).withColumn("tabula_variant_code_id", F.lit(7))
    r = C.room_height_correction(own, spark.createDataFrame([(1, 2.0)], "building_feature_id long, new_room_height double")).first()
    assert (r.number_of_storeys, r.area_total_floor, r.room_height) == (3, 300.0, 2.0)
    r = C.storeys_correction(own, spark.createDataFrame([(1, 4)], "building_feature_id long, new_storeys int")).first()
    assert (r.number_of_storeys, r.area_total_floor, r.room_height) == (4, 400.0, 1.5)
    variants = spark.createDataFrame([(1, "near", 600.0, 100.0, 4, 1, 0, 100.0, 240.0, 400.0), (2, "far", 9000.0, 900.0, 9, 2, 2, 900.0, 900.0, 9000.0)], "tabula_variant_code_id int, tabula_variant_code string, " + ", ".join(f"{c} {'int' if c in M.WHOLE else 'double'}" for c in M.DIMENSIONS))
    out = C.apply_corrections(own, variants, storeys=spark.createDataFrame([(1, 4)], "building_feature_id long, new_storeys int")).first()
    assert (out.tabula_variant_code_id, out.tabula_variant_code) == (1, "near")
    untouched = C.apply_corrections(own, variants, storeys=spark.createDataFrame([(1, 2)], "building_feature_id long, new_storeys int")).first()
    assert untouched.tabula_variant_code_id == 7
    stamped = own.withColumns({"created_at": F.lit("2020-01-01").cast("timestamp"), "updated_at": F.lit("2020-01-01").cast("timestamp")})
    assert C.touched(stamped, stamped).first().updated_at.year == 2020
    assert C.touched(stamped, stamped.withColumn("room_height", F.lit(9.0))).first().updated_at.year > 2020


def test_spatial_joins_broadcast_no_geometry(spark, data):
    """Geometries are made of a few columns of a small file, so they look small enough to broadcast whatever their number."""
    own = fixtures.footprints(spark, data)
    found = S.neighbour_pairs(own, 2.0, cell=48.0)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert fixtures.plots(spark, data).rdd.getNumPartitions() == 1 + own.count() // fixtures.PLOTS_A_TASK


def test_matching_in_chunks(spark, data):
    from gableflow.plans.catalogue import _buildings, _variants

    a, b = M.match_variants(_buildings(spark, data), _variants(spark, data)), M.match_variants(_buildings(spark, data), _variants(spark, data), chunk=7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_nearest_rows_are_those_of_trying_all():
    rng = np.random.default_rng(7)
    for rows, step in ((1, 4), (500, 3), (3000, 10)):  # coarse steps make ties
        matrix, points = np.round(rng.random((8, rows)) * step) / step, np.round(rng.random((8, 200)) * step) / step
        d = np.sqrt(sum((p[:, None] - m) ** 2 for p, m in zip(points, matrix, strict=True)))
        at, least = M.nearest_rows(points, matrix, M.tree_over(matrix))
        assert (at == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()


def test_thematic_values_broadcast_no_entities(spark, data):
    labels = spark.createDataFrame([("height", "tilt")], "source_label string, attribute_name string")
    own = V.thematic_values(fixtures.child_features(spark, data), fixtures.properties(spark, data), labels, "building_feature_id")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftSemi, BuildRight" not in plan


def test_a_sequence_is_parsed_once_and_stays_spread(spark, tmp_path):
    head = {"type": "CityJSON", "transform": {"scale": [0.5] * 3, "translate": [1.0, 0.0, 0.0]}}
    solid = {"type": "Solid", "lod": "2.0", "boundaries": [[[[0, 1, 2], [3, 4, 5]], [[0, 2, 1]]]], "semantics": {"surfaces": [{"type": "RoofSurface"}], "values": [[0, None]]}}
    vertices = [[0, 0, 0], [8, 0, 0], [0, 8, 0], [1, 1, 0], [2, 1, 0], [1, 2, 0]]
    lines = [head, *({"type": "CityJSONFeature", "vertices": vertices, "CityObjects": {f"b{i}": {"type": "Building", "geometry": [solid] if i else []}}} for i in range(600))]
    (tmp_path / "city.jsonl").write_text("\n".join(map(json.dumps, lines)))
    model = readers.cityjson(spark, [str(tmp_path / "city.jsonl")])
    assert "InArrow" not in model["geometry_data"]._jdf.queryExecution().executedPlan().toString()
    assert (model["feature"].count(), model["geometry_data"].count()) == (600 + 599, 2 * 599)
    roofs = model["geometry_data"].where("size(geometry) = 1").collect()
    assert {tuple((p.x, p.y, p.z) for p in r.geometry[0][1]) for r in roofs} == {((1.5, 0.5, 0.0), (2.0, 0.5, 0.0), (1.5, 1.0, 0.0), (1.5, 0.5, 0.0))}


def test_link_does_not_depend_on_cells(spark, data):
    own, (res, oth) = fixtures.footprints(spark, data), fixtures.layers(spark, data)
    runs = [sorted(map(str, S.link_footprints(own, res, oth, cell=c).select("object_id", "osm_id", "match_type").collect())) for c in (7.0, 500.0)]
    assert runs[0] == runs[1]


def test_identical_footprints_match_fully(spark):
    own = built(spark, n=2)
    layer = own.where("building_feature_id = 1").select(F.lit("r").alias("osm_id"), F.col("building_footprint_geom").alias("geom"))
    out = {r.object_id: r for r in S.link_footprints(own, layer, layer.limit(0)).collect()}
    assert (out["B1"].match_confidence, out["B1"].match_type, out["B1"].source_layer) == (1.0, 1, "res")
    assert (out["B2"].osm_id, out["B2"].match_type) == (None, 2)


def test_null_confidence_comes_first(spark):
    rows = spark.createDataFrame([("a", "x", "res", 0.9), ("a", "y", "res", None)], "object_id string, osm_id string, source_layer string, confidence double")
    assert S.best_candidates(rows).first().osm_id == "y"


def test_grid_covers_all(spark, data):
    own = fixtures.footprints(spark, data)
    assert S.grid_cells(own, 100000.0).count() <= 4
    ids = {i for r in S.grid_cells(own, 50.0).collect() for i in r.building_ids}
    assert ids == {r[0] for r in own.select("building_feature_id").collect()}


def test_batches(spark):
    df = spark.range(10)
    assert {r.batch for r in R.id_batches(df, "id", 0).collect()} == {0}
    assert [r.batch for r in R.id_batches(df, "id", 4).orderBy("id").collect()] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def checked(spark, walls=(1.0, 500.0), bias=3.0, planar=False, attached=False):
    """Long tables of surfaces and buildings that fire the rules, or not."""
    kind = "surface_feature_id long, classname string, is_valid boolean, is_planar boolean, attribute_name string, calculated_value double, thematic_value double, difference double, percent_error double"
    rows = [(1, "WallSurface", True, True, "surface_area", 1.0, 1.0, walls[0], 1.0), (2, "WallSurface", False, None, "surface_area", 1.0, 1.0, walls[1], 1.0), (3, "RoofSurface", True, planar, "surface_area", 1.0, 1.0, 0.5, 1.0), (3, "RoofSurface", True, planar, "tilt", 1.0, 1.0, 9.0, None)]
    surfaces = spark.createDataFrame(rows, kind)
    buildings = spark.createDataFrame([(1, "max_height", bias, None, attached), (1, "min_height", -bias, 20.0, False)], "building_feature_id long, attribute_name string, difference double, percent_error double, has_attached_neighbour boolean")
    return surfaces, buildings


def test_validation_rules(spark):
    surfaces, buildings = checked(spark)
    rules = {r.rule: (r.value, r.fires) for r in V.takeaway_rules(surfaces, buildings, failed=2).collect()}
    assert rules == {"A": (500.0, True), "B": (3.0, True), "C": (1.0, True), "D": (2.0, True), "E": (0.0, True)}
    calm = {r.rule: r.fires for r in V.takeaway_rules(*checked(spark, (1.0, 99.0), 0.9, True, True)).collect()}
    assert calm == dict.fromkeys("ABCDE", False)
    low = {r.rule: r.fires for r in V.takeaway_rules(*checked(spark, bias=-3.0)).collect()}
    assert low["B"] is False  # only heights that are too large count, and only the maximal ones
    said = V.takeaways(surfaces, buildings, failed=2)
    assert len(said) == 7 and "500.0 times" in said[1] and any("3.00 m" in t for t in said)
    summary = V.error_summary(buildings)
    text = V.report({"Errors": summary}, said)
    assert "| min_height |" in text and "## Errors" in text and text.startswith("# Validation report")
    tex = V.report({"Errors": summary}, said, "latex")
    assert r"min\_height" in tex and tex.count(r"\begin{tabular}") == tex.count(r"\end{tabular}") == 1
    lines = spark.createDataFrame([("batch 1 start",), ("Batch 1 failed",), ("retrying",), ("batch 2 complete",)], "value string")
    assert tuple(V.batch_lines(lines).first()) == (1, 1, 1, 1)
    assert V.latest_run(["validation_1", "x", "validation_3"]) == "validation_3"
    with pytest.raises(FileNotFoundError):
        V.latest_run([])
    config = {"attributes": {"parent": {"h": {"computed_columns": ["min_height", "max_height"], "source_label": "height", "unit": "m"}, "x": {"computed_column": "y", "source_label": ""}}, "child": {"roof": {"a": {"computed_column": "surface_area", "source_label": "area"}}}}}
    assert {(r.level, r.attribute_name) for r in V.mapping(spark, config).collect()} == {("parent", "min_height"), ("parent", "max_height"), ("child.roof", "surface_area")}


def test_archetype_sheet(spark, tmp_path):
    (tmp_path / "germany.csv").write_text(",".join(schema.TABULA.names) + "\n1,TEST.VARIANT.001,1,1990,2000,500.0,150.0,3,Regular,B_Alone,Simple,60.0,,40.0,40.0,,145.0,SFH\n")
    r = M.archetypes(readers.archetype_sheet(spark, str(tmp_path), "germany")).first()
    assert (r.footprint_area, r.footprint_complexity, r.attached_neighbour_class, r.roof_complexity, r.area_total_roof, r.area_total_wall, r.area_total_floor, r.building_size_class, r.number_of_storeys, r.max_volume) == (50.0, 1, 0, 0, 60.0, 80.0, 145.0, 0, 3, 500.0)


def city(solids, lod="2.2", semantics=True):
    """CityJSON of solids {name: [(class, polygon)]}: vertices in millimetres."""
    index, objects = {}, {}
    for name, solid in solids.items():
        faces = [[[index.setdefault(tuple(p.values()), len(index)) for p in ring[:-1]] for ring in polygon] for _, polygon in solid]
        meaning = {"semantics": {"surfaces": [{"type": n} for n, _ in solid], "values": [list(range(len(solid)))]}} if semantics else {}
        objects[name] = {"type": "Building", "attributes": {"measuredHeight": 10.5}, "geometry": [{"type": "Solid", "lod": lod, "boundaries": [faces], **meaning}]}
    return {"type": "CityJSON", "version": "1.1", "transform": {"scale": [0.001] * 3, "translate": [0.0] * 3}, "vertices": [[v * 1000 for v in p] for p in index], "CityObjects": objects}


def moved(solid, dx):
    return [(n, [[p | {"x": p["x"] + dx} for p in ring] for ring in polygon]) for n, polygon in solid]


def cityjson(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(city({"house": gable(10, 8, 5, 5)})))
    return str(tmp_path / "a.json")


def gml_polygon(polygon, name=""):
    return f"<gml:Polygon{name}><gml:exterior><gml:LinearRing><gml:posList>{' '.join(f'{p['x']} {p['y']} {p['z']}' for p in polygon[0])}</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon>"


def citygml(tmp_path):
    body = "".join(f"<bldg:boundedBy><bldg:{n}>{gml_polygon(p)}</bldg:{n}></bldg:boundedBy>" for n, p in gable(10, 8, 5, 5))
    (tmp_path / "a.gml").write_text(f'<CityModel><cityObjectMember><bldg:Building gml:id="house"><bldg:measuredHeight uom="m">10.5</bldg:measuredHeight>{body}</bldg:Building></cityObjectMember></CityModel>')
    return str(tmp_path / "a.gml")


def test_two_houses_keep_their_own_surfaces(spark, tmp_path):
    """Adjoining houses share what touches, and a neighbour's solid is nobody's surface."""
    (tmp_path / "two.json").write_text(json.dumps(city({"a": gable(10, 8, 5, 5), "b": moved(gable(10, 8, 5, 5), 40)})))
    model = readers.cityjson(spark, str(tmp_path / "two.json")) | {"objectclass": readers.objectclass(spark)}
    far = extract_features(model, spark.createDataFrame([], schema.TABULA_VARIANT), Config())
    assert {r.object_id: (r.surface_count_wall, r.footprint_area) for r in far.building.collect()} == {"a": (4, 80.0), "b": (4, 80.0)}
    (tmp_path / "near.json").write_text(json.dumps(city({"a": gable(10, 8, 5, 5), "b": moved(gable(10, 8, 5, 5), 10)})))
    model = readers.cityjson(spark, str(tmp_path / "near.json")) | {"objectclass": readers.objectclass(spark)}
    near = extract_features(model, spark.createDataFrame([], schema.TABULA_VARIANT), Config())
    assert {r.classname for r in near.surface_raw.select("classname").collect()} == {"WallSurface", "RoofSurface", "GroundSurface"}
    assert {r.surface_type for r in near.surface.collect()} == {"WallSurface", "RoofSurface", "GroundSurface"} and near.surface.count() == 14


def test_levels_parts_and_solids_without_semantics(spark, tmp_path):
    box = gable(10, 8, 5, 5)
    doc = city({"house": box, "bare": moved(box, 50)}, semantics=False)
    doc["CityObjects"]["house"]["geometry"].append(city({"house": box}, "3.0")["CityObjects"]["house"]["geometry"][0])
    (tmp_path / "levels.json").write_text(json.dumps(doc))
    two, three = (readers.cityjson(spark, str(tmp_path / "levels.json"), lod=lod) for lod in (2, 3))
    assert {r.objectid for r in two["feature"].collect()} == {"house", "bare"} and two["property"].where("name = 'lod2Solid'").count() == 2
    assert three["feature"].count() == 2 + len(box) and three["property"].where("name = 'lod3Solid'").count() == 1
    walls = "".join(f"<bldg:boundedBy><bldg:{n}><bldg:lod2MultiSurface>{gml_polygon(p)}</bldg:lod2MultiSurface><bldg:lod3MultiSurface>{gml_polygon(p)}{gml_polygon(p)}</bldg:lod3MultiSurface></bldg:{n}></bldg:boundedBy>" for n, p in box)
    solid = "<bldg:lod2Solid><gml:Solid>" + "".join(gml_polygon(p) for _, p in box) + "</gml:Solid></bldg:lod2Solid>"
    part = f'<bldg:consistsOfBuildingPart><bldg:BuildingPart gml:id="part">{solid}</bldg:BuildingPart></bldg:consistsOfBuildingPart>'
    (tmp_path / "levels.gml").write_text(f'<CityModel><cityObjectMember><bldg:Building gml:id="whole">{walls}{part}</bldg:Building></cityObjectMember></CityModel>')
    model = readers.citygml(spark, str(tmp_path / "levels.gml"))
    faces = {r.objectid: r.n for r in model["feature"].join(model["geometry_data"], F.col("id") == F.col("feature_id")).select("objectid", F.size("geometry").alias("n")).collect()}
    assert faces["whole"] == faces["part"] == len(box) and all(faces[f"whole_{i}"] == 1 for i in range(1, len(box) + 1))
    assert {r.objectclass_id for r in model["feature"].where("objectid in ('whole', 'part')").collect()} == {901, 902}


def test_folder_with_both_formats_and_none(spark, tmp_path):
    cityjson(tmp_path)
    text = (tmp_path / "a.json").read_text()
    citygml(tmp_path)
    (tmp_path / "a.gml").write_text((tmp_path / "a.gml").read_text().replace('"house"', '"other"'))
    line = json.loads(text)
    head = {"type": "CityJSON", "transform": line["transform"], "vertices": [], "CityObjects": {}}
    feature = {"type": "CityJSONFeature", "vertices": line["vertices"], "CityObjects": {"third": line["CityObjects"]["house"]}}
    (tmp_path / "b.jsonl").write_text(json.dumps(head) + "\n" + json.dumps(feature) + "\n")
    model = readers.city_model(spark, str(tmp_path))
    solids = model["property"].where("name = 'lod2Solid'").select("feature_id").join(model["feature"], F.col("id") == F.col("feature_id")).join(model["geometry_data"], "feature_id")
    assert {(r.objectid, r.a) for r in solids.select("objectid", F.round(G.height(F.flatten("geometry")), 6).alias("a")).collect()} == {("house", 10.0), ("other", 10.0), ("third", 10.0)}
    assert readers.city_model(spark, str(tmp_path / "nowhere")) is None and readers.city_model(spark, str(tmp_path / "a.json"))["feature"].count() == 8


def test_ids_do_not_collide(spark):
    many = spark.range(300_000).select(F.concat(F.lit("DEBW_001"), F.col("id")).alias("objectid")).withColumn("id", readers.number_of(F.col("objectid")))
    assert many.select("id").distinct().count() == 300_000 and many.where("id < 0").count() == 0
    readers.verify_ids(many)
    with pytest.raises(ValueError, match="share the id"):
        readers.verify_ids(spark.createDataFrame([(1, "a"), (1, "b")], "id long, objectid string"))


@pytest.mark.parametrize("kind", ["json", "gml"])
def test_from_file_to_features(spark, tmp_path, kind):
    model = readers.cityjson(spark, cityjson(tmp_path)) if kind == "json" else readers.citygml(spark, citygml(tmp_path))
    assert readers.cityjson(spark, cityjson(tmp_path), existing=spark.createDataFrame([("house",)], "objectid string"))["feature"].count() == 0
    assert [r.val_string for r in model["property"].where("name = 'measuredHeight'").collect()] == ["10.5"]
    model["objectclass"] = readers.objectclass(spark)
    out = extract_features(model, spark.createDataFrame([], schema.TABULA_VARIANT), Config())
    b = out.building.first()
    assert (b.footprint_area, b.area_total_roof, b.min_height, b.max_height, b.country_code, b.tabula_variant_code_id) == (80.0, 113.14, 10.0, 15.0, "DE", None)
    assert out.surface.count() == 7
    again = extract_features(model, spark.createDataFrame([], schema.TABULA_VARIANT), Config(), done=out.building)
    assert again.building.count() == 0


def test_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("COUNTRY", "germany")
    sheet = ",".join(schema.TABULA.names) + "\n1,TEST.VARIANT.001,1,1990,2000,500.0,150.0,3,Regular,B_Alone,Simple,60.0,,40.0,40.0,,145.0,SFH\n"
    (tmp_path / "germany.csv").write_text(sheet)
    run = lambda *args: cli.main(["--database", "city_lod_test", *args], spark)
    assert run("--create-db", "--import-archetypes", str(tmp_path), "--import-model", cityjson(tmp_path), "--extract-features") == 0
    own = Workspace(spark, "city_lod_test")
    assert own.read("building").first().tabula_variant_code == "TEST.VARIANT.001"
    assert "city_lod_test" in own.schemas()
    assert run("--extract-features") == 0 and own.read("building").count() == 1 and own.read("surface").count() == 7
    assert own.read("pipeline_status").count() == 1 and own.read("surface").where("is_valid is not null and created_at is not null").count() == 7
    footprint = own.read("building").first().building_footprint_geom
    layer = spark.createDataFrame([("r1", footprint)], schema.OSM_LAYER)
    layer = S.reproject(layer, "geom", 25832, 3035)
    layer.write.parquet(str(tmp_path / "res"))
    layer.limit(0).write.parquet(str(tmp_path / "oth"))
    for _ in range(2):
        assert run("--link", str(tmp_path / "res"), str(tmp_path / "oth")) == 0
    links = own.read("building_link").collect()
    assert [(r.osm_id, r.match_type) for r in links] == [("r1", 1)] and links[0].match_confidence > 0.999
    # another level of detail of the same building stands beside it, and is not taken as done
    (tmp_path / "three.json").write_text(json.dumps(city({"house": gable(10, 8, 5, 5), "next": moved(gable(10, 8, 5, 5), 10)}, "3.0")))
    assert run("--lod", "3", "--import-model", str(tmp_path / "three.json"), "--extract-features", "--flag-neighbours") == 0
    assert own.read("building", 3).count() == 2 and own.read("building").count() == 1
    assert {(r.has_attached_neighbour, r.total_attached_neighbour) for r in own.read("building", 3).collect()} == {(True, 1)} and own.read("building_neighbours", 3).count() == 1
    config = {"attributes": {"parent": {"h": {"computed_columns": ["max_height"], "source_label": "measuredHeight"}}, "child": {"roof": {"a": {"computed_column": "surface_area", "source_label": "area"}}}}}
    (tmp_path / "map.json").write_text(json.dumps(config))
    assert run("--validate", str(tmp_path / "map.json"), "--output", f"file://{tmp_path}/out") == 0
    assert "max_height" in "".join(r.value for r in spark.read.text(f"{tmp_path}/out/validation_lod2/report_markdown").collect())
    assert spark.read.csv(f"{tmp_path}/out/validation_lod2/detail_buildings.csv", header=True).first().difference == "4.5"
    # scoped resets go on with what else is asked for
    assert run("--reset-db", "derived", "--extract-features") == 0 and own.read("building").count() == 1 and own.read("building_link").count() == 0
    assert run("--reset-db", "source", "--reset-db", "derived", "--import-model", cityjson(tmp_path)) == 0 and own.read("building").count() == 0 and own.read("feature").count() == 8
    assert run("--import-model", str(tmp_path / "missing")) == 0
    with pytest.raises(ValueError, match="COUNTRY.*"):
        Config.from_env({"COUNTRY": "atlantis", "ROOM_HEIGHT": "-1"})


def test_correction_stream(spark, tmp_path):
    table = {"now": built(spark, n=2)}
    kind = schema.table("building_feature_id:l kind:s number:d footprint:m at:t")
    spark.createDataFrame([(1, "storeys", 4.0, None, None), (2, "room_height", 2.0, None, None)], kind).write.parquet(str(tmp_path / "edits"))
    source = spark.readStream.schema(kind).parquet(str(tmp_path / "edits"))

    def write(df):
        df.write.mode("overwrite").parquet(str(tmp_path / "out"))
        table["now"] = spark.read.parquet(str(tmp_path / "out"))

    stream.correct_stream(source, lambda: table["now"], write, spark.createDataFrame([], schema.TABULA_VARIANT), str(tmp_path / "ckpt")).awaitTermination()
    assert {r.building_feature_id: r.number_of_storeys for r in table["now"].collect()} == {1: 4, 2: 3}


def test_upsert_keeps_columns(spark):
    old = spark.createDataFrame([(1, "a", 5)], "k int, v string, s int")
    new = spark.createDataFrame([(1, "b", 6), (2, "c", 7)], "k int, v string, s int")
    assert sorted(map(tuple, R.upsert(old, new, "k", keep=("s",)).collect())) == [(1, "b", 5), (2, "c", 7)]
