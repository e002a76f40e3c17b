"""Readers, cleaning, sinks, archives, links, warehouse options."""

import datetime as dt
import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from placelens import schemas
from placelens.operators.cleaning import clean_places
from placelens.sources import sinks, tables
from placelens.sources.archives import parse_place_lines, read_archives
from placelens.sources.links import page_links
from placelens.sources import shapes as shapes_source
from placelens.sources.shapes import keyed_shapes, read_shapes
from placelens.sources.warehouse import jdbc_options
from tests.conftest import plan_of, rows


def raw_line(i, name="Town", lat="1.5", lon="2.5", code="PPL", country="AA", pop="7", elev="", date="2020-02-03"):
    cells = [str(i), name, "ascii", "alt", lat, lon, "P", code, country, "", "", "", "", "", pop, elev, "9", "UTC", date]
    return "\t".join(cells)


@pytest.fixture
def raw_dir(tmp_path):
    lines = [
        raw_line(1),
        raw_line(2, name='"Unbalanced'),
        raw_line(3, lat="", pop="", elev="12"),
        raw_line(4, lat="NaN", pop="0"),
        raw_line(5, name="", country=""),
    ]
    folder = tmp_path / "raw"
    folder.mkdir()
    with gzip.open(folder / "AA.csv.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    return str(folder)


def test_raw_quote_is_ordinary(spark, raw_dir):
    raw = tables.read_raw_places(spark, raw_dir)
    assert raw.columns == [c.split()[0] for c in schemas.RAW_PLACES.split(", ")]
    got = {r.geonameid: r for r in raw.collect()}
    assert len(got) == 5
    assert got[2].name == '"Unbalanced' and got[2].latitude == 1.5 and got[2].country_code == "AA"
    assert got[1].modification_date == dt.date(2020, 2, 3)


def test_bad_lines_are_set_aside_and_counted(spark, tmp_path):
    good = [raw_line(1), raw_line(2, name='"Unbalanced'), raw_line(3, lat="", pop="", elev="")]
    bad = ["x\tTown", raw_line("four"), raw_line(5, lat="north"), raw_line(6, date="2020-13-45"), raw_line(7) + "\tmore", "no tabs at all"]
    (tmp_path / "AA.csv").write_text("\n".join([*good[:2], "", *bad]) + "\n")
    with gzip.open(tmp_path / "BB.csv.gz", "wt") as f:
        f.write(good[2] + "\n")
    checked = tables.read_checked(spark, str(tmp_path))
    kept, aside = tables.good_rows(checked), tables.bad_rows(checked)
    assert kept.columns == tables.read_raw_places(spark, str(tmp_path)).columns
    assert sorted(r.geonameid for r in kept.collect()) == [1, 2, 3]
    assert sorted(r.bad_line for r in aside.collect()) == sorted(bad)
    assert rows(kept, "name") == [("\"Unbalanced",), ("Town",), ("Town",)]
    assert kept.orderBy("geonameid").collect() == tables.read_raw_places(spark, str(tmp_path)).where("geonameid in (1, 2, 3)").orderBy("geonameid").collect()
    counts = {r.file.rsplit("/", 1)[-1]: (r.n_lines, r.n_bad) for r in tables.line_counts(checked).collect()}
    assert counts == {"AA.csv": (8, 6), "BB.csv.gz": (1, 0)}
    sinks.write_quarantine(aside, str(tmp_path / "quarantine"))
    again = spark.read.parquet(str(tmp_path / "quarantine"))
    assert again.count() + kept.count() == len(good) + len(bad) and again.columns == ["file", "bad_line"]


def test_bad_lines_of_a_dimension(spark, tmp_path):
    path = tmp_path / "info.csv"
    path.write_text('Aland,Capital,10,20,EU,1,"BB,CC"\nBland,Capital,wide,20,EU,2,\nCland,Capital\n')
    checked = tables.read_checked(spark, str(path), schemas.COUNTRY_INFO, raw=False)
    assert [(r.country, r.neighbours) for r in tables.good_rows(checked).collect()] == [("Aland", "BB,CC")]
    assert len(tables.bad_rows(checked).collect()) == 2


def test_cleaning_fills(spark, raw_dir):
    clean = clean_places(tables.read_raw_places(spark, raw_dir))
    assert clean.columns == [c.split()[0] for c in schemas.CLEAN_PLACES.split(", ")]
    got = {r.geonameid: r for r in clean.collect()}
    assert (got[3].latitude, got[3].population, got[3].elevation) == (0.0, 0, 12)
    assert (got[4].latitude, got[4].population) == (0.0, 0)
    assert got[1].elevation is None
    assert (got[5].name, got[5].country_code) == ("", "")


def test_cleaning_can_drop_unlocated(spark, raw_dir):
    kept = clean_places(tables.read_raw_places(spark, raw_dir), drop_unlocated=True)
    assert sorted(r.geonameid for r in kept.collect()) == [1, 2, 5]


def test_cleaning_plan_has_no_shuffle(spark, raw_dir):
    assert "Exchange" not in plan_of(clean_places(tables.read_raw_places(spark, raw_dir)))


def test_parquet_sink_round_trip_and_pruning(spark, raw_dir, tmp_path):
    clean = clean_places(tables.read_raw_places(spark, raw_dir))
    out = str(tmp_path / "clean")
    sinks.write_places(clean, out)
    sinks.write_places(clean, out)
    back = tables.read_places(spark, out)
    assert rows(back, *clean.columns) == rows(clean)
    one = back.filter(F.col("country_code") == "AA").select("geonameid")
    plan = plan_of(one)
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert "ReadSchema: struct<geonameid:bigint>" in plan
    assert one.count() == 4


def test_numeric_country_folders_stay_strings(spark, tmp_path):
    df = spark.createDataFrame([(1, "07"), (2, "7")], "geonameid BIGINT, country_code STRING")
    wide = df.selectExpr(
        "geonameid", "'n' name", "0D latitude", "0D longitude", "'P' feature_class", "'X' feature_code",
        "country_code", "0L population", "1 elevation", "'UTC' timezone", "date'2020-01-01' modification_date",
    )
    sinks.write_places(wide, str(tmp_path / "p"))
    back = tables.read_places(spark, str(tmp_path / "p"))
    assert rows(back, "geonameid", "country_code") == [(1, "07"), (2, "7")]


def test_clean_csv_eleven_and_twelve_columns(spark, raw_dir, tmp_path):
    clean = clean_places(tables.read_raw_places(spark, raw_dir)).filter("geonameid < 5")
    out = str(tmp_path / "csv")
    sinks.write_places_csv(clean.withColumn("country", F.lit("Land, of commas")), out)
    narrow = tables.read_places_csv(spark, out)
    wide = tables.read_places_csv(spark, out, with_country=True)
    assert len(narrow.columns) == 11 and len(wide.columns) == 12
    assert narrow.count() == 4
    assert {r.country for r in wide.collect()} == {"Land, of commas"}


def test_dimension_readers(spark, tmp_path):
    (tmp_path / "info").mkdir()
    (tmp_path / "info" / "a.csv").write_text('Aland,Cap,100,2000,EU,5,"BB,CC"\nBland,Cap,1,2,AS,6,\n')
    info = {r.country: r for r in tables.read_country_info(spark, str(tmp_path / "info")).collect()}
    assert info["Aland"].neighbours == "BB,CC" and info["Aland"].geonameid == 5
    assert info["Bland"].neighbours is None
    for name, reader, line, width in [
        ("codes", tables.read_feature_codes, "S,HSP,hospital,a hospital\n", 4),
        ("mapping", tables.read_country_mapping, "AA,Aland\n", 2),
        ("dist", tables.read_class_distribution, 'AA,P,"city, village",3,Aland\n', 5),
    ]:
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(line)
        df = reader(spark, str(tmp_path / name))
        assert len(df.columns) == width and df.count() == 1
    assert tables.class_names(spark).count() == 9


def test_views(spark):
    tables.register_views({"class_names_view": tables.class_names(spark)})
    found = spark.sql(
        "SELECT feature_class_description AS d FROM class_names_view WHERE feature_class = :letter",
        args={"letter": "U"},
    )
    assert found.first().d == "undersea"


SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]
FAR = [[10, 10], [12, 10], [12, 12], [10, 12], [10, 10]]


def geojson(crs=None):
    doc = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"geoNameId": "11", "area": 3},
             "geometry": {"type": "Polygon", "coordinates": [SQUARE, HOLE]}},
            {"type": "Feature", "properties": {"geoNameId": "12"},
             "geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE], [FAR]]}},
        ],
    }
    if crs:
        doc["crs"] = {"type": "name", "properties": {"name": crs}}
    return json.dumps(doc, indent=1)


def test_shapes(spark, tmp_path):
    path = tmp_path / "shapes.json"
    path.write_text(geojson("EPSG:4326"))
    shapes = keyed_shapes(read_shapes(spark, str(path)))
    assert dict(shapes.dtypes)["geonameid"] == "bigint"
    got = {r.geonameid: r.polygons for r in shapes.collect()}
    assert [[len(p) for p in got[11]], [len(p) for p in got[12]]] == [[2], [1, 1]]
    assert got[12][1][0][2] == [12.0, 12.0]


def test_shapes_in_another_system_fail(spark, tmp_path):
    path = tmp_path / "shapes.json"
    path.write_text(geojson("EPSG:2154"))
    with pytest.raises(Exception, match="unsupported reference system"):
        read_shapes(spark, str(path)).collect()


def test_mercator_shapes_are_turned_into_degrees(spark, tmp_path):
    corners = [(0.0, 0.0), (179.5, 85.0), (-120.25, -60.5), (13.4, 52.5), (0.0, 0.0)]
    table = spark.createDataFrame(corners, "lon double, lat double")
    metres = table.select(*[c.alias(n) for c, n in zip(shapes_source.degrees_to_mercator(F.col("lon"), F.col("lat")), "xy")]).collect()
    ring = [[r.x, r.y] for r in metres]
    assert ring[1][0] == pytest.approx(19981848.597, abs=1e-3) and ring[1][1] == pytest.approx(19971868.880, abs=1e-3)
    feature = {"type": "Feature", "properties": {"geoNameId": "1"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
    crs = {"type": "name", "properties": {"name": "EPSG:3857"}}
    for name, doc in (("head", {"type": "FeatureCollection", "crs": crs, "features": [feature]}), ("end", {"type": "FeatureCollection", "features": [feature, feature], "crs": crs})):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    plain = {"type": "FeatureCollection", "features": [{**feature, "geometry": {"type": "Polygon", "coordinates": [corners]}}]}
    (tmp_path / "plain.json").write_text(json.dumps(plain))
    got = read_shapes(spark, str(tmp_path)).collect()
    assert len(got) == 4
    for r in got:
        assert [x for p in r.polygons[0][0] for x in p] == pytest.approx([x for p in corners for x in p], abs=1e-9)


def test_one_large_file_of_shapes_is_read_by_several_tasks(spark, tmp_path):
    features = [
        {"type": "Feature", "id": i, "properties": {"name": 'a "Feature" é { [', "geoNameId": str(i)},
         "geometry": {"type": "Polygon", "coordinates": [[[i, 0.5], [i + 1, 0.5], [i + 1, 1.5 + j / 7], [i, 0.5]] for j in range(40)]}}
        for i in range(2000)
    ]
    features += [{"type": "Feature", "properties": None, "geometry": None}, {"type": "Feature", "properties": {"geoNameId": "9"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]
    want = [(f["properties"]["geoNameId"], [f["geometry"]["coordinates"]]) for f in features[:2000]]
    for indent in (None, 1):
        path = tmp_path / f"indent{indent}.json"
        path.write_text(json.dumps({"type": "FeatureCollection", "name": "x", "features": features, "bbox": [0, 0, 1, 1]}, indent=indent, ensure_ascii=False))
        usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 5))
        shapes = read_shapes(spark, str(path))
        assert shapes.rdd.getNumPartitions() >= 4
        got = sorted(((r.geoNameId, r.polygons) for r in shapes.collect()), key=lambda r: int(r[0]))
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
        assert got == want
    lines = tmp_path / "lines.geojsonl"
    lines.write_text("\n".join(json.dumps(f) for f in features) + "\n\n")
    assert sorted(((r.geoNameId, r.polygons) for r in read_shapes(spark, str(lines), lines=True).collect()), key=lambda r: int(r[0])) == want
    broken = tmp_path / "broken.json"
    broken.write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"geoNameId":"1"},"geometry":{"type":"Polygon","coordinates":[[[0,')
    with pytest.raises(Exception, match="unreadable feature"):
        read_shapes(spark, str(broken)).collect()


def test_archives(spark, tmp_path):
    for stem in ("AA", "BB"):
        with zipfile.ZipFile(tmp_path / f"{stem}.zip", "w") as z:
            z.writestr(f"{stem}.txt", "\n".join(raw_line(i, name=f"{stem}é{i}") for i in range(25_000)) + "\n")
            z.writestr("readme.txt", "do not load\n")
    (tmp_path / "notes.txt").write_text("not an archive")
    lines = read_archives(spark, str(tmp_path))
    assert {(r.archive, r["count"]) for r in lines.groupBy("archive").count().collect()} == {
        ("AA", 25_000), ("BB", 25_000),
    }
    places = parse_place_lines(lines, schemas.RAW_PLACES)
    one = places.filter("archive = 'BB' AND geonameid = 24999").first()
    assert (one.name, one.latitude, one.elevation, one.modification_date) == (
        "BBé24999", 1.5, None, dt.date(2020, 2, 3),
    )
    out = str(tmp_path / "out")
    sinks.write_archive_lines(lines, out)
    assert list((tmp_path / "out" / "archive=AA").glob("*.gz"))
    assert tables.read_raw_places(spark, out + "/archive=AA").count() == 25_000


def test_links(spark):
    html = (
        '<a href="AA.zip">x</a> <A class="k" HREF=\'BB.zip\'>x</A> <a href="ABC.zip">x</a>'
        '<a href="AA.txt">x</a><a href="../">up</a><a name="top">no target</a>'
        '<!-- <a href="CC.zip">old</a> --><a href=DD.zip>bare</a><abbr href="EE.zip">no anchor</abbr>'
        '<a data-href="FF.zip">not a link</a><a\nhref="G&amp;.zip">x</a>'
    )
    pages = spark.createDataFrame([(1, "u", html), (2, "u", "nothing")], "page_id BIGINT, url STRING, html STRING")
    found = page_links(pages, "http://h.org/dump/", "zip", 2)
    assert rows(found, "page_id", "link") == [(1, "AA.zip"), (1, "BB.zip"), (1, "DD.zip"), (1, "G&.zip")]
    first = found.filter("link = 'AA.zip'").first()
    assert first.url == "http://h.org/dump//AA.zip" and first.file_name == "AA.zip"


def test_warehouse_options(monkeypatch):
    monkeypatch.setenv("WAREHOUSE_USER", "u")
    monkeypatch.delenv("WAREHOUSE_PASSWORD", raising=False)
    plain = jdbc_options("jdbc:postgresql://h/db", "select 1;\n")
    assert plain == {"url": "jdbc:postgresql://h/db", "fetchsize": "10000", "user": "u", "query": "select 1"}
    split = jdbc_options("jdbc:x", "select * from t", "id", 0, 900, partitions=9)
    assert split["dbtable"] == "(select * from t) AS q" and "query" not in split
    assert (split["partitionColumn"], split["upperBound"], split["numPartitions"]) == ("id", "900", "9")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "select 1", "id")


def test_place_lines_that_are_short_or_blank(spark):
    lines = spark.createDataFrame([("A", "1\tx"), ("A", ""), ("A", "2\ty\t3.5")], "archive string, line string")
    out = parse_place_lines(lines, "id INT, name STRING, size DOUBLE")
    assert sorted(map(tuple, out.collect())) == [("A", 1, "x", None), ("A", 2, "y", 3.5)]
