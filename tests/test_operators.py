"""Golden cases for selection, facility, neighbour and profile operators."""

import pytest
from pyspark.sql import functions as F

from placelens.functions.text import after_first_dot, before_first_dot
from placelens.operators import facility, profile, selection
from placelens.plans import analyses
from placelens.plans.joins import join_dimension, measured_bytes, planner_limit, salted_join
from placelens.sources.tables import class_names
from tests.conftest import plan_of, rows

CODES = "feature_class STRING, feature_code STRING, short_description STRING, long_description STRING"
PLACES = "geonameid BIGINT, country_code STRING, feature_class STRING, feature_code STRING"
INFO = (
    "country STRING, capital STRING, area_sq_km BIGINT, population BIGINT, "
    "continent STRING, geonameid BIGINT, neighbours STRING"
)


@pytest.fixture
def codes(spark):
    return spark.createDataFrame(
        [
            ("S", "HSP", "hospital", "place for the sick"),
            ("S", "HSPU", "Hospital", "upper case"),
            ("S", "HSPW", "hospital wing", None),
            ("S", "HSPM", "military hospital", "x"),
            ("S", "PHAR", "pharmacy", "x"),
            ("S", "CTRM", None, "a medical centre"),
            ("S", "SCH", "school", "teaches medical students"),
            ("S", "SCH", "school", "teaches medical students"),
            ("S", "UNI", "x", "university"),
        ],
        CODES,
    )


def test_keyword_groups(codes):
    health = selection.keyword_features(codes, selection.keyword_group("health"))
    assert rows(health, "feature_code") == [("CTRM",), ("HSP",), ("HSPM",), ("HSPW",), ("SCH",)]
    school = selection.keyword_features(codes, selection.keyword_group("school"))
    assert rows(school, "feature_code") == [("SCH",)]
    with pytest.raises(ValueError, match="health, school"):
        selection.keyword_group("war")


def test_union_form_is_the_same(codes):
    for group in selection.KEYWORD_GROUPS.values():
        one = selection.keyword_features(codes, group)
        assert rows(one) == rows(selection.keyword_features_union(codes, group))


def test_suffix_words(codes):
    found = selection.suffix_features(codes)
    assert rows(found, "feature_code") == [("HSP",), ("HSPM",), ("PHAR",)]


def test_dots(spark):
    df = spark.createDataFrame([("AA.txt.gz",), ("plain",)], "f STRING")
    assert rows(df.select(before_first_dot(F.col("f")), after_first_dot(F.col("f")))) == [
        ("AA", "txt"), ("plain", ""),
    ]


@pytest.fixture
def world(spark):
    """Three countries with neighbours, one island, one country without facilities."""
    info = spark.createDataFrame(
        [
            ("Aland", "a", 10, 1200, "EU", 1, "BB,CC,ZZ"),
            ("Bland", "b", 20, 900, "EU", 2, "AA"),
            ("Cland", "c", 30, 400, "AS", 3, ""),
            ("Dland", "d", 40, 50, "AS", 4, "AA"),
        ],
        INFO,
    )
    own = [(1, "AA"), (2, "BB"), (3, "CC"), (4, "DD")]
    places = [(i, c, "A", "PCLI") for i, c in own]
    places += [(100 + i, "AA", "S", "HSP") for i in range(3)]
    places += [(200, "AA", "T", "HSP"), (201, "BB", "S", "HSP"), (202, "CC", "S", "CLN"), (203, None, "S", "HSP")]
    places += [(300 + i, "BB", "S", "CLN") for i in range(2)]
    matched = spark.createDataFrame(
        [("S", "HSP", "hospital", "x"), ("T", "HSP", "hospital hill", "x"), ("S", "CLN", "medical", "x")], CODES
    )
    return spark.createDataFrame(places, PLACES), matched, info


def test_facility_counts_on_code_alone_fan_out(world):
    places, matched, info = world
    got = rows(facility.facility_counts(places, matched, info), "country_code", "feature_class", "feature_code", "n", "geonameid")
    assert got == [
        ("AA", "S", "HSP", 4, 1), ("AA", "T", "HSP", 4, 1),
        ("BB", "S", "CLN", 2, 2), ("BB", "S", "HSP", 1, 2), ("BB", "T", "HSP", 1, 2),
        ("CC", "S", "CLN", 1, 3),
    ]


def test_facility_counts_on_class_and_code(world):
    places, matched, info = world
    got = rows(
        facility.facility_counts(places, matched, info, ["feature_class", "feature_code"]),
        "country_code", "feature_class", "feature_code", "n",
    )
    assert got == [
        ("AA", "S", "HSP", 3), ("AA", "T", "HSP", 1), ("BB", "S", "CLN", 2), ("BB", "S", "HSP", 1), ("CC", "S", "CLN", 1),
    ]
    with pytest.raises(ValueError):
        facility.facility_counts(places, matched, info, ["name"])


def test_one_pass_counts_equal_joining_the_places_twice(world):
    places, matched, info = world
    owners = selection.country_codes(places, info).select(
        "country_code", "geonameid", "population", "area_sq_km", "neighbours"
    )
    twice = (
        facility.code_counts(places)
        .join(matched.select("feature_code", "feature_class"), "feature_code")
        .join(owners, "country_code")
    )
    once = facility.facility_counts(places, matched, info)
    assert rows(once) == rows(twice.select(*once.columns))


def test_country_listed_twice_in_the_places(world, spark):
    places, matched, info = world
    doubled = places.union(spark.createDataFrame([(1, "AA", "A", "PCLI")], PLACES))
    got = facility.facility_counts(doubled, matched, info).filter("country_code = 'AA' AND feature_class = 'S'")
    assert got.count() == 2


def test_totals_repeat_per_class(world):
    totals = facility.country_totals(facility.facility_counts(*world))
    assert rows(totals, "country_code", "feature_class", "total") == [
        ("AA", "S", 8), ("AA", "T", 8), ("BB", "S", 4), ("BB", "T", 4), ("CC", "S", 1),
    ]


def test_window_total_equals_join_back(world):
    counts = facility.facility_counts(*world)
    back = counts.groupBy("country_code").agg(F.sum("n").alias("total")).join(counts, "country_code")
    totals = facility.country_totals(counts)
    assert rows(totals) == rows(back.select(*totals.columns).distinct())


def test_index_scaled_and_log(world):
    places, matched, info = world
    scaled = facility.country_index_scaled(facility.country_index(facility.country_totals(facility.facility_counts(places, matched, info))))
    got = {r.country_code: r for r in facility.country_index_log(scaled).collect()}
    assert (got["AA"].index_by_class, got["BB"].index_by_class, got["CC"].index_by_class) == (150.0, 225.0, 400.0)
    assert (got["AA"].scaled_index, got["BB"].scaled_index, got["CC"].scaled_index) == (0.0, 0.3, 1.0)
    assert (got["AA"].shade, got["BB"].shade, got["CC"].shade) == (None, 0.0, 1.0)


def test_scaling_one_country_and_none(world):
    places, matched, info = world
    one = facility.country_index(facility.country_totals(facility.facility_counts(places, matched, info.filter("geonameid = 3"))))
    assert [r.scaled_index for r in facility.country_index_scaled(one).collect()] == [None]
    none = one.filter("country_code = 'XX'")
    assert facility.country_index_log(facility.country_index_scaled(none)).collect() == []


def test_code_index_described_fans_out_again(world):
    places, matched, info = world
    described = analyses.code_index_of_country(
        places, matched, info, {"short_description": ["hospital"]}, country_code="BB"
    )
    assert rows(described, "feature_class", "described_class", "n", "index_by_code") == [
        ("S", "S", 1, 900.0), ("S", "T", 1, 900.0), ("T", "S", 1, 900.0), ("T", "T", 1, 900.0),
    ]


def test_neighbours(world):
    index = facility.country_index(facility.country_totals(facility.facility_counts(*world)))
    got = rows(facility.neighbour_compare(index), "subject", "country_code", "is_self", "feature_class")
    assert got == [
        ("AA", "AA", True, "S"), ("AA", "AA", True, "T"), ("AA", "BB", False, "S"),
        ("AA", "BB", False, "T"), ("AA", "CC", False, "S"),
        ("BB", "AA", False, "S"), ("BB", "AA", False, "T"), ("BB", "BB", True, "S"), ("BB", "BB", True, "T"),
    ]
    assert facility.neighbour_compare(index, "CC").count() == 0
    assert facility.neighbour_compare(index, "DD").count() == 0
    null_list = index.withColumn("neighbours", F.lit(None).cast("string"))
    assert facility.neighbour_compare(null_list).count() == 0


def test_enrich_keeps_unmapped(world, spark):
    mapping = spark.createDataFrame([("AA", "Aland")], "country_code STRING, country STRING")
    enriched = selection.enrich_places(world[0], mapping)
    assert enriched.count() == world[0].count()
    assert enriched.filter("country IS NULL").select("country_code").distinct().count() == 4


def test_country_geoname(world, spark):
    mapping = spark.createDataFrame([("AA", "Aland"), ("XX", "Nowhere")], "country_code STRING, country STRING")
    assert rows(selection.country_geoname(mapping, world[2]), "country_code", "geonameid") == [("AA", 1)]


DIST = "country_code STRING, feature_class STRING, feature_description STRING, no_of_features BIGINT, country STRING"


def test_profile(spark, world):
    mapping = spark.createDataFrame(
        [("AA", "Aland"), ("BB", "Bland"), ("CC", "Cland")], "country_code STRING, country STRING"
    )
    dist = profile.class_distribution(world[0], class_names(spark), mapping)
    assert rows(dist, "country_code", "feature_class", "no_of_features") == [
        ("AA", "A", 1), ("AA", "S", 3), ("AA", "T", 1), ("BB", "A", 1), ("BB", "S", 3), ("CC", "A", 1), ("CC", "S", 1),
    ]
    total = profile.class_share(dist).groupBy("country").agg(F.round(F.sum("share"), 9).alias("s"))
    assert {r.s for r in total.collect()} == {1.0}
    assert rows(profile.class_descriptions(dist)) == [
        ("country,state,region",), ("mountain,hill,rock",), ("spot, building, farm",),
    ]
    # ties: A and T in Aland, A and S in Cland
    assert rows(profile.extreme_classes(dist), "country_code", "kind", "feature_class") == [
        ("AA", "max", "S"), ("AA", "min", "A"), ("BB", "max", "S"), ("BB", "min", "A"), ("CC", "max", "A"), ("CC", "min", "A"),
    ]


def test_class_lookup(spark):
    asked = spark.createDataFrame([("undersea",), ("Undersea",)], "feature_description STRING")
    assert rows(profile.class_lookup(asked, class_names(spark))) == [("undersea", "U")]


def test_advice_without_rule_is_null(spark):
    dist = spark.createDataFrame([("AA", "V", "forest,heath", 5, "Aland"), ("AA", "H", "stream, lake", 2, "Aland")], DIST)
    advice = profile.class_advice(profile.extreme_classes(dist), profile.advice_rules(spark))
    assert rows(advice, "kind", "feature_class", "advice") == [("max", "V", None), ("min", "H", "store_water")]


def test_code_share_ignores_codes_without_description(spark):
    places = spark.createDataFrame(
        [(1, "P", "X"), (2, "P", "X"), (3, "P", "Y"), (4, "P", "NEW"), (5, "P", None), (6, "S", "X")],
        "geonameid BIGINT, feature_class STRING, feature_code STRING",
    ).withColumn("country", F.lit("Aland"))
    codes = spark.createDataFrame([("P", "X", "x", ""), ("P", "Y", "y", "")], CODES)
    counts = profile.class_code_counts(places, "Aland", "P")
    assert rows(counts, "feature_code", "no_of_feature_code") == [("NEW", 1), ("X", 2), ("Y", 1), (None, 0)]
    shares = rows(profile.code_share(counts, codes), "feature_code", "percentage_of_feature")
    assert [(c, round(s, 6)) for c, s in shares] == [("X", 0.666667), ("Y", 0.333333)]


def test_two_key_join_does_not_fan_out(world):
    places, matched, _ = world
    assert selection.places_with_codes(places.filter("country_code = 'AA'"), matched).count() == 4
    assert selection.feature_points(places.filter("country_code = 'AA'"), matched).count() == 8


# Join strategies.


def test_small_dimension_is_broadcast(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").withColumnRenamed("s_suppkey", "l_suppkey")
    plan = plan_of(join_dimension(items, suppliers, ["l_suppkey"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_large_dimension_is_salted(spark, sf_dir, how):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").withColumnRenamed("s_suppkey", "l_suppkey").filter("l_suppkey % 3 > 0")
    expected = rows(items.join(suppliers, ["l_suppkey"], how))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = join_dimension(items, suppliers, ["l_suppkey"], how, limit=10)
        assert "_salt" in plan_of(salted)
        assert rows(salted) == expected
        measured = join_dimension(items, suppliers, ["l_suppkey"], how)
        assert "BroadcastHashJoin" in plan_of(measured)
        assert rows(measured) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(ValueError):
        salted_join(items, suppliers, ["l_suppkey"], "full")


def test_sizes(spark):
    df = spark.range(10).withColumn("t", F.lit("abc"))
    assert measured_bytes(df) == 10 * len('{"id":0,"t":"abc"}')
    assert measured_bytes(df.limit(0)) == 0
    assert planner_limit(df) == 10 * 1024 * 1024
    for text, size in [("-1", -1), ("20MB", 20 << 20), ("1g", 1 << 30), ("512b", 512)]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        try:
            assert planner_limit(df) == size
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
