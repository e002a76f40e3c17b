"""The mix of feature classes and codes in a country, and advice drawn from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placelens.functions.scaling import ratio
from placelens.operators.selection import CLASS_AND_CODE_KEY
from placelens.plans.joins import join_dimension

# Own codes. kind 'max': the class is the country's largest; 'min': its smallest.
ADVICE_ROWS = [
    ("max", "A", "balance_states"),
    ("max", "H", "use_hydropower"),
    ("max", "L", "keep_parks"),
    ("max", "P", "invest_infrastructure"),
    ("max", "R", "use_transport"),
    ("max", "S", "invest_farming"),
    ("max", "T", "invest_tourism"),
    ("max", "U", "use_marine"),
    ("min", "A", "spread_population"),
    ("min", "H", "store_water"),
    ("min", "L", "build_recreation"),
    ("min", "P", "build_infrastructure"),
    ("min", "R", "build_transport"),
    ("min", "S", "invest_farming"),
    ("min", "T", "build_tourism"),
    ("min", "U", "use_marine"),
]


def advice_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ADVICE_ROWS, "kind STRING, feature_class STRING, advice STRING"
    )


def class_distribution(places: DataFrame, names: DataFrame, mapping: DataFrame) -> DataFrame:
    """Places per country and class, with the class description and country name.

    Countries or classes that a dimension does not know are left out.
    """
    counts = places.groupBy("country_code", "feature_class").agg(F.count("*").alias("no_of_features"))
    described = join_dimension(
        counts,
        names.select("feature_class", F.col("feature_class_description").alias("feature_description")),
        ["feature_class"],
    )
    return join_dimension(described, mapping.select("country_code", "country"), ["country_code"])


def class_share(distribution: DataFrame) -> DataFrame:
    """Share of each class in its country's places."""
    total = F.sum("no_of_features").over(Window.partitionBy("country"))
    return distribution.select(
        "country",
        "feature_description",
        "no_of_features",
        ratio(F.col("no_of_features"), total).alias("share"),
    )


def class_descriptions(distribution: DataFrame) -> DataFrame:
    return distribution.select("feature_description").distinct()


def class_lookup(descriptions: DataFrame, names: DataFrame) -> DataFrame:
    """Class letter of each description, by exact text; unknown descriptions give no row."""
    return descriptions.join(
        names.withColumnRenamed("feature_class_description", "feature_description"),
        "feature_description",
    )


def extreme_classes(distribution: DataFrame) -> DataFrame:
    """Largest and smallest class of each country; ties go to the lowest letter."""
    country = Window.partitionBy("country_code")
    n = F.col("no_of_features")
    ranked = distribution.select(
        "country_code",
        "country",
        "feature_class",
        "no_of_features",
        F.row_number().over(country.orderBy(n.desc(), "feature_class")).alias("from_top"),
        F.row_number().over(country.orderBy(n.asc(), "feature_class")).alias("from_bottom"),
    ).filter("from_top = 1 OR from_bottom = 1")
    kinds = F.array_compact(
        F.array(F.when(F.col("from_top") == 1, F.lit("max")), F.when(F.col("from_bottom") == 1, F.lit("min")))
    )
    return ranked.select(
        "country_code", "country", F.explode(kinds).alias("kind"), "feature_class", "no_of_features"
    )


def class_advice(extremes: DataFrame, rules: DataFrame) -> DataFrame:
    """Advice for the largest and smallest class; NULL for a class without a rule."""
    return join_dimension(extremes, rules, ["kind", "feature_class"], "left")


def class_code_counts(
    enriched: DataFrame, country: str | None = None, feature_class: str | None = None
) -> DataFrame:
    """Places with a code, per country, class and code; for one country and class if given."""
    if country is not None:
        enriched = enriched.filter(F.col("country") == country)
    if feature_class is not None:
        enriched = enriched.filter(F.col("feature_class") == feature_class)
    return enriched.groupBy("country", "feature_class", "feature_code").agg(
        F.count("feature_code").alias("no_of_feature_code")
    )


def code_share(counts: DataFrame, codes: DataFrame) -> DataFrame:
    """Share of each code in its class, among the codes the dictionary describes."""
    described = join_dimension(counts, codes, CLASS_AND_CODE_KEY)
    total = F.sum("no_of_feature_code").over(Window.partitionBy("country", "feature_class"))
    return described.select(
        "country",
        "feature_class",
        "feature_code",
        "short_description",
        ratio(F.col("no_of_feature_code"), total).alias("percentage_of_feature"),
    )
