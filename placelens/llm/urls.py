"""URL verdicts: host rules first, else gradient-boosted trees over lexical features.

A rule is a host and the start of a path with a verdict; it fits its host and all subdomains, and the
longest fitting rule wins. Where none fits, boosted trees decide. They learn from labelled urls; their features are lengths of
url, host and path, depth of path and host, share of digits, entropy of the characters, parameters, signs,
and statistics of the host's suffixes (last part, last two, last part with the path's first folder): how many labelled urls have it, and
which smoothed share of them is to be blocked.

All features are SQL expressions and the trees are Spark ML's; no Python runs on executors. The statistics are
counted over all labelled urls, by part with partial sums, and joined by part; a kind of at most ``MOST_PARTS`` parts
is broadcast. The trees alone are fitted on at most ``sample`` labelled urls, those with the smallest hash.

A url that is learned from must not see its own label in its statistics: they are those of the other ``FOLDS - 1`` folds of urls.
And as most urls to judge come from folders without a label, half of those learned from, by hash, are shown as
if theirs had none, so that the trees also learn what host endings and characters say by themselves.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged by the trees as
an empty text; without labels, or with labels of one kind, every url is allowed or gets that kind; a probability of 0.5
blocks; repeated rows get the same verdict; a very long url is judged whole; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.llm.shared import column, materialize

SAMPLE = 20_000
MOST_PARTS = 20_000
TREES, DEPTH = 12, 4
PRIOR = 20.0
FOLDS = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = (
    "n_url n_host n_path depth labels digits digit_share entropy params signs has_www secure suffix_n suffix_share "
    "domain_n domain_share folder_n folder_share"
).split()


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest of the rules (host, path, verdict) that fits, as host and path joined, and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    n = F.length(url)
    digits = n - F.length(F.translate(url, "0123456789", ""))
    letters = F.array_distinct(F.split(url, ""))
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(
        F.filter(letters, lambda c: c != ""), F.lit(0.0), lambda sum_, c: sum_ - share(c) * F.log2(share(c))
    )
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    parts = {
        "n_url": n,
        "n_host": F.length(host),
        "n_path": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "labels": F.size(F.split(host, r"\.")),
        "digits": digits,
        "digit_share": F.when(n > 0, digits / n).otherwise(0.0),
        "entropy": entropy,
        "params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "signs": n - F.length(F.translate(url, "-_%~+=&@!", "")),
        "has_www": host.startswith("www.").cast("int"),
        "secure": url.startswith("https").cast("int"),
    }
    return {k: v.cast("double") for k, v in parts.items()}


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    """What statistics are kept of: last part of the host, last two, and last part with the path's first folder."""
    last = F.substring_index(host, ".", -1)
    folder = F.concat(last, F.lit("/"), F.substring_index(F.substring(path, 2, 1 << 30), "/", 1))
    return {"suffix": last, "domain": F.substring_index(host, ".", -2), "folder": folder}


def fold_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(FOLDS)).cast("int")


class UrlModel:
    """Fitted trees with the suffix statistics that they read."""

    def __init__(self, statistics: DataFrame, sizes: dict[str, int], overall: float, trees: GBTClassificationModel | None):
        self.statistics, self.sizes, self.overall, self.trees = statistics, sizes, overall, trees

    def featured(self, urls: DataFrame, learned: bool = False) -> DataFrame:
        """``urls`` (url, host, path and more) with all features; learned: without what the urls' own labels say."""
        out = urls.select("*", *[v.alias(k) for k, v in lexical(F.col("url"), F.col("host"), F.col("path")).items()])
        for name, part in suffixes(F.col("host"), F.col("path")).items():
            of_kind = self.statistics.where(F.col("kind") == name)
            totals = of_kind.groupBy(F.col("part").alias("_part")).agg(F.sum("n").alias("_n"), F.sum("bad").alias("_bad"))
            small = self.sizes.get(name, 0) <= MOST_PARTS
            out = out.join(F.broadcast(totals) if small else totals, part == F.col("_part"), "left").drop("_part")
            n, bad = (F.coalesce(c, F.lit(0)) for c in ("_n", "_bad"))
            if learned:
                own = of_kind.select(F.col("part").alias("_part"), F.col("fold").alias("_fold"), F.col("n").alias("_own_n"), F.col("bad").alias("_own_bad"))
                same = (part == F.col("_part")) & (fold_of(F.col("url")) == F.col("_fold"))
                out = out.join(F.broadcast(own) if small else own, same, "left").drop("_part", "_fold")
                n, bad = n - F.coalesce("_own_n", F.lit(0)), bad - F.coalesce("_own_bad", F.lit(0))
                if name == "folder":
                    shown = (F.pmod(F.xxhash64("url", F.lit(1)), F.lit(2)) == 0).cast("int")
                    n, bad = n * shown, bad * shown
            share = (bad + PRIOR * self.overall) / (n + PRIOR)
            out = out.withColumns({f"{name}_n": n.cast("double"), f"{name}_share": share}).drop("_n", "_bad", "_own_n", "_own_bad")
        return out

    def block_share(self, urls: DataFrame) -> DataFrame:
        """``urls`` with ``p_block``, the trees' probability that a url is to be blocked."""
        if self.trees is None:
            return urls.withColumn("p_block", F.lit(self.overall))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(self.featured(urls))
        return self.trees.transform(rows).select(
            *[F.col(c) for c in urls.columns], vector_to_array("probability")[1].alias("p_block")
        )


def fit(labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> UrlModel:
    """From url, host, path and ``blocked`` (0 or 1)."""
    labelled = labelled.where("blocked is not null").select("url", "host", "path", "blocked")
    parts = [F.struct(F.lit(k).alias("kind"), v.alias("part")) for k, v in suffixes(F.col("host"), F.col("path")).items()]
    statistics = materialize(
        labelled.select(F.explode(F.array(*parts)).alias("p"), fold_of(F.col("url")).alias("fold"), "blocked")
        .groupBy("p.kind", "p.part", "fold").agg(F.count("*").alias("n"), F.sum("blocked").alias("bad")),
        "suffixes",
    )
    sums = statistics.groupBy("kind").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("bad").alias("bad")).collect()
    overall = sums[0].bad / sums[0].n if sums else 0.0
    model = UrlModel(statistics, {r.kind: r.parts for r in sums}, overall, None)
    picked = materialize(labelled.orderBy(F.xxhash64("url"), "url", "blocked").limit(sample), "labelled")
    n, bad = picked.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    if 0 < bad < n:
        rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(model.featured(picked, learned=True))
        rows = materialize(rows.select("_features", F.col("blocked").cast("double").alias("label")), "features").coalesce(2)
        model.trees = GBTClassifier(
            featuresCol="_features", labelCol="label", maxIter=trees, maxDepth=depth, maxBins=32, seed=3
        ).fit(rows)
    return model


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]], model: UrlModel | None = None, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """id, host, path, rule, verdict and p_block of every row; urls with a rule are the labels if no model is given."""
    url = column(url_col)
    split = pages.select(column(id_col).alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": rule, "says": says})
    if model is None:
        model = fit(ruled.withColumn("blocked", F.when(F.col("says").isNotNull(), (F.col("says") == "block").cast("int"))))
    return model.block_share(ruled).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("says", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "p_block",
    )
