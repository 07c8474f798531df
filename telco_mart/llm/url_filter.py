"""URL filter: logistic regression on hashed character n-grams of host and path.

The model is trained by Spark's own logistic regression on a small labelled URL
table and applied with DataFrame expressions only. Explicit rules (host/path)
come before the model: a rule fits its host and all subdomains if the path
starts with the rule's path; the longest fitting rule decides.

Inputs: a null url or one without ``://`` has an empty host and path, fits no
rule and is judged by the model on no n-grams (its intercept). Repeated rows get
equal verdicts; an empty table gives an empty result. Only the id and url
columns are read, so other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

# Labelled URLs, of dictionary words and reserved example domains: 1 is to be blocked.
BLOCKED = [
    "http://casino-royal.example.com/en/12", "https://www.casino-win.example.org/de/311.html", "https://best-casino.example.net/fr/7?page=2", "http://online-casino.example.com/es/90/",
    "http://free-bets.example.org/en/5", "https://m.free-bets.example.net/fr/871#top", "https://blog.sports-bets.example.com/en/33", "http://bets-now.example.com/de/410.html",
    "http://cheap-pills.example.net/en/64", "https://www.cheap-pills.example.org/es/777?utm_source=feed", "https://diet-pills.example.com/fr/19", "http://m.pills-shop.example.com/en/245/",
    "http://ads-track.example.net/en/8", "https://www.ads-track.example.org/de/93#top", "https://track-ads.example.com/en/500.html", "http://blog.click-ads.example.com/fr/640",
    "http://spam-farm.example.net/en/1", "https://www.spam-farm.example.com/es/27", "https://link-farm.example.com/en/985?page=2&ref=x", "http://m.seo-spam.example.org/de/72",
    "http://adult-x.example.com/en/55", "https://www.adult-x.example.org/fr/304", "https://adult-cams.example.net/en/610/", "http://blog.hot-adult.example.com/en/48.html",
    "https://win-money.example.com/en/81", "http://free-loans.example.org/en/219", "https://lottery-win.example.net/de/12", "http://payday-loans.example.com/es/430",
]
ALLOWED = [
    "http://library.example.com/en/12", "https://www.museum.example.org/de/311.html", "https://university.example.net/fr/7?page=2", "http://blog.gardener.example.com/es/90/",
    "http://sailing.example.org/en/5", "https://m.history.example.net/fr/871#top", "https://blog.weather.example.com/en/33", "http://pottery.example.com/de/410.html",
    "http://newspaper.example.net/en/64", "https://www.recipes.example.org/es/777?utm_source=feed", "https://astronomy.example.com/fr/19", "http://m.science.example.com/en/245/",
    "http://theatre.example.net/en/8", "https://www.botany.example.org/de/93#top", "https://encyclopedia.example.com/en/500.html", "http://blog.mountain.example.com/fr/640",
    "http://chess.example.net/en/1", "https://www.hospital.example.com/es/27", "https://orchestra.example.com/en/985?page=2&ref=x", "http://m.railway.example.org/de/72",
    "http://geology.example.com/en/55", "https://www.philosophy.example.org/fr/304", "https://council.example.net/en/610/", "http://blog.teacher.example.com/en/48.html",
    "https://poetry.example.com/en/81", "http://research.example.org/en/219", "https://kitchen.example.net/de/12", "http://literature.example.com/es/430",
]

#: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
BUCKETS = 1 << 14


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    part = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return ascii_lower(part(r"(?s)^.*?://([^/?#]*)")), part(r"(?s)^.*?://[^/?#]*([^?#]*)")


def _grams(text: Column, tag: str, sizes: tuple[int, ...]) -> Column:
    """All n-grams of ^text$ in one pass per size: a lookahead matches at every
    position, so time grows with the length and not its square."""
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    grams = F.concat(*(F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in sizes))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.transform(grams, lambda g: F.concat(F.lit(tag), g)))


def ngrams(host: Column, path: Column, sizes: tuple[int, ...] = (3, 4)) -> Column:
    """Character n-grams of host and path, tagged by where they come from.
    Digits are one class: numbers in paths name pages, not kinds of sites."""
    return F.concat(_grams(host, "h:", sizes), _grams(F.regexp_replace(path, "[0-9]+", "0"), "p:", sizes))


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(u, 1.0) for u in BLOCKED] + [(u, 0.0) for u in ALLOWED], "url string, label double")


def train(labelled: DataFrame, sizes: tuple[int, ...] = (3, 4), buckets: int = BUCKETS, reg: float = 0.02) -> PipelineModel:
    """Hashing and logistic regression fitted on (url, label)."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.select(ngrams(host, path, sizes).alias("__grams"), "label")
    hashing = HashingTF(inputCol="__grams", outputCol="__tf", numFeatures=buckets, binary=True)
    model = LogisticRegression(featuresCol="__tf", labelCol="label", regParam=reg, maxIter=50, probabilityCol="__p", predictionCol="__y", rawPredictionCol="__raw")
    return PipelineModel([hashing, model.fit(hashing.transform(rows))])


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (length, rule, verdict) of the longest fitting rule, or null."""

    def one(rule_host: str, rule_path: str, verdict: str) -> Column:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = rule_host + rule_path
        return F.when(fits, F.struct(F.lit(len(name)).alias("length"), F.lit(name).alias("rule"), F.lit(verdict).alias("verdict")))

    fitting = [one(*r) for r in rules]
    return fitting[0] if len(fitting) == 1 else reduce(F.greatest, fitting) if fitting else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def judge(df: DataFrame, model: PipelineModel, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
          sizes: tuple[int, ...] = (3, 4), threshold: float = 0.5) -> DataFrame:
    """(id, host, path, rule, verdict, p_block) for every row."""
    host, path = host_and_path(F.col(url_col))
    parts = df.select(F.col(id_col), host.alias("host"), path.alias("path"))
    scored = model.transform(parts.withColumn("__grams", ngrams(F.col("host"), F.col("path"), sizes)))
    rule = rule_for(F.col("host"), F.col("path"), rules)
    p = vector_to_array("__p")[1]
    return scored.select(id_col, "host", "path", rule.alias("__rule"), p.alias("p_block")).select(
        id_col, "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), F.when(F.col("p_block") >= threshold, "block").otherwise("allow")).alias("verdict"), "p_block",
    )
