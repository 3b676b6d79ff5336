"""URL filters: rules on host and path, and logistic regression for the rest.

Everything runs as DataFrame expressions: character n-grams of host and path are
cut by SQL functions, hashed to a sparse vector and weighed by a model that is
trained from a small labelled table of URLs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Rule = tuple[str, str]

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)

# A small labelled table: 1 for hosts of the kind that a crawl leaves out. Both classes have the
# same schemes, subdomains and paths, so that these do not decide.
LABELLED_URLS = [
    ("http://cheap-meds-online.test/en/12", 1),
    ("https://www.best-pills.test/de/451.html", 1),
    ("http://buy-pills-now.test/fr/77/", 1),
    ("https://m.pharmacy-discount.test/es/304", 1),
    ("http://blog.cheap-watches.test/en/9021.html", 1),
    ("https://replica-bags.test/order/now", 1),
    ("http://www.free-casino-bonus.test/index", 1),
    ("https://casino-royal-slots.test/en/88?page=2", 1),
    ("http://m.online-bets.test/de/6/", 1),
    ("https://blog.sports-bets.test/articles/184/", 1),
    ("http://free-spins-poker.test/fr/5123#top", 1),
    ("https://www.lottery-winner.test/news/2021/05", 1),
    ("http://spam-links.test/en/764/", 1),
    ("https://m.link-farm.test/en/12", 1),
    ("http://blog.seo-spam.test/de/451.html", 1),
    ("https://farm-backlinks.test/fr/77/", 1),
    ("http://www.adult-singles.test/es/304", 1),
    ("https://xxx-videos.test/en/9021.html", 1),
    ("http://m.warez-crack.test/order/now", 1),
    ("https://blog.free-keygen.test/index", 1),
    ("http://payday-loans.test/en/88?page=2", 1),
    ("https://www.fast-cash.test/de/6/", 1),
    ("http://crypto-doubler.test/articles/184/", 1),
    ("https://m.win-prizes.test/fr/5123#top", 1),
    ("http://blog.verify-login.test/news/2021/05", 1),
    ("https://miracle-pills.test/en/764/", 1),
    ("http://city-library.test/en/12", 0),
    ("https://www.morning-paper.test/de/451.html", 0),
    ("http://garden-notes.test/fr/77/", 0),
    ("https://m.open-docs.test/es/304", 0),
    ("http://blog.state-university.test/en/9021.html", 0),
    ("https://history-museum.test/order/now", 0),
    ("http://www.weather-service.test/index", 0),
    ("https://family-recipes.test/en/88?page=2", 0),
    ("http://m.linux-forum.test/de/6/", 0),
    ("https://blog.river-encyclopedia.test/articles/184/", 0),
    ("http://town-council.test/fr/5123#top", 0),
    ("https://www.travel-diary.test/news/2021/05", 0),
    ("http://science-journal.test/en/764/", 0),
    ("https://m.primary-school.test/en/12", 0),
    ("http://blog.health-advice.test/de/451.html", 0),
    ("https://music-theory.test/fr/77/", 0),
    ("http://www.mathematics-blog.test/es/304", 0),
    ("https://old-bookshop.test/en/9021.html", 0),
    ("http://m.railway-times.test/order/now", 0),
    ("https://blog.law-review.test/index", 0),
    ("http://bird-watching.test/en/88?page=2", 0),
    ("https://www.maps-archive.test/de/6/", 0),
    ("http://chess-club.test/articles/184/", 0),
    ("https://m.theatre-reviews.test/fr/5123#top", 0),
    ("http://blog.language-course.test/news/2021/05", 0),
    ("https://city-parks.test/en/764/", 0),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest of ``rules`` that fits, as ``struct(rule, action)``, or null.

    ``rules`` are ``(action, text)`` with the host before the first slash of the
    text and the path from there; every row is held against each of them.
    """
    if not rules:
        return F.lit(None).cast("struct<rule:string,action:string>")
    ordered = sorted(rules, key=lambda rule: (-len(rule[1]), rule[1]))
    table = F.array(
        *(
            F.struct(
                F.lit(text).alias("rule"),
                F.lit(action).alias("action"),
                F.lit(text.partition("/")[0]).alias("host"),
                F.lit("/" + text.partition("/")[2]).alias("path"),
            )
            for action, text in ordered
        )
    )
    fits = F.filter(
        table,
        lambda rule: ((host == rule["host"]) | host.endswith(F.concat(F.lit("."), rule["host"])))
        & path.startswith(rule["path"]),
    )
    first = F.get(fits, F.lit(0))
    return F.when(F.size(fits) > 0, F.struct(first["rule"].alias("rule"), first["action"].alias("action")))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path with borders, marked by where they come from."""
    parts = []
    for mark, text in (("h", host), ("p", path)):
        text = F.concat(F.lit("^"), text, F.lit("$"))
        for n in GRAMS:
            last = F.length(text) - (n - 1)
            starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(
                F.array().cast("array<int>")
            )
            parts.append(F.transform(starts, cut(mark, text, n)))
    return F.concat(*parts)


def cut(mark: str, text: Column, n: int) -> Callable[[Column], Column]:
    return lambda start: F.concat(F.lit(mark), F.substring(text, start, F.lit(n)))


def train_urls(labelled: DataFrame, regularisation: float = 0.002) -> PipelineModel:
    """A model from a small table ``url, blocked``; rows without either teach nothing."""
    host, path = host_and_path(F.col("url"))
    rows = (
        labelled.where("url IS NOT NULL AND blocked IS NOT NULL")
        .select(grams(host, path).alias("grams"), F.col("blocked").cast("double").alias("label"))
        .coalesce(1)
    )
    steps = [
        HashingTF(inputCol="grams", outputCol="counts", numFeatures=BUCKETS),
        Normalizer(inputCol="counts", outputCol="features"),
        LogisticRegression(maxIter=50, regParam=regularisation),
    ]
    return Pipeline(stages=steps).fit(rows)


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED_URLS, "url string, blocked int")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    labelled: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    block_from: float = 0.7,
) -> DataFrame:
    """Host, path, rule, verdict and the model's probability of ``block`` for every row.

    A row without host and path (null, or no ``://``) that no rule fits is
    allowed. Repeated rows and null ids stay as they are.
    """
    model = train_urls(labelled)
    host, path = host_and_path(F.col("url"))
    rows = (
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
        .select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("grams", grams(F.col("host"), F.col("path")))
    )
    found = rule_for(F.col("host"), F.col("path"), rules)
    scored = model.transform(rows).select(
        "page_id",
        "host",
        "path",
        found.alias("found"),
        vector_to_array("probability")[1].alias("block_probability"),
    )
    method = F.when(
        ((F.col("host") != "") | (F.col("path") != "")) & (F.col("block_probability") >= block_from),
        F.lit("block"),
    ).otherwise(F.lit("allow"))
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.action"), method).alias("verdict"),
        "block_probability",
    )
