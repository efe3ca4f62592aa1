"""URL filter: host/path rules first, else a trained classifier, in DataFrame
functions only.

Method: logistic regression on hashed character n-grams of host and path,
trained from a small labelled URL table. Host n-grams and path n-grams are kept
apart by a prefix; both ends are marked, so that beginnings and endings are
features of their own.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
Path: from there up to ``?``, ``#`` or the end. Null, or no ``://``: both empty.
A rule fits its host and all subdomains if the path starts with the rule's path;
the longest rule wins.

Nulls and ties: null and malformed urls are judged by the classifier as empty
host and path; repeated rows are judged alike; an empty table gives no rows. The
labelled table is bounded by ``MOST_LABELLED`` rows (documented parameter of
``train``, taken by hash order); other columns are not read.

URLs of any length are processed whole.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import col

#: (verdict, rule) - fixed values of the task.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
GRAMS = (3, 4, 5)
FEATURES = 1 << 14
MOST_LABELLED = 100_000
BLOCK_AT = 0.5

#: The labelled table, made up without a look at the tables that are judged: words of hosts and paths by label (1: block), set into the forms below.
BLOCK_WORDS = ("casino", "online-casino", "casino-bonus", "sports-bets", "betting-tips", "poker", "jackpot", "lucky-slots",
               "slots-win", "lottery-win", "pharma-pills", "diet-pills", "pill-store", "viagra", "link-farm", "content-farm",
               "seo-spam", "spam-mail", "adult", "adult-chat", "xxx-cams", "hot-cams", "porn", "escorts", "ads-click",
               "banner-ads", "tracker-ads", "click-track", "payday-loans", "fast-loans", "win-prize", "free-crypto",
               "free-prize", "replica-watches", "warez", "torrent-crack", "keygen-crack", "clickbait")
ALLOW_WORDS = ("library", "university", "weather", "recipes", "history", "museum", "garden", "travel-notes",
               "science", "physics", "news", "daily-news", "journal", "health", "music", "theatre", "school",
               "mathematics", "photography", "cycling", "railway", "architecture", "astronomy", "novels", "poetry",
               "software", "open-data", "parliament", "harbour", "mountain", "gathering", "education", "together",
               "within", "zeitung", "gesundheit", "wissenschaft", "bibliothek", "kirchen", "rechte", "bateaux",
               "cuisine", "communication", "voyages", "sciences", "estacion", "ciudad", "noticias", "historia",
               "canciones")
HOSTS = ("{w}.example.com", "www.{w}.example.com", "{w}.example.org", "m.{w}.example.net", "blog.{w}.example.com")
PATHS = ("/en/12", "/de/804", "/fr/77/", "/es/350.html", "")


def with_parts(urls: DataFrame, url_col: str) -> DataFrame:
    """Add _host and _path."""
    text = F.coalesce(col(urls, url_col).cast("string"), F.lit(""))
    rest = F.when(F.contains(text, F.lit("://")), F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    host = F.regexp_extract(F.col("_rest"), r"(?s)^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (urls.withColumn("_rest", rest).withColumn("_host", F.translate(host, upper, lower))
            .withColumn("_path", F.regexp_extract(F.col("_rest"), r"(?s)^[^/?#]*([^?#]*)", 1)).drop("_rest"))


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (rule, verdict), or null."""
    table = F.array(*(F.struct(F.lit(len(r)).alias("n"), F.lit(r).alias("rule"), F.lit(v).alias("verdict"),
                               F.lit(r[:r.index("/")]).alias("host"), F.lit(r[r.index("/"):]).alias("path"))
                      for v, r in rules))
    fits = F.filter(table, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    return F.array_max(fits)


def grams(text: Column, prefix: str, sizes: tuple[int, ...] = GRAMS) -> Column:
    """Character n-grams of the marked text. The characters are bound once (as
    the only element of an array), so the work is linear in the text's length."""

    def of(chars: Column) -> Column:
        lists = []
        for n in sizes:
            gram = lambda i: F.concat(F.lit(prefix), *(F.get(chars, i + k) for k in range(n)))  # noqa: B023, E731
            lists.append(F.transform(F.sequence(F.lit(0), F.greatest(F.size(chars) - n, F.lit(0))), gram))
        return F.array_compact(F.concat(*lists))

    marked = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    return F.flatten(F.transform(F.array(marked), of))


def features(parts: DataFrame) -> DataFrame:
    return parts.withColumn("_grams", F.concat(grams(F.col("_host"), "h"), grams(F.col("_path"), "p")))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table (url, label): every word in every form."""
    rows = [(f"https://{h.format(w=w)}{p}", label) for label, words in ((1, BLOCK_WORDS), (0, ALLOW_WORDS))
            for w in words for h in HOSTS for p in PATHS]
    return spark.createDataFrame(rows, "url string, label int")


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", n_features: int = FEATURES,
          most: int = MOST_LABELLED) -> PipelineModel:
    rows = labelled.select(col(labelled, url_col).alias("url"), col(labelled, label_col).cast("double").alias("label"))
    rows = rows.where("label is not null").orderBy(F.xxhash64("url", "label")).limit(most)
    model = Pipeline(stages=[
        HashingTF(inputCol="_grams", outputCol="_features", numFeatures=n_features, binary=True),
        LogisticRegression(featuresCol="_features", labelCol="label", probabilityCol="_probability",
                           predictionCol="_prediction", rawPredictionCol="_raw", maxIter=40, regParam=0.002)])
    return model.fit(features(with_parts(rows, "url")).coalesce(1))


def judge(urls: DataFrame, model: PipelineModel, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          block_at: float = BLOCK_AT) -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict, block_probability."""
    narrow = urls.select(col(urls, id_col).alias("page_id"), col(urls, url_col).alias("url"))
    scored = model.transform(features(with_parts(narrow, "url")))
    rule = best_rule(F.col("_host"), F.col("_path"), rules)
    p = vector_to_array("_probability")[1]
    return scored.select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], F.when(p >= block_at, "block").otherwise("allow")).alias("verdict"),
        p.alias("block_probability"))
