"""URL filter: ordered rules first, logistic regression on hashed character n-grams for the rest.

The classifier learns from a small table of labelled URLs: n-grams of host and
path, tagged by part, hashed into a fixed number of features.  Everything is
DataFrame functions and Spark's own feature hashing and regression.

Defined cases: a null URL, or one without ``://``, has an empty host and path and
still gets a verdict; a table with labels of one kind only, or none, gives every
URL that kind (allow, if none); repeated rows get a row each; an empty table gives
an empty result; result columns replace input columns of their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradestar.llm.common import ascii_lower, let, without
from tradestar.session import materialize, scratch_path

FEATURES = 1 << 14
GRAMS = (3, 4, 5)
#: Labelled URLs the classifier is fitted on at most (those of smallest hash).
MAX_TRAIN = 5000
ALLOW, BLOCK = "allow", "block"

#: Fixed values of the contract: (verdict, host and path).
RULES = (
    (ALLOW, "org/"),
    (BLOCK, "example.org/es/"),
    (BLOCK, "example.org/en/1"),
    (ALLOW, "com/fr/"),
    (BLOCK, "com/de/"),
)

#: Small table of URLs labelled by hand: gambling, pills, link farms, trackers, fraud and the like, against
#: ordinary sites.  Page paths (language and number) stand in both, so that they tell nothing.
LABELLED = {
    BLOCK: """
    http://www.casino-win.example.net/en/412 https://best-online-casino.net/bonus/1 http://casino-royal-slots.com/play http://m.vegas-casino.net/fr/31/
    https://casinobonus.info/en/9.html http://m.free-bets.example.com/es/77 https://freebets24.net/de/6 http://sports-betting-odds.com/bets/today
    http://bet-and-win.net/en/205/ https://betting-tips.info/fr/8.html http://www.live-bets.com/ http://cheap-pills.example.net/en/314 http://cheap-viagra-pills.com/buy
    https://pills-online.net/de/12.html http://pharmacy-discount.com/cheap/pills http://www.buy-cheap-meds.net/en/640 https://diet-pills.info/fr/4/
    http://spam-farm.example.net/en/9 https://www.link-farm.net/de/510 http://spam-links.com/es/33.html http://seo-spam.info/en/8 http://content-farm.net/fr/702/
    https://ads-track.example.com/en/118 http://ads.click-tracker.net/click/7 https://track-ads.com/de/91 http://m.ad-tracker.net/en/4.html http://adserver-track.info/es/5
    https://www.popup-ads.net/fr/620 http://payday-loans-fast.com/apply https://quick-cash-loans.net/en/81 http://www.replica-watches.net/de/3
    http://cheap-replica-bags.com/es/45.html https://poker-slots.net/en/27/ http://jackpot-win.com/fr/19 http://win-free-prize.com/claim https://free-iphone-win.net/en/3
    http://xxx-cams.net/de/8 http://adult-dating.info/en/55.html http://crack-keygen-download.net/en/14 https://free-warez.info/fr/2 http://get-rich-quick.net/en/99
    http://miracle-weight-loss.com/buy https://m.work-from-home-cash.net/es/320
     http://adult-x.example.com/en/31 https://www.adult-videos.net/de/205 http://spam-site.net/fr/6 http://m.spammy-deals.info/en/12 https://spam-network.com/es/65
     http://ads-server.net/en/7 https://www.ads-clicks.com/de/320 http://ads-banner.info/en/19.html
    """.split(),
    ALLOW: """
    https://www.national-library.net/en/412 http://library.city.net/de/77.html https://university.net/en/314 http://www.physics-institute.net/fr/31/
    https://museum.net/es/118 http://history.museum.com/en/9 https://news.daily-post.com/en/205/ http://www.herald.net/de/6 https://weather.net/en/640
    http://m.weather.com/es/77 https://www.the-times.net/fr/8.html http://blog.travel-notes.net/en/91 http://blog.gardening.com/en/4.html https://recipes.net/fr/702/
    http://blog.cooking.net/de/510 https://knitting.com/es/33.html http://photography.net/en/27/ https://blog.hiking.net/fr/19 http://docs.python.net/en/3
    https://www.kernel.com/en/81 http://wiki.linux.net/de/12.html https://openmaps.net/fr/65 http://forum.astronomy.net/en/55.html https://math.net/en/14
    http://chemistry.com/es/45.html https://www.hospital.net/en/99 http://health.gov.net/fr/4/ https://ministry.net/de/3 http://parliament.net/en/8 https://court.net/es/5
    http://www.school.net/en/320 https://kindergarten.net/de/8 http://thesaurus.net/en/118 https://m.theatre.net/en/77 http://theology.net/de/314
    https://www.thinker.net/es/412 http://mother.net/en/9 https://other.net/fr/3 http://blog.weather-station.net/de/45 https://education.net/en/6
    http://m.information.net/de/91 https://nation.net/fr/510 http://station.com/en/702 https://blog.translation.net/es/19 http://thing.net/en/27
    https://www.everything.net/de/33 http://rivers.net/en/640 https://forest.net/fr/205 http://m.harvest.net/es/14 https://stable.net/en/55 http://www.table.net/de/4
    https://thread.net/en/8 http://there.net/fr/12 https://shire.net/es/99 http://whether.com/en/81 https://north.net/de/65 http://m.south.net/en/31
    https://www.earth.com/en/5 http://hands.net/fr/320 https://blog.friends.net/en/2 http://evening.net/de/620 https://listen.com/es/7 http://www.bakery.com/
    https://florist.net/contact http://blog.orchestra.net/concerts/today https://bookshop.com/buy http://railway.net/tickets http://www.theatre.com/play
    https://software.net/download http://newsletter.net/claim
     http://www.city-museum.example.net/en/412 https://blog.gardens.example.com/en/77 http://m.thereby.example.net/de/314 https://therapy.example.com/en/118 http://ocean-science.example.net/fr/9
     http://blog.chess-club.example.com/es/33 https://www.weekly-news.example.net/en/640 http://thistle.example.com/en/8 https://motion.example.net/es/620 http://m.traffic-report.example.com/en/5
     https://farm-museum.example.net/en/91 http://www.family-farm.net/de/7 https://track-and-field.net/en/14 http://railway-track.com/fr/45 https://free-library.net/en/2 http://adult-education.net/es/4
     http://blog.theories.example.net/fr/702 https://www.orchids.example.com/en/27 http://stations.example.net/de/55.html https://m.botany.example.com/en/65/
    """.split(),
}

RESULT = ("host", "path", "rule", "verdict", "score")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    parts = r"://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(whole, parts, 1)), F.regexp_extract(whole, parts, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (nulls if none does).  ``rules`` is a short stated list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: len(r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _grams(part: Column, tag: str) -> Column:
    def of(text: Column) -> Column:
        size = F.length(text)
        return F.concat(*[F.when(size >= k, F.transform(F.sequence(F.lit(1), F.greatest(size - k + 1, F.lit(1))), lambda i: F.concat(F.lit(tag), F.substring(text, i, F.lit(k))))).otherwise(F.array().cast("array<string>")) for k in GRAMS])

    return let(F.concat(F.lit("^"), part, F.lit("$")), of)


def features(df: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    from pyspark.ml.feature import HashingTF

    grams = df.withColumn("_grams", F.concat(_grams(F.col(host), "h "), _grams(F.col(path), "p ")))
    return HashingTF(numFeatures=FEATURES, inputCol="_grams", outputCol="_features", binary=True).transform(grams).drop("_grams")


def train(labelled: DataFrame, max_train: int = MAX_TRAIN):
    """A fitted model from ``(host, path, verdict)``, or the one verdict there is."""
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel

    distinct = labelled.select("host", "path", F.when(F.col("verdict") == BLOCK, 1.0).otherwise(0.0).alias("label")).distinct()
    sample = materialize(distinct.orderBy(F.xxhash64("host", "path", "label"), "host", "path", "label").limit(max_train), "url_labels")
    kinds = sorted(r[0] for r in sample.select("label").distinct().collect())
    if len(kinds) < 2:
        return BLOCK if kinds == [1.0] else ALLOW
    fitted = LogisticRegression(featuresCol="_features", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_label", regParam=0.002, maxIter=60).fit(features(sample))
    # a model read back has no training summary, which holds the session and keeps tasks from being sent
    path = scratch_path(labelled.sparkSession, "url_model")
    fitted.write().save(path)
    return LogisticRegressionModel.load(path)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``LABELLED`` as ``(url, verdict)``."""
    verdicts = F.from_json(F.lit(json.dumps(LABELLED)), "map<string,array<string>>")
    each = spark.range(1).select(F.explode(verdicts).alias("verdict", "urls"))
    return each.select(F.explode("urls").alias("url"), "verdict")


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, url_col: str = "url", max_train: int = MAX_TRAIN) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (P(block) by the classifier).

    ``labelled``: ``(url, verdict)``; by default the URLs that a rule judges.
    """
    from pyspark.ml.functions import vector_to_array

    rest = without(pages, *RESULT)
    host, path = split_url(F.col("_url"))
    judged = rest.select(*rest.columns, pages[url_col].alias("_url")).withColumns({"host": host, "path": path}).drop("_url")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "_ruled": verdict})
    if labelled is None:
        known = judged.filter("_ruled is not null").select("host", "path", F.col("_ruled").alias("verdict"))
    else:
        host, path = split_url(F.col("url"))
        known = labelled.filter("verdict is not null").select(host.alias("host"), path.alias("path"), "verdict")
    model = train(known, max_train)
    if isinstance(model, str):
        scored = judged.withColumn("score", F.lit(1.0 if model == BLOCK else 0.0))
    else:
        scored = model.transform(features(judged)).withColumn("score", vector_to_array("_probability")[1])
    verdict = F.coalesce("_ruled", F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    return scored.withColumn("verdict", verdict).select(*rest.columns, *RESULT)
