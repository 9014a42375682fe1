"""URL filter: fixed rules first, else logistic regression on hashed character n-grams (operator 4).

Host, path and rules are column expressions; the model is fitted once on the
small labelled table below and applied by the same DataFrame pipeline.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed rules (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
GRAMS, FEATURES, PENALTY, BLOCK_AT = (3, 4, 5), 1 << 14, 0.001, 0.5
#: The small labelled table: urls to block and urls to allow.  It names no host of the supplied pages.
BLOCKED = (
    "https://www.casino-royal.example.net/bonus", "http://best-casino.example.org/en/41", "https://m.lucky-casino.example.org/slots",
    "http://casinos-online.example.net/de/7", "http://sports-bets.example.org/live", "https://bets-today.example.net/en/310",
    "http://betting-tips.example.org/fr/9", "https://blog.spam-mail.example.net/en/15", "http://link-farm.example.org/page",
    "https://spam-links.example.org/es/6", "http://seo-farm.example.net/en/88/", "http://content-farm.example.org/de/53",
    "http://ads-server.example.org/en/120.html", "https://m.ad-click.example.net/pixel", "http://track-ads.example.net/en/2",
    "https://tracking.example.org/pixel", "http://click-track.example.org/fr/31", "https://popup-ads.example.net/show",
    "http://discount-pills.example.org/order", "https://pills-shop.example.net/viagra", "http://xxx-cams.example.org/en/4",
    "https://adult-cams.example.net/xxx", "http://adult-chat.example.org/en/76", "https://m.adult-video.example.net/de/11", "http://sex-adult.example.org/x",
    "http://payday-loans.example.org/apply", "https://quick-loans.example.net/en/8", "http://instant-loan.example.org/cash",
    "http://poker-table.example.org/en/19", "https://slots-win.example.net/jackpot", "http://jackpot-win.example.org/es/2",
    "http://clickbait.example.org/you-wont-believe", "http://free-money.example.org/win", "https://free-iphone.example.net/claim",
    "http://free-gifts.example.org/en/64?page=2", "https://malware-load.example.net/setup.exe", "http://warez.example.org/crack",
    "https://crack-keys.example.net/de/3", "http://torrent-warez.example.org/en/5",
    "https://pills-online.example.net/en/14", "http://diet-pills.example.org/fr/3", "http://m.adult-dating.example.org/en/27", "https://adults-only.example.net/es/8",
    "http://xxx-films.example.org/de/19", "https://hot-xxx.example.net/en/6", "http://spam-blast.example.org/en/230", "https://mail-spam.example.net/de/44",
    "http://spammers.example.org/fr/1", "https://big-bets.example.net/en/9", "http://casino-spins.example.org/en/55", "https://loans-online.example.net/es/12",
    "http://replica-shop.example.org/en/2", "https://win-prizes.example.net/fr/5", "http://hacked-apps.example.org/de/80", "https://ad-farm.example.net/en/17",
    "http://cheap-meds.example.org/en/3", "https://cheap-tabs.example.net/de/21", "http://tracker-ads.example.org/en/1", "https://viagra-meds.example.net/en/7?page=3",
)
ALLOWED = (
    "http://news.example.org/world", "https://www.library.example.net/catalog", "http://blog.garden.example.org/roses",
    "https://m.weather.example.net/today", "http://university.example.org/courses", "https://docs.project.example.net/guide",
    "http://museum.example.org/en/12", "https://recipes.example.net/soup.html", "http://history.example.org/de/77?page=2",
    "https://www.theatre.example.net/de/49", "http://blog.thinker.example.org/en/5", "https://m.thread.example.net/en/8",
    "http://wiki.example.org/article", "https://science.example.net/paper", "http://city.example.org/council",
    "https://www.hospital.example.net/visit", "http://school.example.org/term", "https://travel.example.net/trains",
    "http://www.stones.example.org/en/471", "https://blog.nations.example.net/en/219/", "http://them.example.org/es/3",
    "https://www.lesson.example.net/en/90", "http://hear.example.org/fr/61.html", "https://m.other.example.net/en/334/",
    "https://m.farmer.example.org/en/14", "http://www.harvest.example.net/de/8", "https://blog.teacher.example.org/en/1021",
    "http://street-maps.example.net/en/7", "https://open-data.example.org/sets/4", "http://bird-watch.example.net/en/73",
    "https://www.old-books.example.org/es/220", "http://m.train-times.example.net/de/5", "https://sea-charts.example.org/en/66.html",
    "http://blog.north-wind.example.net/fr/19", "https://tea-house.example.org/menu", "http://www.free-library.example.net/en/31",
    "https://m.river-walks.example.org/en/442?page=3", "http://choir.example.net/songs", "https://www.bakery.example.org/en/2",
    "http://court.example.org/rulings/12", "https://holiday-homes.example.net/en/6", "http://sunday-walks.example.org/fr/8", "https://senate.example.net/votes/3",
    "http://castle.example.org/en/10", "https://www.painter.example.net/de/64", "http://blog.winemaker.example.org/fr/2", "https://m.football.example.net/en/518",
    "http://geology.example.org/maps", "https://carpenter.example.net/es/30.html", "http://www.village.example.org/en/7?page=4", "https://lakes.example.net/walks/2",
    "http://m.philosophy.example.org/de/12", "https://printing.example.net/en/91", "http://www.bees-and-honey.example.org/fr/44/", "https://post-office.example.net/stamps",
    "http://theory.example.org/en/3", "https://blog.seasons.example.net/en/1200", "http://tunnel.example.org/de/6", "https://www.cathedral.example.net/es/15",
    "http://m.gardening.example.org/en/29", "https://clinic.example.net/hours", "http://www.telescope.example.org/en/404", "https://archive.example.net/fr/1911",
    "http://the-anchor.example.org/en/4", "https://www.another.example.net/de/17", "http://m.than-ever.example.net/fr/230", "https://blog.earth-then.example.org/es/5.html",
    "http://northland.example.net/en/61/", "https://www.mother-tongue.example.net/en/9?page=2", "http://m.brothers.example.org/de/3", "https://blog.gather-round.example.net/en/720",
    "http://weatherman.example.net/en/4", "https://www.either-or.example.org/de/17", "http://m.leather-goods.example.net/fr/230", "https://blog.feather.example.net/es/5.html",
    "http://panther.example.org/en/61/", "https://www.bath-house.example.net/en/9?page=2", "http://m.growth.example.net/de/3", "https://blog.fourth-wall.example.org/en/720",
    "http://health-office.example.net/en/4", "https://www.youth-centre.example.net/de/17", "http://m.method.example.org/fr/230", "https://blog.rhythm.example.net/es/5.html",
    "http://ether-net.example.net/en/61/", "https://www.ethics.example.org/en/9?page=2", "http://m.author-talks.example.net/de/3", "https://blog.cathode.example.net/en/720",
    "http://marathon.example.org/en/4", "https://www.python-notes.example.net/de/17", "http://m.lithium.example.net/fr/230", "https://blog.anthem.example.org/es/5.html",
    "http://mathematics.example.net/en/61/", "https://www.theatre-hall.example.net/en/9?page=2", "http://m.thunder.example.org/de/3", "https://blog.thicket.example.net/en/720",
    "http://threads.example.net/en/4", "https://www.that-river.example.org/de/17", "http://m.what-then.example.net/fr/230", "https://blog.within.example.net/es/5.html",
)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next / ? #, with A-Z folded; empty without one."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("string")
    for rule in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, each marked with its origin and its borders."""
    def cut(prefix: str, text: Column, n: int) -> Column:
        return F.when(F.length(text) >= n, F.transform(
            F.sequence(F.lit(1), F.length(text) - n + 1),
            lambda i: F.concat(F.lit(prefix), F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))
    marked = [("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(F.lit("^"), path, F.lit("$")))]
    return F.concat(*(cut(p, t, n) for p, t in marked for n in GRAMS))


def fit(spark: SparkSession) -> PipelineModel:
    rows = [(u, 1.0) for u in BLOCKED] + [(u, 0.0) for u in ALLOWED]
    # One value list in SQL, so that the table needs no Python worker either.
    table = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {y}D)" for u, y in rows) + " AS t(url, label)")
    table = table.select("label", grams(host_of(F.col("url")), path_of(F.col("url"))).alias("_grams"))
    hashed = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=FEATURES, binary=True)
    model = LogisticRegression(featuresCol="_features", labelCol="label", predictionCol="_prediction",
                               probabilityCol="_probability", rawPredictionCol="_raw", regParam=PENALTY,
                               standardization=False).fit(hashed.transform(table))
    return PipelineModel([hashed, model])


def judge_urls(pages: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, block_score.

    Reads page_id and url only, so other columns may have any name.  A NULL
    url or one without ``://`` has an empty host and path, and the model judges
    it like any other; repeated rows give equal rows; an empty table an empty result.
    """
    host, path = F.col("host"), F.col("path")
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    scored = fit(pages.sparkSession).transform(parsed.withColumn("_grams", grams(host, path)))
    score = vector_to_array("_probability")[1]
    return scored.select(
        "page_id", "host", "path", rule_of(host, path, lambda r: r[0] + r[1]).alias("rule"),
        F.coalesce(rule_of(host, path, lambda r: r[2]), F.when(score > BLOCK_AT, "block").otherwise("allow")).alias("verdict"),
        score.alias("block_score"))
