"""Filter addresses: rules on host and path first, then a logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAMS = (3, 4, 5)
FEATURES = 1 << 14
STRENGTH = 0.003
#: Labelled rows the model is fitted on at most; more are thinned by hash.
LABELLED_ROWS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``site`` is a host, a slash and perhaps more of a path; it holds for the host and all its subdomains."""

    verdict: str
    site: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.site.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)

# The labelled addresses. Kinds of sites that a text corpus leaves out, and ordinary ones.
BLOCKED = """
casino.test/play best-casino.test/slots online-casino.test/bonus casino-royal.test/games live-casino.test/en poker-room.test/join
win-big.test/jackpot lotto-win.test/now mega-jackpot.test/win slots-win.test/free free-slots.test/spin sports-bets.test/odds
bets-online.test/odds betting-tips.test/today free-bet.test/offer gamble-now.test/bonus bingo-bonus.test/play roulette-win.test/en
cheap-meds.test/order pills-online.test/buy diet-pills.test/offer viagra-shop.test/cheap pharma-cheap.test/rx buy-pills.test/cheap
cheap-viagra.test/shop generic-cialis.test/buy cheap-replica.test/watches replica-bags.test/sale cheap-loans.test/apply payday-loan.test/fast
ads-server.test/click track-clicks.test/pixel adtracker.test/banner popup-ads.test/show click-track.test/r banner-ads.test/img
ad-network.test/serve tracking-pixel.test/t pop-track.test/in ads-click.test/go ads.tracker.test/x spam-links.test/list
link-farm.test/links seo-spam.test/backlinks content-farm.test/x farm-links.test/seo spam-blog.test/post backlink-farm.test/buy
adult-video.test/watch xxx-tube.test/free porn-hub.test/video sex-cams.test/live nude-pics.test/gallery hot-escorts.test/city
adult-dating.test/join xxx-pics.test/en adult-x.test/tube free-porn.test/hd warez-crack.test/keygen free-cracks.test/serial
torrent-movies.test/hd free-keygen.test/download phish-login.test/verify-account malware-drop.test/setup.exe get-rich.test/crypto-double crypto-giveaway.test/win
""".split()
ALLOWED = """
news.test/world dailynews.test/politics/2020 times.test/culture/article herald.test/local/story gazette.test/en/12 weather.test/forecast
wiki.test/wiki/History encyclopedia.test/entry/physics library.test/catalog/books archive.test/details/letters museum.test/exhibits/art dictionary.test/word/house
university.test/faculty/science school.test/students/handbook college.test/courses/math research.test/papers/climate journal.test/volume/4/paper institute.test/reports/annual
blog.test/2019/05/garden myblog.test/posts/travel cooking.test/recipes/soup kitchen.test/recipe/bread gardening.test/plants/roses photography.test/tips/light
forum.test/thread/123 community.test/topic/help docs.test/guide/install developer.test/reference/api software.test/manual/en opensource.test/project/readme
health.test/conditions/flu hospital.test/departments/surgery clinic.test/appointments doctor.test/advice/sleep nutrition.test/articles/vitamins medicine.test/research/heart
government.test/services/passport city.test/council/minutes parliament.test/debates/budget court.test/opinions/2018 police.test/safety/road ministry.test/press/release
travel.test/guides/rome hotel.test/rooms/view railway.test/timetable/north airport.test/departures maps.test/place/bridge mountain.test/trails/summit
music.test/albums/jazz theatre.test/season/plays film.test/reviews/drama books.test/author/novel poetry.test/poem/spring art.test/gallery/portrait
science.test/nature/birds astronomy.test/planets/mars biology.test/cells/membrane history.test/ancient/greece economy.test/markets/trade football.test/match/report
other.test/en/825 thether.test/fr/200 erthan.test/de/77 mention.test/es/310 atherst.test/en/9 theren.test/en/4021.html
www.station.test/fr/640 m.nation.test/en/31 blog.theory.test/de/55 www.weather.test/es/8 m.reading.test/en/17?page=2 blog.history.test/fr/3 www.another.test/en/1290
""".split()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url and one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table ``host, path, label``; label 1 is to be blocked."""
    rows = [(*url.partition("/")[::2], label) for label, urls in ((1.0, BLOCKED), (0.0, ALLOWED)) for url in urls]
    return spark.createDataFrame(rows, "host string, path string, label double").withColumn(
        "path", F.concat(F.lit("/"), "path"))


def _characters(rows: DataFrame) -> DataFrame:
    """Host without its last label, which says nothing of the content, and path, as marked characters."""
    name = F.regexp_replace("host", r"\.[^.]*\z", "")
    marked = F.concat(F.lit("^"), name, F.lit("$"), F.translate("path", UPPER, LOWER))
    return rows.withColumn("__characters", F.split(marked, ""))


def fit(labelled: DataFrame, limit: int = LABELLED_ROWS) -> PipelineModel:
    """Fit on ``host, path, label``; of more than ``limit`` rows those with the smallest hashes are taken."""
    rows = _characters(labelled.orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(limit)).coalesce(1).cache()
    stages = []
    for n in GRAMS:
        stages += [
            NGram(n=n, inputCol="__characters", outputCol=f"__grams{n}"),
            HashingTF(numFeatures=FEATURES, binary=True, inputCol=f"__grams{n}", outputCol=f"__counts{n}"),
        ]
    stages += [
        VectorAssembler(inputCols=[f"__counts{n}" for n in GRAMS], outputCol="__features"),
        LogisticRegression(
            featuresCol="__features", labelCol="label", regParam=STRENGTH, standardization=False,
            probabilityCol="__probability", predictionCol="__prediction", rawPredictionCol="__raw"),
    ]
    model = Pipeline(stages=stages).fit(rows)
    rows.unpersist()
    return model


def judge(pages: DataFrame, model: PipelineModel, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row of ``pages`` (``page_id, url``; other columns are ignored) ``page_id, host, path, rule, verdict, score``.

    The longest rule that fits decides, else the model: ``score`` is its probability that the address is to be blocked, and
    0.5 or more blocks. A null url, or one without ``://``, has empty host and path, fits no rule and is allowed with score
    0, as is one that has neither behind its ``://``. Rows are judged one by one; an empty table gives none.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("bigint"), host.alias("host"), path.alias("path"))
    scored = model.transform(_characters(rows))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: len(r.site)):
        fits = one.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, F.lit(one.site)).otherwise(rule)
        verdict = F.when(fits, F.lit(one.verdict)).otherwise(verdict)
    score = F.when(F.concat("host", "path") == "", 0.0).otherwise(vector_to_array("__probability")[1])
    return scored.select("page_id", "host", "path", rule.alias("rule"), score.alias("score"), verdict.alias("ruled")).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
