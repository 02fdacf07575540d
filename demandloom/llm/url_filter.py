"""URL filter: allow and block rules, then logistic regression on hashed character n-grams.

All of it is DataFrame expressions: a URL becomes an array of n-gram buckets, the model is one
array of weights, and each training step is an aggregation over the small labelled table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Buckets that n-grams are hashed to: the size of the model.
BUCKETS = 2048
GRAMS = (3, 4, 5)


class Rule(NamedTuple):
    """A verdict on a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the contract.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

#: The labelled URL table, hosts with paths by verdict.
LABELLED = {
    "block": (
        "http://casino-royal.example/play", "https://www.best-casino.example/slots/7", "http://lucky-bets.example/en/1",
        "https://sports-bets.example/odds", "http://poker-win.example/join", "https://jackpot-slots.example/free",
        "http://cheap-meds.example/buy", "https://buy-pills.example/order/3", "http://pharmacy-deals.example/pills",
        "https://cheap-watches.example/sale", "http://adult-chat.example/live", "https://www.adult-videos.example/en/9",
        "http://xxx-tube.example/watch", "https://hot-dates.example/adult", "http://spam-mail.example/send",
        "https://bulk-spam.example/list", "http://seo-farm.example/links", "https://link-farm.example/page/2",
        "http://content-farm.example/en/8", "https://ads-server.example/click", "http://www.ad-track.example/pixel",
        "https://track-click.example/r", "http://pop-ads.example/show", "https://free-money.example/win",
        "http://win-prize.example/claim", "https://free-gift.example/cards", "http://phish-login.example/bank",
        "https://malware-host.example/exe", "http://warez-crack.example/keys", "https://free-crack.example/serial",
        "http://payday-loans.example/apply", "https://crypto-double.example/send",
    ),
    "allow": (
        "https://news.example/world/article", "http://www.daily-herald.example/en/120", "https://weather.example/forecast",
        "http://blog.gardener.example/roses", "https://library.example/catalog/88", "http://museum.example/visit",
        "https://university.example/courses", "http://school.example/calendar", "https://wiki.example/history",
        "http://encyclopedia.example/physics", "https://recipes.example/bread", "http://kitchen.example/de/31",
        "https://travel-notes.example/alps", "http://maps.example/city", "https://science.example/journal/4",
        "http://research.example/papers", "https://health.example/advice", "http://hospital.example/contact",
        "https://www.city-council.example/minutes", "http://parliament.example/debates", "https://music.example/albums",
        "http://theatre.example/tickets", "https://books.example/reviews/fr/12", "http://poetry.example/es/7",
        "https://docs.example/manual", "http://forum.example/thread/52", "https://code.example/project",
        "http://open-data.example/tables", "https://m.reader.example/en/42", "http://blog.writer.example/2020/05",
        "https://photo.example/gallery", "http://shop.example/garden-tools",
    ),
}


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: ``url, label`` with 1 for block."""
    rows = [F.struct(F.lit(url).alias("url"), F.lit(int(kind == "block")).alias("label")) for kind, urls in LABELLED.items() for url in urls]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_of(url: str = "url") -> Column:
    """Host of a URL; empty for NULL or without ``://``."""
    rest = F.substring_index(F.col(url), "://", 1)
    after = F.substr(F.col(url), F.length(rest) + 4)
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.when(F.contains(F.col(url), F.lit("://")), host).otherwise("")


def path_of(url: str = "url") -> Column:
    """Path of a URL, from the end of the host up to ``?`` or ``#``."""
    rest = F.substring_index(F.col(url), "://", 1)
    after = F.substr(F.col(url), F.length(rest) + 4)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.contains(F.col(url), F.lit("://")), path).otherwise("")


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, NULL if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _buckets_of(marked: Column, field: str, n: int, buckets: int) -> Column:
    whole = F.length(marked) - n + 1
    places = F.filter(F.sequence(F.lit(1), F.greatest(whole, F.lit(1))), lambda i: i <= whole)
    return F.transform(
        places,
        lambda i: F.pmod(F.xxhash64(F.concat(F.lit(f"{field}{n}"), F.substr(marked, i, F.lit(n)))), F.lit(buckets)).cast("int"),
    )


def gram_buckets(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Distinct buckets of the n-grams of host and path; digits are all alike."""
    out = []
    for field, value in (("h", host), ("p", path)):
        marked = F.concat(F.lit("^"), F.regexp_replace(value, "[0-9]+", "0"), F.lit("$"))
        out += [_buckets_of(marked, field, n, buckets) for n in GRAMS]
    return F.array_distinct(F.concat(*out))


def _array_literal(values: list[float]) -> Column:
    """A constant array that the optimizer folds into one literal."""
    return F.split(F.lit(",".join(f"{v:.7g}" for v in values)), ",").cast("array<double>")


def _margin(grams: Column, weights: Column, buckets: int = BUCKETS) -> Column:
    """Log-odds of block; the bias is the weight after the last bucket's."""
    total = F.aggregate(grams, F.lit(0.0), lambda acc, b: acc + F.get(weights, b))
    return F.get(weights, F.lit(buckets)) + total / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double"))


def train(
    labelled: DataFrame,
    steps: int = 30,
    rate: float = 6.0,
    penalty: float = 5e-4,
    block_share: float = 0.25,
    buckets: int = BUCKETS,
) -> list[float]:
    """Weights, with the bias last, by gradient descent with momentum on the penalised log loss.

    ``labelled`` has ``url`` and ``label`` (1: block) and is meant to be small. Its rows are weighed
    so that blocked URLs make up ``block_share``, as they do among pages. A step brings one
    sum a bucket to the driver. Rows without a label are left out; without rows all is 0.
    """
    scratch = Scratch(labelled.sparkSession, "url-filter")
    known = labelled.filter(F.col("label").isNotNull())
    rows = scratch.keep(
        "train", known.select(F.col("label").cast("double").alias("label"), gram_buckets(host_of(), path_of(), buckets).alias("grams"))
    ).coalesce(1)
    count, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    weights, speed = [0.0] * (buckets + 1), [0.0] * (buckets + 1)
    if not count:
        return weights
    share = F.when(F.col("label") > 0.5, block_share / max(blocked, 1.0)).otherwise((1 - block_share) / max(count - blocked, 1.0))
    unit = 1 / F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))
    for _ in range(steps):
        chance = 1 / (1 + F.exp(-_margin(F.col("grams"), _array_literal(weights), buckets)))
        features = F.concat(
            F.array(F.struct(F.lit(buckets).alias("bucket"), F.lit(1.0).alias("value"))),
            F.transform("grams", lambda b: F.struct(b.alias("bucket"), unit.alias("value"))),
        )
        gap = rows.select(((F.col("label") - chance) * share).alias("gap"), F.inline(features))
        for r in gap.groupBy("bucket").agg(F.sum(F.col("gap") * F.col("value")).alias("sum")).collect():
            speed[r["bucket"]] += r["sum"]
        for b in range(buckets + 1):
            speed[b] -= penalty * weights[b] * (b < buckets)
            weights[b] += rate * speed[b]
            speed[b] *= 0.9
    scratch.drop("train")
    return weights


def judge_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    labelled: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` of each row of ``pages``.

    A NULL or malformed URL has an empty host and path, fits no rule and is judged by the model
    like any other. Repeated rows are judged alike. Extra columns are ignored.
    """
    weights = train(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    parts = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    text, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    margin = _margin(gram_buckets(F.col("host"), F.col("path")), _array_literal(weights))
    judged = parts.withColumn("block_score", 1 / (1 + F.exp(-margin)))
    by_model = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "block_score"
    )
