"""URL filters: rules on host and path, and for all other URLs logistic regression on hashed character n-grams.

Everything is DataFrame code.  The model is trained from a small labelled table of URLs (at most ``max_rows`` of them, taken in
order of their digests): the inner products of its rows make one square array, gradient steps on the rows' multipliers are a fold
over it, and the weights of the buckets are the multipliers summed by bucket, in whole billionths, so that no order of a sum
matters.  The model is one row of ``DIMS`` weights whatever the data, and it is a literal in the scan of the pages: judging needs no
shuffle and no join.

Defined cases: a null URL, or one without ``://``, has an empty host and path, to which no rule fits and of which the model knows
the bias alone; long URLs are read whole; repeated pages are rows of their own; of rules that tie in length the first counts; an
empty table gives no rows; columns besides ``page_id`` and ``url`` are not read.  Labelled rows without a URL or a label take no part;
without any labelled row all weights are 0, which allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

#: Buckets of the hash: the first 12 bits of a gram's MD5.
DIMS = 4096
SIZES = (3, 4, 5)
MAX_ROWS = 1000
STEPS, RATE, DECAY = 300, 0.5, 0.01

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: The rules of the query: action and host with path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: The labelled URLs of the query.
BLOCKED = (
    "http://casino-royal.test/slots", "https://www.best-casino.test/en/bonus", "http://online-casino.test/win", "https://m.win-big.test/jackpot",
    "http://poker-win.test/play.html", "https://free-bets-now.test/en/12", "http://www.bets365x.test/odds", "https://sports-bets.test/en/free?ref=x",
    "http://cheap-meds.test/pills", "https://pills-online.test/en/45", "http://www.buy-pills.test/cheap", "https://blog.cheap-viagra.test/en/order.html",
    "http://discount-pharma.test/cheap-pills/", "https://adult-video.test/en/7", "http://xxx-adult.test/watch", "https://www.adult-cams.test/live",
    "http://sexy-x.test/adult/", "https://ads-server.test/click?id=1", "http://track.ads-network.test/pixel", "https://m.ad-tracking.test/track?u=2",
    "http://www.tracker-ads.test/en/3", "https://spam-mail.test/list", "http://link-farm.test/en/99", "https://seo-spam.test/farm.html",
    "http://blog.spamlinks.test/en/5", "https://content-farm.test/en/top10", "http://free-money.test/win", "https://www.cheap-watches.test/replica",
    "http://payday-loans.test/free", "https://bet-win.test/de/4", "http://casino.test/fr/8", "https://spam.test/es/6",
)
ALLOWED = (
    "https://www.university.test/en/research", "http://library.test/catalogue", "https://en.encyclopedia.test/wiki/History", "http://news.test/en/2019/05/election.html",
    "https://blog.gardener.test/en/roses", "http://www.museum.test/fr/visite", "https://weather.test/de/berlin", "http://m.recipes.test/en/soup?page=2",
    "https://docs.software.test/en/install.html", "http://www.city-council.test/en/minutes", "https://hospital.test/en/opening-hours", "http://school.test/es/horario",
    "https://blog.traveller.test/en/norway#top", "http://orchestra.test/de/konzerte/", "https://www.theatre.test/en/programme", "http://otherpress.test/en/825",
    "https://thenorthern.test/en/412", "http://www.thistle.test/en/9", "https://m.heather.test/fr/31", "http://blog.lantern.test/de/77",
    "https://nation-archive.test/en/5?utm_source=feed", "http://stationers.test/es/64", "https://www.thermal.test/en/3", "http://threshold.test/en/18/",
    "https://blog.foundation.test/en/20", "http://rationale.test/en/41?page=2&ref=x", "https://this-and-that.test/en/8", "http://m.forthright.test/de/2",
    "https://www.handbook.test/en/33.html", "http://region.test/fr/12", "https://journal.test/en/issue/4", "http://observatory.test/en/stars",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lower-cased, and the path; both empty without one."""
    part = lambda k: F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), *_LOWER), part(2)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Longest rule that fits and its action, null where none does.  ``rules`` is a short list: it becomes one CASE."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):  # the last that is wrapped around is looked at first
        at = rule.index("/")
        of = F.concat(F.lit("."), host).endswith("." + rule[:at]) & path.startswith(rule[at:])
        name, action = F.when(of, rule).otherwise(name), F.when(of, verdict).otherwise(action)
    return name, action


def buckets(host: Column, path: Column) -> Column:
    """Distinct buckets of the character n-grams of host and path."""
    texts = (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.translate(path, *_LOWER)))
    # the characters are bound once: taken from the text at every place, a long URL would be read once for each of them
    return F.array_distinct(F.flatten(F.concat(*(F.transform(F.array(F.split(text, "")), _grams_of(mark)) for mark, text in texts))))


def _grams_of(mark: str):
    """Buckets of the n-grams of an array of characters; none where it is shorter."""

    def gram(c: Column, n: int) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(c) - n, F.lit(0))), lambda i: i <= F.size(c) - n)
        digest = lambda i: F.md5(F.concat(F.lit(mark), *[F.get(c, i + k) for k in range(n)]).cast("binary"))
        return F.transform(starts, lambda i: F.conv(F.substring(digest(i), 1, 3), 16, 10).cast("int"))

    return lambda c: F.concat(*[gram(c, n) for n in SIZES])


def seeds(spark: SparkSession) -> DataFrame:
    """The labelled table of the query: url, label (1: to block)."""
    rows = ", ".join(f"('{u}', {k})" for k, urls in ((1, BLOCKED), (0, ALLOWED)) for u in urls)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(url, label)")


def train(labelled: DataFrame, max_rows: int = MAX_ROWS, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> DataFrame:
    """The model, one row: ``weights`` (an array of ``DIMS``, in billionths) and ``bias``."""
    labelled = labelled.select("url", F.col("label").cast("double").alias("y")).where("url IS NOT NULL AND y IS NOT NULL")
    x = buckets(*host_and_path(F.col("url")))
    rows = labelled.orderBy(F.md5(F.col("url").cast("binary")), "url", "y").limit(max_rows).select("url", "y", x.alias("x"))
    one = materialize(rows.agg(F.array_sort(F.collect_list(F.struct("url", "y", "x"))).alias("r")), "url-rows")
    cell = lambda a, b: F.size(F.array_intersect(a["x"], b["x"])) / F.sqrt(F.greatest(F.size(a["x"]) * F.size(b["x"]), F.lit(1))) + 1  # noqa: E731  the 1 is the bias
    gram = materialize(one.select("r", F.transform("r", lambda a: F.transform("r", lambda b: cell(a, b))).alias("k"), F.transform("r", lambda a: a["y"]).alias("y")), "url-products")

    def step(alpha, _):
        def row(y, i):
            f = F.aggregate(F.zip_with(F.element_at("k", i + 1), alpha, lambda k, a: k * a), F.lit(0.0), lambda s, v: s + v)
            return F.element_at(alpha, i + 1) * (1 - rate * decay) + rate * (y - 1 / (1 + F.exp(-f)))

        return F.transform("y", row)

    alpha = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.transform("y", lambda y: F.lit(0.0)), step)
    multipliers = materialize(gram.select("r", alpha.alias("alpha")), "url-multipliers")
    each = multipliers.select(F.inline(F.arrays_zip("r", "alpha"))).select("alpha", "r.x")
    billionths = lambda v: F.round(v * 1e9).cast("long")
    sums = each.select(F.explode("x").alias("b"), billionths(F.col("alpha") / F.sqrt(F.size("x"))).alias("w")).groupBy("b").agg(F.sum("w").alias("w"))
    every = labelled.sparkSession.range(DIMS).select(F.col("id").cast("int").alias("b")).join(sums, "b", "left").select("b", F.coalesce("w", F.lit(0)).alias("w"))
    weights = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "w"))), lambda c: c["w"]).alias("weights"))
    return materialize(weights.crossJoin(each.agg(F.coalesce(F.sum(billionths(F.col("alpha"))), F.lit(0)).alias("bias"))), "url-model")


def score_of(host: Column, path: Column, model: DataFrame) -> Column:
    """The logit in billionths: over 0 is to block.  The model's one row, of a fixed size, becomes a literal."""
    row = model.first()
    x, weights = buckets(host, path), F.split(F.lit(",".join(map(str, row["weights"]))), ",").cast("array<long>")
    sums = F.aggregate(F.transform(x, lambda b: F.element_at(weights, b + 1)), F.lit(0).cast("long"), lambda s, w: s + w)
    return sums / F.sqrt(F.greatest(F.size(x), F.lit(1))) + F.lit(row["bias"])


def judge(pages: DataFrame, model: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict: the rule's, else the model's."""
    parts = pages.select("page_id", *(c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))))
    host, path = F.col("host"), F.col("path")
    rule, action = rule_of(host, path, rules)
    own = F.when(score_of(host, path, model) > 0, "block").otherwise("allow")
    return parts.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, own).alias("verdict"))
