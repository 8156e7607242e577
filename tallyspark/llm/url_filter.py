"""URL filter: rules, then a character language-model ratio, with DataFrame functions only.

URLs that a rule decides are the labelled ones. Two models over the characters of a URL, one of the
accepted and one of the rejected URLs, predict each character from the two before it; an unseen or
rare context falls back to shorter ones (interpolated Witten-Bell smoothing, so the order varies with
what was seen). A URL's score is the difference of its log-likelihoods per character. The threshold is
calibrated on every fifth labelled URL, which the models do not see: it lies between the two classes'
means, at the same number of standard deviations from each.

Counts cover all other labelled URLs. Characters outside visible ASCII share one symbol, so a model has at
most 97 ** 3 rows of some 60 bytes, which is the proven bound of the broadcast. Null URLs and those
without "://" have empty host and path and are scored as they are (null as the empty text); repeated
rows stay; without labelled URLs every score is 0 and the verdict is block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import stored

#: Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
SYMBOLS = 97
SCALE = 1_000_000  # scores are summed as whole millionths, so sums do not depend on their order

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    place = F.locate("://", url)
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    pattern = r"^([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(rest, pattern, 1), _UPPER, _LOWER), F.regexp_extract(rest, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, where, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(where + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _places(judged: DataFrame) -> DataFrame:
    """A row per character of a URL: the two characters before it and itself."""
    shown = F.regexp_replace(F.translate(F.coalesce("url", F.lit("")), _UPPER, _LOWER), r"[^\x21-\x7E]", " ")
    marked = F.concat(F.lit("  "), shown, F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.length(shown) + 1), lambda i: F.substr(marked, i, F.lit(3)))
    return judged.select("*", F.posexplode(grams).alias("place", "gram"))


def _smoothed(counts: DataFrame, n: str) -> DataFrame:
    """gram, log-probability of its last character after the two before it, for counts in column n."""
    tri = counts.select("gram", F.substring("gram", 1, 2).alias("ab"), F.substring("gram", 2, 2).alias("bc"), F.col(n).alias("n"))
    pairs = tri.groupBy("bc").agg(F.sum("n").alias("n"))
    pairs = pairs.select("bc", F.substring("bc", 1, 1).alias("b"), F.substring("bc", 2, 1).alias("c"), "n")
    ones = pairs.groupBy("c").agg(F.sum("n").alias("n"))
    total = ones.agg(F.sum("n").alias("all"), F.sum((F.col("n") > 0).cast("long")).alias("kinds"))

    def contexts(table: DataFrame, key: str) -> DataFrame:
        return table.groupBy(key).agg(F.sum("n").alias("all"), F.sum((F.col("n") > 0).cast("long")).alias("kinds"))

    def blend(lower: Column) -> Column:
        weight = F.col("all") + F.col("kinds")
        return F.when(weight > 0, (F.col("n") + F.col("kinds") * lower) / weight).otherwise(lower)

    p0 = ones.crossJoin(F.broadcast(total)).select("c", blend(F.lit(1.0 / SYMBOLS)).alias("p0"))  # one row
    p1 = pairs.join(contexts(pairs, "b"), "b").join(p0, "c").select("bc", blend(F.col("p0")).alias("p1"))
    p2 = tri.join(contexts(tri, "ab"), "ab").join(p1, "bc").select("gram", F.log(blend(F.col("p1"))).alias("logp"))
    return p2


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, verdict, score (log-likelihood ratio per character), threshold."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("ruled", ruled)
    held = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    places = _places(rows.withColumn("held", held))
    learn = ~F.col("held")
    counts = places.groupBy("gram").agg(
        F.sum((learn & (F.col("ruled") == "allow")).cast("long")).alias("accepted"),
        F.sum((learn & (F.col("ruled") == "block")).cast("long")).alias("rejected"),
    )
    counts = stored(counts.fillna(0), "url-grams")
    yes, no = _smoothed(counts, "accepted"), _smoothed(counts, "rejected").withColumnRenamed("logp", "other")
    gain = F.round((F.col("logp") - F.col("other")) * SCALE).cast("long")
    ratios = stored(yes.join(no, "gram").select("gram", gain.alias("gain")), "url-ratios")
    keys = ["page_id", "url", "host", "path", "rule", "ruled", "held"]
    scored = (
        places.join(F.broadcast(ratios), "gram")
        .groupBy(*keys)
        .agg(F.sum("gain").alias("gain"), F.count("gain").alias("n"), F.sum((F.col("place") == 0).cast("int")).alias("rows"))
        .withColumn("score", F.col("gain") / F.col("n") / SCALE)
    )
    scored = stored(scored.drop("gain", "n"), "url-scores")
    classes = scored.where("held and ruled is not null").agg(
        *[
            f(F.when(F.col("ruled") == kind, F.col("score"))).alias(f"{kind}_{name}")
            for kind in ("allow", "block")
            for name, f in (("mean", F.mean), ("sd", F.stddev_pop))
        ]
    )
    spread = F.col("allow_sd") + F.col("block_sd")
    between = F.when(
        spread > 0, (F.col("allow_mean") * F.col("block_sd") + F.col("block_mean") * F.col("allow_sd")) / spread
    ).otherwise((F.col("allow_mean") + F.col("block_mean")) / 2)
    threshold = classes.select(F.coalesce(between, F.lit(0.0)).alias("threshold"))
    out = scored.crossJoin(F.broadcast(threshold))  # one row
    own = F.when(F.col("score") > F.col("threshold"), "allow").otherwise("block")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows")))).select(
        "page_id", "url", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score", "threshold"
    )
