"""URL filtering by association rules.

Pages with a label become baskets: the tokens of the URL and, if the page is
bad, a marker.  Spark's FP-growth finds the frequent baskets; rules that end
in the marker are kept by confidence, lift and support, and a rule that a shorter
kept rule implies is dropped.  Rules are matched by an inverted index: each
is posted under its rarest token, met by the pages that have the token, and
verified in full.  A list of given rules goes before the mined ones.
Everything is DataFrame expressions and Spark ML.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.shared import UPPER, cut, replace_columns, small_or_shuffled

MIN_CONFIDENCE = 0.6
#: A rule's confidence must be above this many times the share of bad pages.
MIN_LIFT = 1.0
#: Bad pages a rule must have been seen on, whatever the number of pages.
MIN_PAGES = 20
BAD = "label=bad"
#: (host, path, verdict) of the given list.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
OUT = ("host", "path", "rule", "verdict")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    has = F.coalesce(at > 0, F.lit(False))
    return (F.when(has, F.translate(host, UPPER, UPPER.lower())).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit("")))


def _list_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest given rule that fits, and its verdict; null if none.

    A rule's length is that of its host and path together; its path starts
    with ``/``.  An empty host fits no rule."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[0], r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: the host, its labels, the path's parts (digits as
    one token), and the depth."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("label:"), x))
    parts = F.transform(F.filter(F.split(path, r"[/.]+"), lambda x: x != ""),
                        lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, r"[0-9]+", "#")))
    depth = F.concat(F.lit("depth:"), F.size(F.split(path, "/")).cast("string"))
    return F.array_distinct(F.concat(F.array(F.concat(F.lit("host:"), host)), labels, parts, F.array(depth)))


def document_id(url: Column) -> Column:
    """The id of the document that a page shows: the number that is the last
    part of its path, an ending apart; null if there is none."""
    return F.regexp_extract(host_and_path(url)[1], r"/([0-9]+)(?:\.[A-Za-z]+)?/?$", 1).try_cast("long")


def mine(pages: DataFrame, labels: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT,
         min_pages: int = MIN_PAGES) -> DataFrame:
    """(tokens, confidence, support) of rules "these tokens: bad".

    ``labels`` has doc_id, quality and toxic; a page is bad if a label of
    its page_id, which is the id that labels go by, says quality 0 or toxic
    1.  Pages without a label teach nothing.  Without labelled pages there
    are no rules.

    A rule needs ``min_pages`` bad pages at every size of the table.  Each
    of its tokens is then on as many bad pages, so tokens on fewer are left
    out of the baskets before they are mined."""
    host, path = host_and_path(F.col("`url`"))
    marked = labels.groupBy(F.col("`doc_id`").alias("__id")).agg(
        F.max(F.coalesce((F.col("`quality`") == 0) | (F.col("`toxic`") == 1), F.lit(False))).alias("bad"))
    known = pages.select(F.col("`page_id`").alias("__page"), tokens(host, path).alias("t")).join(marked, F.col("__page") == F.col("__id"))
    baskets = cut(known.select(F.monotonically_increasing_id().alias("row"),
                               F.when(F.col("bad"), F.concat("t", F.array(F.lit(BAD)))).otherwise(F.col("t")).alias("items"), "bad"))
    n = baskets.count()
    if not n:
        return pages.sparkSession.createDataFrame([], "tokens array<string>, confidence double, support double")
    often = cut(baskets.where("bad").select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") >= min_pages).select("item"))
    left = (baskets.select("row", F.explode("items").alias("item")).join(small_or_shuffled(often, 64), "item")
            .groupBy("row").agg(F.collect_set("item").alias("items")))
    mined = cut(baskets.select("row").join(left, "row", "left").select(F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    least = min(1.0, (min_pages - 0.5) / n)  # the half keeps rounding from asking for a page more
    sets = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(mined)
    rules = cut(sets.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("lift") > min_lift))
                .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    shorter = rules.select(F.explode("tokens").alias("first"), F.col("tokens").alias("part"), F.col("confidence").alias("c"))
    implied = (rules.select("tokens", "confidence", F.explode("tokens").alias("first")).join(shorter, "first")
               .where((F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0) & (F.col("c") >= F.col("confidence")))
               .select("tokens").distinct())
    return rules.join(implied, "tokens", "left_anti")


def url_filter(pages: DataFrame, rules: DataFrame, given=RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict (allow or block).

    The longest given rule decides; without one a page is blocked if it has
    all tokens of a mined rule, else allowed.  Null urls and urls without
    ``://`` have an empty host and path, no rule, and are judged by the
    mined rules like any other.  Repeated rows are judged alike; an empty
    table gives an empty result; input columns named like an added column
    are replaced.
    """
    pages = replace_columns(pages, *OUT)
    host, path = host_and_path(F.col("`url`"))
    name, verdict = _list_rule(F.col("host"), F.col("path"), given)
    seen = pages.withColumns({"host": host, "path": path}).withColumns({"rule": name, "__listed": verdict})
    places = seen.where("__listed is null").select(F.col("host").alias("h"), F.col("path").alias("p")).distinct()
    has = cut(places.withColumn("tokens", tokens(F.col("h"), F.col("p"))))
    often = has.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    numbered = cut(rules.select("tokens").distinct())
    posted = (numbered.select(F.col("tokens").alias("rule_tokens"), F.explode("tokens").alias("token"))
              .join(often, "token", "left").groupBy("rule_tokens")
              .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    index = small_or_shuffled(cut(posted), 400)
    hit = (has.select("h", "p", "tokens", F.explode("tokens").alias("token")).join(index, "token")
           .where(F.size(F.array_except("rule_tokens", "tokens")) == 0).select("h", "p").distinct())
    blocked = cut(hit.withColumn("__mined", F.lit(True)))
    joined = seen.join(small_or_shuffled(blocked, 300), (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    final = F.coalesce("__listed", F.when(F.col("__mined"), F.lit("block")), F.lit("allow"))
    return joined.withColumn("verdict", final).drop("h", "p", "__mined", "__listed")
