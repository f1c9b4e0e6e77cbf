"""URL filter by association rules (DataFrame functions and Spark's FP-growth only).

URLs whose verdict is known become transactions of tokens (host labels, path
segments, names of query parameters) plus their verdict. FP-growth mines the
token combinations, rules that lead to a verdict are pruned by support and
confidence, and each rule stands in an inverted index under its rarest token:
a URL meets only the rules indexed under tokens it holds, and a rule fits if
all of its tokens are there. The most confident rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymarts.llm.common import save

ALLOW, BLOCK = "allow", "block"
#: A rule must hold in this share of the labelled URLs, and be right this often.
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of ``url``; all empty if it is NULL or holds no ``://``."""
    whole = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", whole)
    rest = F.when(at > 0, F.substr(whole, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return host, path, query


def url_tokens(host: Column, path: Column, query: Column) -> Column:
    """Distinct sorted tokens: ``h:`` host labels, ``p:`` path segments, ``q:`` names of query parameters."""

    def tokens(kind: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_sort(
        F.array_distinct(F.concat(tokens("h:", F.split(host, r"\.")), tokens("p:", F.split(path, "/")), tokens("q:", names)))
    )


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest of ``rules`` that fits; NULLs if none does.

    ``rules`` holds (verdict, ``host/path``) and is a parameter of the caller's
    policy, held in the plan. A rule fits its host and all subdomains of it, if
    the path starts with the rule's. Equal lengths: the longer host, then the
    rule that sorts first, wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    shortest_first = sorted(rules, key=lambda r: (len(r[1]), len(r[1].partition("/")[0]), [-ord(c) for c in r[1]]))
    for judged, text in shortest_first:
        own, slash, rest = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, judged).otherwise(verdict)
    return rule, verdict


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> tuple[DataFrame, DataFrame]:
    """Rules from ``labelled(tokens, verdict)``: ``(classes, rules)``, both written to the shared folder.

    ``classes(token, class)``: tokens that occur in exactly the same labelled
    URLs are one class (told by their count and the exclusive-or of 128-bit
    hashes of their rows), so that a URL repeated millions of times does
    not multiply the combinations of its own rare tokens; a class holds if any
    of its tokens does, which gives the rules that the single tokens would give.
    Tokens below the support take part in no rule and have no class.
    ``rules(classes, verdict, confidence, support)``: ``support`` counts the URLs
    with these classes and that verdict. A rule that stays as confident without
    one of its classes is dropped: the shorter one fits and wins wherever it does.

    Work: one map-side combined count of tokens, then Spark's FP-growth, whose
    list of frequent tokens (at most tokens per URL / ``min_support``) is all
    that meets on the driver. An empty table gives no rules.
    """
    # A hash of the row, not of its content, tells repeated rows apart; it is written, so a lost task cannot draw anew.
    rows = save(labelled.select("tokens", "verdict", F.monotonically_increasing_id().alias("row")), "labelled-urls")
    total = rows.count()
    least = max(1, -int(-(min_support * total) // 1))
    same = (
        rows.select(F.explode("tokens").alias("token"), F.xxhash64("row").alias("h"), F.xxhash64("row", F.lit("again")).alias("g"))
        .groupBy("token")
        .agg(F.count("*").alias("count"), F.bit_xor("h").alias("h"), F.bit_xor("g").alias("g"))
        .where(F.col("count") >= least)
    )
    named = same.groupBy("count", "h", "g").agg(F.collect_set("token").alias("tokens"))
    classes = save(
        named.select(F.array_min("tokens").alias("class"), "count", F.explode("tokens").alias("token")), "url-token-classes"
    )
    if not total or not classes.limit(1).count():
        none = {"classes": "array<string>", "verdict": "string", "confidence": "double", "support": "long"}
        return classes, labelled.sparkSession.range(0).select(*(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    baskets = (
        rows.select("row", "verdict", F.explode("tokens").alias("token"))
        .join(classes.select("token", "class"), "token")
        .groupBy("row", "verdict")
        .agg(F.collect_set("class").alias("classes"))
        .select(F.concat("classes", F.array(F.concat(F.lit("v:"), "verdict"))).alias("items"))
    )
    baskets = save(baskets, "url-baskets")
    # FP-growth counts the share of the rows it is given; rows without a frequent token are not among them.
    share = min(1.0, max(0.0, (least - 0.5) / max(1, baskets.count())))
    model = FPGrowth(itemsCol="items", minSupport=share).fit(baskets)
    found = model.freqItemsets
    is_verdict = lambda x: F.startswith(x, F.lit("v:"))
    sets = found.select(
        F.array_sort(F.filter("items", lambda x: ~is_verdict(x))).alias("classes"),
        F.array_max(F.filter("items", is_verdict)).alias("verdict"),
        F.col("freq").alias("support"),
    ).where(F.size("classes") > 0)
    sets = save(sets, "url-itemsets")
    alone = sets.where("verdict IS NULL").select("classes", F.col("support").alias("seen"))
    rules = (
        sets.where("verdict IS NOT NULL")
        .join(alone, "classes")
        .select("classes", F.substring("verdict", 3, 1 << 20).alias("verdict"), (F.col("support") / F.col("seen")).alias("confidence"), "support")
        .where(F.col("confidence") >= min_confidence)
    )
    rules = save(rules, "url-rules")
    without_one = rules.select(
        F.explode("classes").alias("_c"), "classes", "verdict", F.col("confidence").alias("own")
    ).select(F.array_remove("classes", F.col("_c")).alias("shorter"), F.col("classes").alias("longer"), "verdict", "own")
    shorter = rules.select(F.col("classes").alias("shorter"), "verdict", "confidence")
    needless = without_one.join(shorter, ["shorter", "verdict"]).where("confidence >= own")
    needless = needless.select(F.col("longer").alias("classes"), "verdict").distinct()
    return classes, save(rules.join(needless, ["classes", "verdict"], "left_anti"), "url-rules-kept")


def judge_tokens(tokens: DataFrame, classes: DataFrame, rules: DataFrame) -> DataFrame:
    """``(tokens, verdict, confidence, support)`` of the distinct token lists that a rule fits.

    ``tokens(tokens)`` may repeat. Each rule is indexed under its rarest class;
    of the rules that fit, the most confident wins, then the one with more
    support, then ``block``.
    """
    rare = classes.select("class", "count").distinct()
    index = (
        rules.select("*", F.explode("classes").alias("class"))
        .join(rare, "class")
        .groupBy("classes", "verdict", "confidence", "support")
        .agg(F.min_by("class", F.struct("count", "class")).alias("class"))
    )
    known = (
        tokens.select("tokens")
        .distinct()
        .select("tokens", F.explode("tokens").alias("token"))
        .join(classes.select("token", "class"), "token")
        .groupBy("tokens")
        .agg(F.collect_set("class").alias("held"))
    )
    met = known.select("tokens", "held", F.explode("held").alias("class")).join(index, "class")
    fits = met.where(F.forall("classes", lambda c: F.array_contains("held", c)))
    best = F.max(F.struct("confidence", "support", (F.col("verdict") == BLOCK).alias("blocks"), "verdict"))
    return fits.groupBy("tokens").agg(best.alias("best")).select("tokens", "best.verdict", "best.confidence", "best.support")


def filter_urls(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = (),
    labelled: DataFrame | None = None,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    otherwise: str = ALLOW,
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, ``confidence`` for every row of ``pages``.

    ``rules`` (verdict, ``host/path``) judge first, the longest that fits. Other
    URLs are judged by association rules mined from ``labelled(url, verdict)``,
    by default the URLs of ``pages`` that ``rules`` judge: all of them, repeats
    included. ``confidence`` is the mined rule's; NULL where ``rules`` or, if
    nothing fits, ``otherwise`` decides.

    NULL URLs and URLs without ``://`` have empty host and path and get
    ``otherwise``. Repeated rows are judged alike; NULL keys stay. Other columns
    are not read, so names cannot clash. Verdicts are found once per distinct
    token list (combined map-side) and joined back; the join may be split where
    one list holds much of the table, and rows that ``rules`` judge or that have
    no tokens are not shuffled. An empty table gives no rows.
    """
    host, path, query = url_parts(F.col(url))
    named = pages.select(F.col(key), host.alias("host"), path.alias("path"), query.alias("_query"))
    rule, judged = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = named.select(
        F.col(key), "host", "path", rule.alias("rule"), judged.alias("_judged"), url_tokens(F.col("host"), F.col("path"), F.col("_query")).alias("tokens")
    )
    if labelled is None:
        known = rows.where("_judged IS NOT NULL").select("tokens", F.col("_judged").alias("verdict"))
    else:
        parts = labelled.select(*(c.alias(n) for c, n in zip(url_parts(F.col("url")), ("host", "path", "query"))), "verdict")
        known = parts.select(url_tokens(F.col("host"), F.col("path"), F.col("query")).alias("tokens"), "verdict").where("verdict IS NOT NULL")
    classes, mined = mine_rules(known, min_support, min_confidence)
    # Rows that need no lookup take no part in the join: their common key would land in one task.
    asks = F.col("_judged").isNull() & (F.size("tokens") > 0)
    asked = rows.where(asks)
    verdicts = judge_tokens(asked.select("tokens"), classes, mined).select("tokens", F.col("verdict").alias("_mined"), "confidence")
    looked_up = asked.join(verdicts, "tokens", "left")
    rest = rows.where(~asks).withColumns({"_mined": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    return looked_up.unionByName(rest).select(
        F.col(key), "host", "path", "rule", F.coalesce("_judged", "_mined", F.lit(otherwise)).alias("verdict"), "confidence"
    )
