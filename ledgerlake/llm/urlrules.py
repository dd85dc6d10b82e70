"""URL filtering by mined association rules, after a list of given rules.

``split_url`` cuts host and path; ``given_rule`` finds the longest given rule
(host and all subdomains, path prefix). Urls that no given rule fits are
judged by rules mined with Spark's FP-growth: a labelled url is a transaction of
its tokens (host labels, path segments, file ending, query) and its verdict.
Only labelled urls are transactions, so the confidence of a rule is its share
of the labelled urls it covers. Rules that reach the support and confidence
asked for are matched through an inverted index from token to rule: a rule
fires when all its tokens are met. A block needs a fired block rule of higher
confidence than every fired allow rule; all other urls are allowed.

Block rules are held back that only repeat how the labels came about. The
expected blocks of a rule are the block rates of the urls it covers, each taken
over the labelled urls whose hosts the same given rules fit (where only block
rules exist, that is 1 and says nothing); it must have ``least_z`` deviations
more. And where the given rules are the labels, its blocked urls must come from
given rules of two hosts: "/en/ is blocked on one host" is no rule for others.

Only DataFrame functions and Spark ML run; no Python code runs on rows.

Defined results: a null url, or one without ``://``, has empty host and path
and is allowed; repeated rows are judged alike; repeated or null ids are kept
row by row (ids play no part in matching); an empty table gives no rows;
further columns are ignored. Labels other than block and allow are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import LOWER, UPPER, stash

VERDICT = "verdict="


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) columns of a url column."""
    at = F.instr(url, "://")
    rest = F.when(url.isNull() | (at == 0), F.lit("")).otherwise(
        F.substring(url, at + F.lit(3), F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct(size, rule, verdict), else null.
    ``rules``: (host, path, verdict); the list becomes part of the plan."""
    table = F.array(*[F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(h + p).alias("rule"),
                               F.lit(v).alias("verdict"), F.lit(h).alias("h"),
                               F.lit("." + h).alias("sub"), F.lit(p).alias("p"))
                      for h, p, v in rules])
    fits = F.filter(table, lambda r: ((host == r["h"]) | F.endswith(host, r["sub"]))
                    & F.startswith(path, r["p"]))
    return F.array_max(fits)


def scope(host: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The hosts of the given rules that fit a host, as text."""
    names = F.array(*[F.lit(h) for h in sorted({h for h, _, _ in rules})])
    return F.array_join(F.filter(names, lambda h: (host == h) | F.endswith(host, F.concat(F.lit("."), h))), " ")


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url: host labels numbered from the right and folders
    numbered from the left (the fourth and further as one), words of the last
    path segment, file ending, query keys and key-value pairs."""
    def parts(text, sign):
        return F.filter(F.split(text, sign), lambda x: x != "")

    def numbered(name, xs):
        return F.transform(xs, lambda x, i: F.concat(
            F.lit(name), F.least(i + 1, F.lit(4)).cast("string"), F.lit("="), x))

    labels = numbered("host", F.reverse(parts(host, "[.]")))
    folders = numbered("folder", parts(F.regexp_extract(path, "^(.*/)", 1), "/"))
    last = F.regexp_extract(path, "([^/]*)$", 1)
    ending = F.regexp_extract(last, "[.]([A-Za-z0-9]{1,8})$", 1)
    stem = F.regexp_replace(last, "[.][A-Za-z0-9]{1,8}$", "")
    names = F.transform(parts(F.translate(stem, UPPER, LOWER), "[-_.+,;~!%]+"), lambda x: F.concat(F.lit("word="), x))
    endings = F.filter(F.array(F.concat(F.lit("ending="), ending)), lambda x: x != "ending=")
    pairs = parts(F.regexp_extract(F.coalesce(url, F.lit("")), "[?]([^#]*)", 1), "&")
    keys = F.transform(pairs, lambda x: F.concat(F.lit("key="), F.substring_index(x, "=", 1)))
    values = F.transform(F.filter(pairs, lambda x: F.contains(x, F.lit("="))), lambda x: F.concat(F.lit("value="), x))
    return F.array_distinct(F.concat(labels, folders, names, endings, keys, values))


def mine_rules(transactions: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """(rule_id, tokens, verdict, confidence, support) from rows of ``items``.

    A rule is dropped when one with fewer of its tokens has the same verdict
    and at least its confidence (the shorter one fires whenever it does)."""
    model = FPGrowth(itemsCol="items", minSupport=min_support,
                     minConfidence=min_confidence).fit(transactions)
    mined = (model.associationRules
             .filter(F.startswith(F.col("consequent")[0], F.lit(VERDICT))
                     & ~F.exists("antecedent", lambda x: F.startswith(x, F.lit(VERDICT))))
             .select(F.array_sort("antecedent").alias("tokens"),
                     F.substring_index(F.col("consequent")[0], "=", -1).alias("verdict"),
                     "confidence", "support")
             .withColumn("rule_id", F.xxhash64("tokens", "verdict")))
    mined = stash(mined, "url-rules")
    a, b = mined.alias("a"), mined.alias("b")
    # a shorter rule shares its first token with every longer one it covers
    longer = a.withColumn("t", F.explode("a.tokens"))
    covered = (longer.join(b, (F.col("t") == F.col("b.tokens")[0])
                           & (F.col("a.verdict") == F.col("b.verdict"))
                           & (F.size("b.tokens") < F.size("a.tokens"))
                           & (F.col("b.confidence") >= F.col("a.confidence"))
                           & (F.size(F.array_except("b.tokens", "a.tokens")) == 0))
               .select(F.col("a.rule_id").alias("rule_id")).distinct())
    return stash(mined.join(covered, "rule_id", "left_anti"), "url-rules")


def _met(sets: DataFrame, mined: DataFrame) -> DataFrame:
    """(items, rule_id, verdict, confidence): the rules that fire on each token set.

    The inverted index holds every rule once, under the token that fewest sets
    have (ties: the first); a set looks up its tokens there and is held against
    the whole rule. A token most urls share finds the rules that have no other."""
    each = sets.select("items", F.explode("items").alias("token"))
    often = each.groupBy(F.col("token").alias("o_token")).agg(F.count(F.lit(1)).alias("sets"))
    keyed = (mined.select("rule_id", "tokens", F.explode("tokens").alias("t"))
             .join(often, F.col("t") == F.col("o_token"))  # a token no set has: the rule fires on none
             .groupBy("rule_id").agg(F.min_by("t", F.struct("sets", "t")).alias("key"),
                                     F.count(F.lit(1)).alias("found")))
    index = mined.join(keyed, "rule_id").filter(F.col("found") == F.size("tokens"))
    return (each.join(index, F.col("token") == F.col("key"))
            .filter(F.size(F.array_except("tokens", "items")) == 0)
            .select("items", "rule_id", "verdict", "confidence"))


def hold_back(mined: DataFrame, labelled: DataFrame, least_z: float, least_hosts: int) -> DataFrame:
    """``mined`` without the block rules that the labels' origin explains.

    ``labelled``: rows (items, verdict, scope, by). Longer rules that
    ``mine_rules`` dropped for a shorter one are no loss: they cover fewer of
    its urls, at no higher confidence."""
    block = (F.col("verdict") == "block").cast("int")
    rate = labelled.groupBy(F.col("scope").alias("s")).agg(F.avg(block).alias("q"))
    seen = (labelled.groupBy(F.array_sort("items").alias("set"), "scope", "by")
            .agg(F.count(F.lit(1)).alias("c"), F.sum(block).alias("blocks"))
            .join(rate, F.col("scope") == F.col("s")))
    fired = _met(seen.select(F.col("set").alias("items")).distinct(), mined.filter("verdict = 'block'"))
    sound = (seen.join(fired, F.col("set") == F.col("items")).groupBy("rule_id").agg(
        F.sum(F.col("blocks") - F.col("c") * F.col("q")).alias("over"),
        F.sum(F.col("c") * F.col("q") * (1 - F.col("q"))).alias("var"),
        F.count_distinct(F.when(F.col("blocks") > 0, F.col("by"))).alias("hosts"))
        .filter((F.col("over") >= least_z * F.sqrt(F.greatest("var", F.lit(1.0))))
                & (F.col("hosts") >= least_hosts)).select("rule_id"))
    allow = mined.filter("verdict = 'allow'")
    return stash(allow.unionByName(mined.join(sound, "rule_id", "left_semi")), "url-rules")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url", labels: DataFrame | None = None, min_support: float = 0.005,
          min_rows: int = 10, min_confidence: float = 0.9,
          least_z: float = 4.0) -> DataFrame:
    """Rows (id_col, host, path, rule, verdict, mined_confidence).

    ``labels``: rows (url, verdict) to learn from; by default the urls that a
    given rule judges, with its verdict. A rule needs ``min_support`` of the
    labelled urls and ``min_rows`` of them."""
    url = pages[url_col]
    host, path = split_url(url)
    base = pages.select(pages[id_col], url.alias("u"), host.alias("host"), path.alias("path"))
    base = base.withColumn("hit", given_rule(F.col("host"), F.col("path"), rules))
    base = stash(base.select(id_col, "host", "path", F.col("hit.rule").alias("rule"),
                             F.col("hit.verdict").alias("given"), F.col("hit.h").alias("by"),
                             scope(F.col("host"), rules).alias("scope"),
                             url_tokens(F.col("host"), F.col("path"), F.col("u")).alias("items")),
                 "urls")
    if labels is None:
        labelled = base.select("items", F.col("given").alias("verdict"), "scope", "by")
    else:
        h, p = split_url(labels["url"])
        t = url_tokens(h, p, labels["url"])
        labelled = labels.select(t.alias("items"), "verdict", scope(h, rules).alias("scope"),
                                 F.lit("labels").alias("by"))
    labelled = stash(labelled.filter((F.size("items") > 0) & F.col("verdict").isin("block", "allow")),
                     "url-labelled")
    n = labelled.count()
    if not n:
        return base.select(id_col, "host", "path", "rule", F.coalesce("given", F.lit("allow")).alias("verdict"),
                           F.lit(None).cast("double").alias("mined_confidence"))
    basket = labelled.select(
        F.concat("items", F.array(F.concat(F.lit(VERDICT), F.col("verdict")))).alias("items"))
    mined = mine_rules(basket, min(1.0, max(min_support, min_rows / n)), min_confidence)
    mined = hold_back(mined, labelled, least_z, 1 if labels is not None else 2)

    # Urls share few token sets: each set is matched once.
    open_sets = (base.filter(F.col("given").isNull()).select(F.array_sort("items").alias("items"))
                 .distinct())
    met = (_met(open_sets.select("items"), mined)
           .groupBy("items")
           .agg(F.max(F.when(F.col("verdict") == "block", F.col("confidence"))).alias("block"),
                F.max(F.when(F.col("verdict") == "allow", F.col("confidence"))).alias("allow"))
           .withColumnRenamed("items", "met_items"))
    out = base.join(met, F.col("given").isNull()
                    & (F.array_sort("items") == F.col("met_items")), "left")
    blocked = F.col("block").isNotNull() & (F.col("allow").isNull()
                                            | (F.col("block") > F.col("allow")))
    verdict = F.coalesce("given", F.when(blocked, "block").otherwise("allow"))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"),
                      F.when(F.col("given").isNull(), F.when(blocked, F.col("block"))
                             .otherwise(F.col("allow"))).alias("mined_confidence"))
