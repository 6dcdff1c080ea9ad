"""URL filtering by association rules, in DataFrame functions and Spark's FP-growth only.

A URL becomes tokens of all its parts: scheme, top-level domain, domain, every further part of the host,
every segment of the path and each word of those that have several, extension, every query key, fragment.
Support by count prunes tokens before combinations are mined: a rule that blocks needs `min_count` blocked
URLs, so each of its tokens does. Tokens that stand in the same labelled URLs are one token, named after
the least of them, and any of them stands for it. FP-growth mines the combinations of what is left and the
class of labelled URLs; a rule says that a combination is blocked. Rules with too little support or
confidence are pruned, and so is a rule that says no more than a shorter one.

Rules match by an inverted index: a rule is filed under the rarest of its tokens, a URL looks up its
tokens, and the other tokens of the rules found are compared. Only tokens that rules name are looked up,
and URLs with the same ones once, so that a host that holds much of the table costs one look-up per kind
of URL.

Listed rules, such as `allow org/`, come before mined ones. A listed rule fits its host and all
subdomains if the path begins with the rule's; the longest that fits wins.

Defined results: a null URL, or one without `://`, has an empty host and path, fits no listed rule and
takes no part in mining; it is allowed. An id that is labelled several times is blocked if any label
says so; null ids and labels are ignored. Without labelled URLs, or without blocked ones, no rules are
mined and all URLs that no listed rule fits are allowed. Null and repeated page ids are carried along,
one row each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import pick
from hackney.session import stage

BLOCKED = "class:block"
NAMES = "token string, name string"
RULES = "antecedent array<string>, confidence double, lift double, support double"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first `://` up to `/`, `?`, `#` or the end, and then up to `?` or `#`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(
        F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase
    )
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Verdict and rule of the longest fitting (verdict, rule) as a struct; null if none fits."""
    choice = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        choice = F.when(fits, value) if choice is None else choice.when(fits, value)
    if choice is None:
        return F.lit(None).cast("struct<verdict:string,rule:string>")
    return choice


def url_tokens(url: Column) -> Column:
    """The distinct tokens of all parts of the URL, each named after its kind of part."""
    host, path = host_and_path(url)
    names = F.filter(F.split(host, r"\."), lambda p: p != "")
    size = F.size(names)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    depth = F.size(parts)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    extension = F.regexp_extract(path, r"\.([A-Za-z]{1,8})$", 1)
    stem = F.regexp_replace(path, r"\.[A-Za-z]{1,8}$", "")
    words = F.flatten(
        F.transform(
            F.transform(
                F.split(F.lower(stem), "/"),
                lambda p: F.filter(F.split(p, r"[^\p{L}\p{N}]+"), lambda w: w != ""),
            ),
            lambda some: F.when(F.size(some) > 1, some).otherwise(F.array().cast("array<string>")),
        )
    )

    def token(slot: str, value: Column, given: Column) -> Column:
        return F.when(given, F.concat(F.lit(f"{slot}:"), value))

    def each(slot: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(f"{slot}:"), v))

    single = [
        token("scheme", F.lower(F.substring_index(url, "://", 1)), F.locate("://", url) > 0),
        token("top", F.get(names, size - 1), size > 0),
        token("domain", F.concat_ws(".", F.slice(names, F.greatest(size - 1, F.lit(1)), 2)), size > 1),
        token("site", F.get(names, size - 3), size > 2),
        token("file", F.get(parts, depth - 1), depth > 0),
        token("ext", F.lower(extension), extension != ""),
        token("part", F.lit("fragment"), F.locate("#", url) > 0),
    ]
    several = [
        each("sub", F.slice(names, F.lit(1), F.greatest(size - 3, F.lit(0)))),
        each("dir", F.slice(parts, F.lit(1), F.greatest(depth - 1, F.lit(0)))),
        each("word", words),
        each("query", F.filter(keys, lambda k: k != "")),
    ]
    found = F.array_compact(F.concat(F.array(*single), *several))
    return F.when(url.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(found))


def frequent_tokens(examples: DataFrame, least: int) -> DataFrame:
    """`token, name` of the tokens of `example, blocked, tokens` with `least` blocked examples.

    Tokens of the same examples share the least one's name.
    """
    counts = (
        examples.select("example", "blocked", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(
            F.sum(F.col("blocked").cast("long")).alias("bad"),
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("example")).alias("sum"),
            F.bit_xor(F.xxhash64(F.lit(1), "example")).alias("other_sum"),
        )
        .where(F.col("bad") >= least)
    )
    alike = counts.groupBy("n", "sum", "other_sum").agg(
        F.min("token").alias("name"), F.collect_list("token").alias("tokens")
    )
    return alike.select(F.explode("tokens").alias("token"), "name")


def mine(
    pages: DataFrame,
    labels: DataFrame,
    min_support: float = 0.0,
    min_count: int = 10,
    min_confidence: float = 0.7,
    min_lift: float = 1.5,
) -> tuple[DataFrame, DataFrame]:
    """Rules as of `mine_rules`, and `token, name`: the tokens and the names that rules know them by."""
    marks = (
        labels.where(F.col("page_id").isNotNull() & F.col("blocked").isNotNull())
        .groupBy("page_id")
        .agg(F.max("blocked").alias("blocked"))
    )
    tokens = url_tokens(F.col("url"))
    examples = stage(
        pages.join(marks, "page_id")
        .select("blocked", tokens.alias("tokens"))
        .where(F.size("tokens") > 0)
        .withColumn("example", F.monotonically_increasing_id()),
        "examples",
    )
    size = examples.agg(
        F.count("*").alias("all"), F.sum(F.col("blocked").cast("long")).alias("bad")
    ).first()
    n = size["all"]
    spark = pages.sparkSession
    least = max(min_count, math.ceil(min_support * n))
    if (size["bad"] or 0) < least:
        return spark.createDataFrame([], RULES), spark.createDataFrame([], NAMES)
    names = stage(frequent_tokens(examples, least), "names")
    pruned = (
        examples.select("example", "blocked", F.explode("tokens").alias("token"))
        .join(names.where(F.col("token") == F.col("name")), "token")
        .groupBy("example")
        .agg(F.first("blocked").alias("blocked"), F.collect_list("token").alias("tokens"))
        .select(
            F.when(F.col("blocked"), F.concat("tokens", F.array(F.lit(BLOCKED))))
            .otherwise(F.col("tokens"))
            .alias("items")
        )
    )
    # Examples that lost all their tokens count for shares and lift as those with none.
    bare = n - pruned.count()
    others = spark.range(bare).select(F.array().cast("array<string>").alias("items"))
    found = (
        FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence)
        .fit(stage(pruned.union(others), "items"))
        .associationRules
    )
    rules = stage(
        found.where(
            (F.get("consequent", F.lit(0)) == BLOCKED) & (F.col("lift") >= min_lift)
        ).select("antecedent", "confidence", "lift", "support"),
        "rules",
    )
    return rules.join(_implied(rules), "antecedent", "left_anti"), names


def mine_rules(pages: DataFrame, labels: DataFrame, **mining: float) -> DataFrame:
    """Rules `antecedent, confidence, lift, support` that block, from `page_id, url` and
    `page_id, blocked`; a rule needs `min_count` of the labelled URLs and `min_support` of them."""
    return mine(pages, labels, **mining)[0]


def _implied(rules: DataFrame) -> DataFrame:
    """Rules with a part that is a rule of no less confidence."""
    shorter = rules.select(
        F.col("antecedent").alias("part"),
        F.col("confidence").alias("part_confidence"),
        F.get("antecedent", F.lit(0)).alias("token"),
    )
    longer = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    contained = (F.size("part") < F.size("antecedent")) & (
        F.size(F.array_except("part", "antecedent")) == 0
    )
    return (
        longer.join(shorter, "token")
        .where(contained & (F.col("part_confidence") >= F.col("confidence")))
        .select("antecedent")
        .distinct()
    )


def match_rules(kinds: DataFrame, rules: DataFrame) -> DataFrame:
    """The most confident fitting rule of each token list: `tokens`, `mined`.

    `kinds` has distinct `tokens` and the number `n` of URLs that have them.
    """
    counts = (
        kinds.select("n", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )
    index = (
        rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
        .join(counts, "token")
        .groupBy("antecedent", "confidence")
        .agg(F.min(F.struct("n", "token")).alias("rarest"))
        .select("antecedent", "confidence", F.col("rarest.token").alias("token"))
    )
    return (
        kinds.select("tokens", F.explode("tokens").alias("token"))
        .join(index, "token")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
        .groupBy("tokens")
        .agg(F.max(F.struct("confidence", "antecedent")).alias("mined"))
    )


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    listed: Sequence[tuple[str, str]] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    **mining: float,
) -> DataFrame:
    """`page_id, host, path, rule, verdict, mined` of every page.

    `labels` has `page_id` and `blocked`; `listed` holds (verdict, rule) pairs; `mining` goes to
    `mine_rules`. `mined` is the most confident mined rule that fits, null if none does.
    """
    rows = pick(pages, page_id=id_col, url=url_col)
    rules, names = mine(rows, labels, **mining)
    rules = stage(rules, "rules")
    named = rules.select(F.explode("antecedent").alias("name")).distinct()
    urls = rows.select("url").distinct().select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    tagged = stage(
        urls.join(names.join(named, "name"), "token")
        .groupBy("url")
        .agg(F.array_sort(F.collect_set("name")).alias("tokens")),
        "tagged",
    )
    kinds = stage(tagged.groupBy("tokens").agg(F.count("*").alias("n")), "kinds")
    mined = stage(tagged.join(match_rules(kinds, rules), "tokens").select("url", "mined"), "mined")
    host, path = host_and_path(F.col("url"))
    return (
        rows.select("page_id", "url", host.alias("host"), path.alias("path"))
        .join(mined, "url", "left")
        .withColumn("first", listed_rule(F.col("host"), F.col("path"), listed))
        .select(
            "page_id",
            "host",
            "path",
            F.col("first.rule").alias("rule"),
            F.when(F.col("first").isNotNull(), F.col("first.verdict"))
            .when(F.col("mined").isNotNull(), "block")
            .otherwise("allow")
            .alias("verdict"),
            "mined",
        )
    )
