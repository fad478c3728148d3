"""URL filters: fixed host and path rules, then association rules mined with Spark's FP-growth.

The fixed rules fit a host with all its subdomains and a start of the path; the longest wins.
Where none fits, mined rules decide: the URL's tokens (labels of the host, parts of the path,
query keys) of labelled pages, with the label as one more token, go through FP-growth; rules whose
consequent is the bad label are kept if support and confidence reach their bounds and, among
rules with one antecedent containing another, only if confidence is higher than that of the
shorter one. An inverted index from the rarest token of each rule finds the pages to compare; a
page that has all tokens of a rule is blocked, others are allowed.

A page's label is that of the document whose id is the first number in the path; bad means low
quality or toxic. All labelled pages are mined, without sampling.

Null or malformed urls have empty host and path and no tokens: no rule fits, they are allowed.
Repeated pages are each judged; without labelled pages there are no mined rules; tables without
rows give none. Only the named columns are used.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.llm.tables import keep, query, table

#: (host, path, verdict), fixed by the query's contract.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
SUPPORT = 0.002
CONFIDENCE = 0.6
LEAST_PAGES = 20
#: Marks a bad label among tokens; tokens of urls start otherwise.
BAD = "label=bad"


def with_parts(pages: DataFrame) -> DataFrame:
    """Add host and path, both empty for a null url or one without `://`."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    lower = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumn("host", lower).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fixed_rule(rules=RULES) -> tuple:
    """Columns (rule, verdict) of the longest fixed rule that fits, null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, f"{host}{path}").otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def tokens() -> Column:
    """Distinct tokens of a url: host labels and their parts at hyphens, path parts and query keys; digits count as one sign."""
    labels = F.split("host", r"\.")
    words = F.flatten(F.transform(labels, lambda x: F.split(x, "-")))
    tag = lambda mark, part: F.transform(F.filter(part, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))
    query_keys = F.regexp_extract_all(F.coalesce(F.col("url"), F.lit("")), F.lit(r"[?&]([^=&#]*)"))
    path = F.split(F.regexp_replace("path", r"[0-9]+", "0"), "/")
    return F.array_distinct(F.concat(tag("host=", labels), tag("word=", words), tag("path=", path), tag("key=", query_keys)))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Token lists of pages whose document has a label; the bad ones also hold the bad token."""
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) as bigint)")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    return (pages.withColumn("_id", number)
            .join(labels.select(F.col("doc_id").alias("_id"), bad.alias("_bad")), "_id")
            .select(F.when(F.col("_bad"), F.array_append("_tokens", F.lit(BAD))).otherwise(F.col("_tokens")).alias("items")))


def mine(baskets: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST_PAGES) -> DataFrame:
    """(id, antecedent, confidence) of rules that end in the bad label, without those a shorter one makes needless."""
    n = baskets.count()
    spark = baskets.sparkSession
    empty = spark.createDataFrame([], "rule_id bigint, antecedent array<string>, confidence double, support double")
    if n == 0:
        return empty
    support = max(support, least / n)
    if support > 1:
        return empty
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = keep(model.associationRules.where(F.array_contains("consequent", BAD))
                 .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "rules")
    # a rule's shorter ones all contain its rarest token or lack it: compare through each token
    by_token = rules.withColumn("token", F.explode("antecedent"))
    a, b = by_token.alias("a"), by_token.alias("b")
    needless = (a.join(b, "token").where((F.size("b.antecedent") < F.size("a.antecedent"))
                                         & (F.size(F.array_except("b.antecedent", "a.antecedent")) == 0)
                                         & (F.col("b.confidence") >= F.col("a.confidence")))
                .select(F.col("a.antecedent").alias("antecedent")).distinct())
    return (rules.join(needless, "antecedent", "left_anti")
            .withColumn("rule_id", F.xxhash64(F.array_join("antecedent", "\x1f"))))


def matches(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, mined) of pages that have every token of a rule; mined is its text.

    A rule is looked up by its rarest token alone, so a frequent one such as a top-level domain
    carries pages only if a rule consists of nothing rarer.
    """
    postings = pages.select("page_id", "_tokens", F.explode("_tokens").alias("token"))
    needed = rules.select(F.explode("antecedent").alias("token")).distinct()
    counts = postings.join(needed, "token").groupBy("token").agg(F.count("*").alias("n"))
    keyed = (rules.withColumn("token", F.explode("antecedent")).join(counts, "token", "left")
             .groupBy("rule_id", "antecedent").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    found = postings.join(keyed, "token").where(F.size(F.array_except("antecedent", "_tokens")) == 0)
    return found.groupBy("page_id").agg(F.min(F.array_join("antecedent", " ")).alias("mined"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, **settings) -> DataFrame:
    """Per page host, path, rule, verdict, and mined: the mined rule that blocked it, if one did."""
    parts = keep(with_parts(pages.select("page_id", "url")).withColumn("_tokens", tokens()), "urls")
    mined = keep(mine(labelled(parts, labels), **settings), "mined")
    rule, verdict = fixed_rule(rules)
    rows = parts.withColumn("rule", rule).withColumn("_said", verdict)
    found = matches(rows.where("rule is null"), mined).withColumnRenamed("page_id", "_page")
    rows = rows.join(found, F.col("page_id").eqNullSafe(F.col("_page")) & F.col("rule").isNull(), "left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("_said", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
                       .alias("verdict"), "mined")


@query("op7_url_rules")
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
