"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the rest.

URLs that a rule decides are the labelled ones; the trees learn from them and judge the others.
DataFrame functions and Spark ML only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import pick, written

#: (host and path, verdict) of the production query.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
#: The trees learn from about so many labelled URLs, drawn by hash of the URL and row id: up to half of each label.
TRAIN_ROWS = 20_000
#: Pseudo-count of a suffix's block rate.
PRIOR = 20.0
FEATURES = ["f_length", "f_host", "f_path", "f_depth", "f_labels", "f_digits", "f_hyphens", "f_entropy",
            "f_params", "f_query", "f_tld_rate", "f_tld_seen", "f_site_rate", "f_site_seen"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased; path: then up to ? # or
    the end.  Both empty for null and for URLs without ://."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, low).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def longest_rule(rules) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits `host` and `path`, or null.  Of
    rules of one length the later in text order wins."""
    def fits(r):
        at = r.index("/")
        host, path = r[:at], r[at:]
        return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)

    found = [F.when(fits(r), F.struct(F.lit(len(r)).alias("size"), F.lit(r).alias("rule"), F.lit(v).alias("verdict")))
             for r, v in rules]
    return F.array_max(F.array(*found)) if found else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def with_features(rows: DataFrame) -> DataFrame:
    """rows (url, host, path) and the lexical features that need no other row, and both suffixes."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    chars = F.array_remove(F.array_distinct(F.split(url, "")), "")
    counts = F.transform(chars, lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))).cast("double"))
    bits = F.aggregate(counts, F.lit(0.0), lambda a, c: a - c / n * F.log2(c / n))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    return rows.withColumns({
        "f_length": n, "f_host": F.length("host").cast("double"), "f_path": F.length("path").cast("double"),
        "f_depth": (F.length("path") - F.length(F.regexp_replace("path", "/", ""))).cast("double"),
        "f_labels": F.size(labels).cast("double"),
        "f_digits": F.length(F.regexp_replace(url, "[^0-9]+", "")) / n,
        "f_hyphens": (F.length("host") - F.length(F.regexp_replace("host", "-", ""))).cast("double"),
        "f_entropy": bits, "f_query": F.length(query).cast("double"),
        "f_params": F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"),
        "tld": F.element_at(labels, -1),
        "site": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2))),
    })


def _suffix_statistics(train: DataFrame, key: str) -> DataFrame:
    """Of each suffix: its smoothed block rate among labelled URLs and the log of how many there are."""
    return train.groupBy(key).agg(
        ((F.sum("label") + PRIOR / 2) / (F.count(F.lit(1)) + PRIOR)).alias(f"f_{key}_rate"),
        F.log1p(F.count(F.lit(1)).cast("double")).alias(f"f_{key}_seen"))


def _with_suffixes(rows: DataFrame, stats: dict[str, DataFrame]) -> DataFrame:
    rows = reduce(lambda r, k: r.join(stats[k], k, "left"), stats, rows)
    return rows.fillna({f"f_{k}_rate": 0.5 for k in stats} | {f"f_{k}_seen": 0.0 for k in stats})


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS, trees: int = 10, depth: int = 4,
        seed: int = 7) -> tuple[dict[str, DataFrame], GBTClassificationModel | str]:
    """Suffix statistics and the trees, from rows (page_id, url, host, path, rule verdict `said`,
    features) that have a verdict.  With labels of one kind only, that verdict in place of trees;
    without labels 'allow'."""
    labelled = rows.where("said is not null").withColumn("label", (F.col("said") == "block").cast("double"))
    stats = {k: written(_suffix_statistics(labelled, k), f"url-{k}") for k in ("tld", "site")}
    n, blocked = labelled.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or blocked in (0, n):
        return stats, "block" if n and blocked == n else "allow"
    below = [int(min(1.0, train_rows / 2 / k) * (1 << 20)) + 1 for k in (n - blocked, blocked)]
    drawn = labelled.where(F.pmod(F.xxhash64("url", "page_id"), F.lit(1 << 20))
                           < F.when(F.col("label") == 1, below[1]).otherwise(below[0]))
    train = _assembler().transform(_with_suffixes(drawn, stats)).select("features", "label")
    train = written(train.repartition(4), "url-train")
    if train.select("label").distinct().count() < 2:
        return stats, "block" if 2 * blocked > n else "allow"
    gbt = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, checkpointInterval=-1,
                        cacheNodeIds=False)
    return stats, gbt.fit(train)


def judge_urls(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score per row of pages.

    The longest fitting rule decides; else the trees, `block` above a probability of one half
    (block_score, null where a rule decided or there are no trees).  The trees learn from about
    `train_rows` / 2 URLs of each label, all if fewer, so a rare label is learnt too; block_score
    is a probability by the shares of that sample.  Null URLs and URLs without
    :// have an empty host and path, fit no rule and are judged by their features.  Repeated
    rows are judged alike; an empty table gives no rows.  Rules are a short parameter list; a
    rule must have a '/'.
    """
    if bad := [r for r, v in rules if "/" not in r or v not in ("allow", "block")]:
        raise ValueError(f"not rules: {bad}")
    host, path = host_and_path(F.col("url"))
    rows = pick(pages, "page_id", "url").withColumns({"host": host, "path": path})
    rows = rows.withColumn("best", longest_rule(rules))
    rows = with_features(rows.withColumns({"rule": F.col("best.rule"), "said": F.col("best.verdict")}).drop("best"))
    rows = written(rows, "url-features")
    stats, model = fit(rows, train_rows)
    if isinstance(model, str):
        return rows.select("page_id", "host", "path", "rule", F.coalesce("said", F.lit(model)).alias("verdict"),
                           F.lit(None).cast("double").alias("block_score"))
    from pyspark.ml.functions import vector_to_array

    rest = _assembler().transform(_with_suffixes(rows.where("said is null"), stats))
    scored = model.transform(rest).withColumn("block_score", F.get(vector_to_array("probability"), F.lit(1)))
    judged = scored.select("page_id", "host", "path", "rule",
                           F.when(F.col("block_score") > 0.5, "block").otherwise("allow").alias("verdict"), "block_score")
    ruled = rows.where("said is not null").select("page_id", "host", "path", "rule", F.col("said").alias("verdict"),
                                                  F.lit(None).cast("double").alias("block_score"))
    return ruled.union(judged)
