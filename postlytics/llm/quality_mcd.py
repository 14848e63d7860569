"""Quality rules: robust multivariate outliers by minimum covariance determinant (MCD).

Per language and source a centre and covariance of transformed text statistics are estimated
from the tightest share of documents: from several deterministic starts, concentration steps keep
the documents of smallest Mahalanobis distance and estimate again, and the start that ends at the
smallest determinant is taken.  Small groups are drawn towards their language, small languages
towards the whole table, the more the fewer documents they have.  Documents far from the centre of
their group are rejected.  DataFrame functions only; one pass over the texts, then small
aggregates over narrow rows; quantiles come from exact counts per bin, added up by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlytics.llm.common import numbered, pick, restored, written

SPACE = r"[\x20\x09-\x0D]+"
#: Base rule: fewest words, and most of 100 words that may lie in repeated 3-word windows.
MIN_WORDS, MAX_REPEAT = 50, 50
#: Share of a group that a concentration step keeps, number of steps, and the robust distance
#: (in standard deviations of the tight share, over all statistics) that rejects.
SHARE, STEPS, CUTOFF = 0.75, 3, 9.0
#: A group of this many documents counts as much as its language (a language: as the whole table).
PRIOR = 100
#: Bins of log(1 + x) to a unit: quantiles are exact up to the width of a bin, 0.1% of 1 + x.
BINS = 1024
#: The statistics and the least standard deviation each is given (a statistic may be constant).
FLOORS = {"v_words": 0.25, "v_length": 0.25, "v_symbols": 0.05, "v_lines": 0.20, "v_repeat": 0.05}
#: Median of the chi-square distribution with five degrees of freedom.
CHI2_MEDIAN = 4.351460191096

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_statistics(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint) and
    base_failed.  Null, empty and blank texts have none of anything and fail."""
    t = F.coalesce("text", F.lit(""))
    d = docs.withColumns({
        "w": F.array_remove(F.split(t, SPACE), ""),
        "lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
    })
    w = F.col("w")
    d = d.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "grams": F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
                                lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2))),
    })
    g = F.col("grams")
    d = d.withColumn("sorted", F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))))
    s = F.col("sorted")
    again = F.filter(s, lambda x, k: F.coalesce(x["g"] == F.get(s, k - 1)["g"], F.lit(False))
                     | F.coalesce(x["g"] == F.get(s, k + 1)["g"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    d = d.withColumn("n_repeat_words", F.when(s.isNotNull(), F.size(covered)).otherwise(0).cast("long"))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
    return d.withColumn("base_failed", failed).drop("w", "lines", "grams", "sorted")


def vector() -> dict[str, Column]:
    """The transformed statistics of a document: log length, mean word length, root of symbols a
    word, root of duplicate lines for each 20 words, share of repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "v_words": F.log1p(F.col("n_words").cast("double")),
        "v_length": F.col("word_chars") / n,
        "v_symbols": F.sqrt(F.col("n_symbols") / n),
        "v_lines": F.sqrt(20 * F.col("n_dup_lines") / n),
        "v_repeat": F.col("n_repeat_words") / n,
    }


def _pairs() -> list[tuple[str, str]]:
    names = list(FLOORS)
    return [(names[i], names[j]) for i in range(len(names)) for j in range(i + 1)]


def _with_roots(rows: DataFrame, cov: dict[tuple[str, str], Column]) -> DataFrame:
    """rows and columns l_a_b of the lower triangular root of a covariance, one row of it at a
    time; pivots are kept above zero."""
    names = list(FLOORS)
    for i, a in enumerate(names):
        for j, b in enumerate(names[:i + 1]):
            rest = reduce(lambda x, k: x - F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}"), names[:j], cov[a, b])
            rows = rows.withColumn(f"l_{a}_{b}", F.sqrt(F.greatest(rest, F.lit(FLOORS[a] ** 2 / 100))) if a == b
                                   else rest / F.col(f"l_{b}_{b}"))
    return rows


ROOTS = [f"l_{a}_{b}" for a, b in _pairs()]


def _with_distance(rows: DataFrame) -> DataFrame:
    """rows and d2, the squared Mahalanobis distance of the v_ columns by the m_ and l_ columns."""
    z: list[str] = []
    for a in FLOORS:
        rest = reduce(lambda x, b: x - F.col(f"l_{a}_{b}") * F.col(f"z_{b}"), z, F.col(a) - F.col(f"m_{a}"))
        rows = rows.withColumn(f"z_{a}", rest / F.col(f"l_{a}_{a}"))
        z.append(a)
    total = reduce(lambda x, y: x + y, (F.col(f"z_{a}") * F.col(f"z_{a}") for a in FLOORS))
    return rows.withColumn("d2", total).drop(*[f"z_{a}" for a in FLOORS])


def _part(c: str) -> Column:
    return F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.lit("="), F.col(c).cast("string")))


def _group_key(*names: str) -> Column:
    """The named columns as one string; null is a value of its own."""
    return F.to_json(F.array(*[_part(c) for c in names]))


ALL = "*"
#: Estimates are broadcast up to so many rows, of some 300 bytes each; beyond, their join shuffles.
SMALL = 20_000


def _small(groups: DataFrame) -> DataFrame:
    """A few rows per group, with a broadcast hint if they are counted to be few."""
    return F.broadcast(groups) if groups.limit(SMALL + 1).count() <= SMALL else groups


def _bin(x: Column) -> Column:
    return F.floor(F.log1p(x) * BINS)


def _middle(bin_: Column) -> Column:
    return F.expm1((bin_ + 0.5) / BINS)


def _quantiles(rows: DataFrame, keys: list[str], **shares: float) -> DataFrame:
    """keys, total and for each name the bin where the count from below reaches that share.

    Rows are counted per key and bin before anything meets; a key has at most as many bins as log(1 + x)
    of a double has (under a million), and in practice some thousands.
    """
    one = Window.partitionBy(*keys)
    upto = one.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (rows.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
              .select(*keys, "bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(one).alias("total")))
    return counts.groupBy(*keys).agg(F.max("total").alias("total"), *[
        F.min(F.when(F.col("upto") >= F.col("total") * F.lit(p), F.col("bin"))).alias(name) for name, p in shares.items()])


MEANS = [f"m_{a}" for a in FLOORS]
COVS = [f"c_{a}_{b}" for a, b in _pairs()]


def _covariance() -> dict[tuple[str, str], Column]:
    return {(a, b): F.col(f"c_{a}_{b}") for a, b in _pairs()}


def _starts(v: DataFrame) -> DataFrame:
    """grp, start, m_*, c_*: medians, and three first covariances of rows scaled by quartiles:
    (0) the scales alone, (1) correlations of the rows' hyperbolic tangents, (2) of their signs,
    that is of their directions from the median."""
    stat = F.explode(F.array(*[F.struct(F.lit(a).alias("stat"), _bin(F.col(a)).alias("bin")) for a in FLOORS]))
    quart = _quantiles(v.select("grp", stat.alias("s")).select("grp", "s.*"), ["grp", "stat"], low=0.25, mid=0.5, high=0.75)

    def of(a, value):
        return F.max(F.when(F.col("stat") == a, value))

    wide = quart.groupBy("grp").agg(
        *[of(a, _middle(F.col("mid"))).alias(f"m_{a}") for a in FLOORS],
        *[of(a, F.sqrt(F.pow((_middle(F.col("high")) - _middle(F.col("low"))) / 1.349, 2) + FLOORS[a] ** 2)).alias(f"s_{a}")
          for a in FLOORS])
    wide = _small(written(wide, "mcd-quartiles"))
    z = v.join(wide, "grp").withColumns({f"z_{a}": (F.col(a) - F.col(f"m_{a}")) / F.col(f"s_{a}") for a in FLOORS})
    z = z.withColumns({f"t_{a}": F.tanh(f"z_{a}") for a in FLOORS})
    z = z.withColumn("norm", F.sqrt(reduce(lambda x, y: x + y, (F.col(f"z_{a}") * F.col(f"z_{a}") for a in FLOORS))))
    z = z.withColumns({f"u_{a}": F.when(F.col("norm") > 0, F.col(f"z_{a}") / F.col("norm")).otherwise(0.0) for a in FLOORS})
    sums = z.groupBy("grp").agg(*[F.covar_pop(f"t_{a}", f"t_{b}").alias(f"t_{a}_{b}") for a, b in _pairs()],
                                *[F.avg(F.col(f"u_{a}") * F.col(f"u_{b}")).alias(f"u_{a}_{b}") for a, b in _pairs()])
    rows = written(sums, "mcd-starts").join(wide, "grp")

    def tanh(a, b):
        spread = F.sqrt(F.col(f"t_{a}_{a}") * F.col(f"t_{b}_{b}"))
        return F.when(spread > 0, F.col(f"t_{a}_{b}") / spread).otherwise(0.0)

    def start(k, correlation):
        c = {(a, b): F.col(f"s_{a}") * F.col(f"s_{b}") * correlation(a, b) for a, b in _pairs()}
        return rows.select("grp", F.lit(k).alias("start"), *MEANS, *[x.alias(f"c_{a}_{b}") for (a, b), x in c.items()])

    return (start(0, lambda a, b: F.lit(1.0 if a == b else 0.0))
            .union(start(1, lambda a, b: F.lit(1.0) if a == b else tanh(a, b)))
            .union(start(2, lambda a, b: len(FLOORS) * F.col(f"u_{a}_{b}"))))


def _towards(own: DataFrame, above: DataFrame) -> DataFrame:
    """own with each estimate mixed with that of the row of `above` named in up: the weight of own is
    n^2 / (n^2 + PRIOR^2), so it grows without a jump and few documents hardly bend a centre."""
    names = [*MEANS, *COVS, "scale"]
    far = above.select(F.col("grp").alias("up"), *[F.col(c).alias(f"up_{c}") for c in names])
    n = F.col("n_docs").cast("double")
    w = n * n / (n * n + float(PRIOR ** 2))
    return own.join(far, "up").select("grp", "up", "n_docs", *[
        (w * F.col(c) + (1 - w) * F.col(f"up_{c}")).alias(c) for c in names])


def fit(stats: DataFrame) -> DataFrame:
    """Estimates per language and source: grp, n_docs, m_*, l_*, scale.

    `stats` has lang, source, base_failed and the statistics, one narrow row per document; rows
    that fail the base rule are left out.  Each document counts in its group, its language and the
    whole table.  Every step writes at most a few rows per group.
    """
    lang, group = _group_key("lang"), _group_key("lang", "source")
    levels = F.explode(F.array(*[F.struct(g.alias("grp"), up.alias("up")) for g, up in (
        (group, lang), (lang, F.lit(ALL)), (F.lit(ALL), F.lit(None).cast("string")))]))
    v = written(stats.where("not base_failed").withColumns(vector()).select(levels.alias("g"), *FLOORS)
                .select("g.*", *FLOORS), "mcd-vectors")
    v, ups = v.drop("up"), v.groupBy("grp").agg(F.max("up").alias("up"), F.count(F.lit(1)).alias("n_docs"))
    params = _starts(v)
    for _ in range(STEPS):
        roots = _with_roots(params, _covariance()).select("grp", "start", *MEANS, *ROOTS)
        roots = _small(written(roots, "mcd-estimates"))
        d = _with_distance(v.join(roots, "grp")).withColumn("bin", _bin(F.col("d2")))
        near = _small(written(_quantiles(d, ["grp", "start"], most=SHARE).select("grp", "start", "most"), "mcd-share"))
        sums = d.join(near, ["grp", "start"]).where("bin <= most").groupBy("grp", "start").agg(
            *[F.avg(a).alias(f"m_{a}") for a in FLOORS],
            *[(F.covar_pop(a, b) + (FLOORS[a] ** 2 if a == b else 0.0)).alias(f"c_{a}_{b}") for a, b in _pairs()])
        params = written(sums, "mcd-sums")
    size = reduce(lambda x, y: x + y, (F.log(f"l_{a}_{a}") for a in FLOORS))
    ends = _with_roots(params, _covariance()).withColumn("size", size)
    best = ends.groupBy("grp").agg(F.min_by(F.struct(*MEANS, *COVS, *ROOTS), F.struct("size", "start")).alias("e"))
    best = _small(written(best.select("grp", "e.*"), "mcd-best"))
    d = _with_distance(v.join(best.drop(*COVS), "grp")).withColumn("bin", _bin(F.col("d2")))
    scale = _quantiles(d, ["grp"], mid=0.5).select(
        "grp", F.greatest(_middle(F.col("mid")) / CHI2_MEDIAN, F.lit(1.0)).alias("scale"))
    own = written(best.drop(*ROOTS).join(ups, "grp").join(scale, "grp"), "mcd-own")
    langs = _towards(own.where(F.col("up") == ALL), own.where(F.col("grp") == ALL))
    groups = _towards(own.where(F.col("up") != ALL), langs)
    return written(_with_roots(groups, _covariance()).select("grp", "n_docs", *MEANS, *ROOTS, "scale"), "mcd-estimates")


def judge(rows: DataFrame, params: DataFrame) -> DataFrame:
    """rows (with lang, source, the statistics) and `kept`, `mcd_distance` (null where the base
    rule failed or the group has no estimates; then kept is false, or true)."""
    cols = rows.columns
    use = (rows.withColumns(vector()).withColumn("grp", _group_key("lang", "source"))
           .join(_small(params), "grp", "left"))
    failed = F.col("base_failed")
    use = _with_distance(use).withColumn("mcd_distance", F.when(~failed, F.sqrt(F.col("d2") / F.col("scale"))))
    return use.select(
        *[F.col(f"`{c}`") for c in cols], "mcd_distance",
        (~failed & (F.coalesce(F.col("mcd_distance"), F.lit(0.0)) <= CUTOFF)).alias("kept"))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the five statistics, base_failed, mcd_distance, kept per row of docs.

    Null, empty and blank texts fail the base rule; null lang or source is a group of its own;
    repeated rows are judged alike and each counts; an empty table gives no rows.
    """
    base = with_statistics(pick(docs, "doc_id", "text", "lang", "source")).drop("text")
    base = written(base, "quality-statistics")
    return judge(base, fit(base)).select("doc_id", *STATS, "base_failed", "mcd_distance", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that quality() keeps.

    Rows with null, empty or blank text go, whatever their other columns hold; of repeated rows
    all stay or go; a null language or source is one like others; other columns may have any name.
    An empty table gives no rows.

    Rows are written once with their statistics: estimates read the narrow columns, the verdict
    is taken as the rows are read again, and texts are shuffled only if the estimates of very
    many groups are too large to broadcast.
    """
    own, at = numbered(docs, "text", "lang", "source")
    rows = own.select("*", *[F.col(c).alias(n) for n, c in at.items()])
    rows = written(with_statistics(rows).drop("text"), "quality-rows")
    # the row number keeps the optimizer from copying the whole verdict into a filter on the scan
    good = judge(rows, fit(rows)).withColumn("__row", F.monotonically_increasing_id()).where("kept and __row >= 0")
    return restored(good, docs)
