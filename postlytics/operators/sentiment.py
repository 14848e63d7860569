"""Sentiment scorers, all with one contract: add `sentiment_label` and `sentiment_score`.

label is one of Negative / Neutral / Positive; score is the winner's confidence
in [0, 1].  Three ways:

* `score_lexicon`  - word weights.  A bounded dict becomes a map literal and the
  score is a per-row higher-order expression (no explode, no shuffle).  A weight
  *table* of any size goes through explode -> join -> partial aggregation.
* `fit_naive_bayes` / `score_naive_bayes` - weights learned by aggregation from
  labelled documents (multinomial, Laplace smoothing), scored by join.
  `add_naive_bayes` keeps its counts as a table to which new labelled documents add.
* `score_model` - a plug-in model in an iterator pandas UDF, loaded once per
  Python worker, evaluated once per row (one struct column).
* `fit_model` / `score_fitted` - a logistic regression fitted by Spark ML, its weights as arrays
  in an iterator UDF that gets numbers only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from postlytics import config as C
from postlytics.functions.text import letter_runs, tokens
from postlytics import sinks
from postlytics.session import ensure_checkpoint_dir

SENTIMENT_TYPE = StructType([
    StructField("label", StringType(), True),
    StructField("score", DoubleType(), True),
])


def _label_of_sum(s: Column) -> Column:
    return (F.when(s > 0, F.lit(C.LABEL_POSITIVE))
            .when(s < 0, F.lit(C.LABEL_NEGATIVE))
            .otherwise(F.lit(C.LABEL_NEUTRAL)))


def _lexicon_score(s: Column, weight: Column) -> Column:
    """`weight` is the sum of the hits' absolute weights, so the score stays within [0, 1]."""
    return F.round((F.lit(1.0) + F.abs(s)) / (F.lit(1.0) + weight), 6)


def _hits_pattern(words: list[str]) -> str:
    # the look at the first letter comes first: it fails fast where no word of the lexicon begins
    first = "".join(sorted({c for w in words for c in (w[0], w[0].upper())}))
    return f"(?=[{first}])(?<![A-Za-z])(?i:" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")(?![A-Za-z])"


def score_lexicon(df: DataFrame, lexicon: dict[str, float] | DataFrame | None = None,
                  text_col: str = "cleaned_tweet_text", key: str = "tweet_id") -> DataFrame:
    """Sum of word weights s and of their absolute values w: label by the sign of s,
    score = round((1 + |s|) / (1 + w), 6).  Null text gives null label and score.

    Tokens are the maximal runs of ASCII letters, lower-cased.  A dict lexicon is
    scored per row without explode or shuffle: one regex pass extracts the runs
    that equal a lexicon word (ASCII-only case folding, runs bounded by
    non-letters), and only those few hits are looked up in a map literal.  A
    weight *table* of any size goes through explode -> join -> partial
    aggregation -> join back.
    """
    lexicon = C.FIXTURE_LEXICON if lexicon is None else lexicon
    text = F.col(text_col)
    if isinstance(lexicon, dict):
        # only lower-case ASCII words can ever equal a token
        usable = {w: float(v) for w, v in lexicon.items() if w.isascii() and w.isalpha() and w.islower()}
        if not usable:
            out = df.withColumns({"_s": F.lit(0.0), "_h": F.lit(0.0)})
        else:
            # staged columns: the regex runs once, and each hit is looked up once for both sums
            weights = F.create_map(*[x for k, v in usable.items() for x in (F.lit(k), F.lit(v))])
            hits = F.regexp_extract_all(text, F.lit(_hits_pattern(list(usable))), F.lit(0))
            out = df.withColumn("_hits", F.transform(hits, lambda t: F.try_element_at(weights, F.lower(t)))).withColumns({
                "_s": F.aggregate("_hits", F.lit(0.0), lambda acc, w: acc + w),
                "_h": F.aggregate("_hits", F.lit(0.0), lambda acc, w: acc + F.abs(w)),
            })
        return out.withColumns({
            "sentiment_label": F.when(text.isNotNull(), _label_of_sum(F.col("_s"))),
            "sentiment_score": F.when(text.isNotNull(), _lexicon_score(F.col("_s"), F.col("_h"))),
        }).drop("_hits", "_s", "_h")
    # weight table (token, weight) of unknown size: explode -> join -> aggregate -> join back,
    # all on one hash partitioning by key (see score_naive_bayes)
    table = lexicon.select("token", F.col("weight").cast("double"))   # AQE broadcasts it if it measures small
    out = _text_sums(df, key, text_col, table, {"_s": F.sum(F.col("n") * F.col("weight")), "_h": F.sum(F.col("n") * F.abs("weight"))})
    s, h = F.coalesce(F.col("_s"), F.lit(0.0)), F.coalesce(F.col("_h"), F.lit(0.0))
    return out.withColumns({
        "sentiment_label": F.when(text.isNotNull(), _label_of_sum(s)),
        "sentiment_score": F.when(text.isNotNull(), _lexicon_score(s, h)),
    }).drop("_s", "_h")


# ---------------------------------------------------------------- naive Bayes


def _text_sums(df: DataFrame, key: str, text_col: str, weights: DataFrame, sums: dict[str, Column],
               rank: Column | None = None) -> DataFrame:
    """Attach sums over the known tokens of each row's text (column `n`: how often a token occurs).

    Texts stay where they are: a vocabulary of up to C.BROADCAST_ROWS tokens goes to them, tokens are
    looked up as they are cut, and one row of sums a text is shuffled.  Of a larger vocabulary that
    many tokens go to the texts, those of highest `rank` (the frequent ones; without it, the shorter
    ones); the tokens not found there, few in a text, are shuffled to the rest of the vocabulary, each
    with the digest of its text.  The rank decides where a token is looked up, never its weight.  The
    vocabulary is stored first, so its size is known.  A stream takes `_text_sums_by_shuffle`.
    """
    weights, _ = sinks.staged(weights.withColumn("_rank", -F.length("token") if rank is None else rank), "vocabulary")
    size, most = weights.count(), C.BROADCAST_ROWS
    if df.isStreaming:
        return _text_sums_by_shuffle(df, key, text_col, weights, sums)
    # the empty token counts the copies of a text and is never looked up
    known, rest = weights.where("token != ''"), None
    if size > most:
        least = known.agg(F.percentile_approx("_rank", 1 - most / size, 10_000)).first()[0]
        # a token that comes twice is looked up in one place
        above = F.coalesce(F.max("_rank").over(Window.partitionBy("token")) > least, F.lit(False))
        known = known.withColumn("_above", above)
        known, rest = known.where("_above"), known.where("not _above")
    rows = _keyed(df, key, text_col)
    runs = F.concat(F.array(F.lit("")), letter_runs(F.col(text_col)))
    toks = (rows.where(F.col(text_col).isNotNull()).select("_key", "_doc", F.explode(runs).alias("t"))
            .select("_key", "_doc", F.lower("t").alias("token")))
    known = F.broadcast(known)
    found = toks.join(known, "token", "left")
    if rest is not None:
        rare = toks.where("token != ''").join(known.select("token"), "token", "left_anti")
        found = found.unionByName(rare.join(rest.hint("merge"), "token"))
    per_text = found.withColumn("n", F.lit(1)).groupBy("_key", "_doc").agg(
        F.sum(F.when(F.col("token") == "", 1).otherwise(0)).alias("_copies"), *[c.alias(n) for n, c in sums.items()])
    per_text = per_text.select("_key", "_doc", *[(F.col(n) / F.col("_copies")).alias(n) for n in sums])
    # dealt by key and digest; a text moves with its row only if the caller goes on to use it
    return rows.repartition("_key", "_doc").join(per_text, ["_key", "_doc"], "left").drop("_key", "_doc")


def _keyed(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """Rows with `_key` and `_doc`, the first 128 bits of the digest of their text; those without a text
    are dealt to any task."""
    anywhere = F.concat(F.lit("-"), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)).cast("string"))
    digest = F.substring(F.unhex(F.sha2(F.col(text_col), 256)), 1, 16)
    return df.withColumns({"_key": F.coalesce(F.col(key).cast("string"), F.lit("")),
                           "_doc": F.coalesce(digest, F.encode(anywhere, "UTF-8"))})


def _text_sums_by_shuffle(df: DataFrame, key: str, text_col: str, weights: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Attach sums over the known tokens of each row's text, shuffling the rows once.

    Sums are taken once per distinct (key, text), so copies of a post (overlapping pulls) each
    get the sums of one copy, and rows without a key are scored like any other.  Rows are
    hash-partitioned by (key, text digest) once: the join-back needs no further shuffle of them.
    The token branch reads key and text alone, and counts the tokens of a text where it lies: the
    vocabulary join gets one row per distinct token of a text (`n` of it), not one per occurrence.
    Rows without a text have no token to look up, so they are dealt to any task.
    """
    rows = _keyed(df, key, text_col).repartition("_key", "_doc")
    once = rows.where(F.col(text_col).isNotNull()).select("_key", "_doc", text_col).dropDuplicates(["_key", "_doc"])
    toks = (once.select("_key", "_doc", F.explode(letter_runs(F.col(text_col))).alias("t"))
            .groupBy("_key", "_doc", F.lower("t").alias("token")).agg(F.count(F.lit(1)).alias("n")))
    per_text = toks.join(weights, "token").groupBy("_key", "_doc").agg(*[c.alias(n) for n, c in sums.items()])
    return rows.join(per_text, ["_key", "_doc"], "left").drop("_key", "_doc")


def fit_naive_bayes(docs: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """Learn per-token log weights for the three classes by aggregation.

    weight(t, c) = ln((n(t, c) + 1) / (n(c) + V)), V = distinct tokens, n(c) = tokens
    in class c.  Returns one row per token: token, w_negative, w_neutral, w_positive.
    The token counts are checkpointed once (shared checkpoint folder), so the
    vocabulary size and class totals are cheap scalars over the stored table.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    return _weights(_token_counts(docs, text_col, label_col).checkpoint(eager=True))


def _by_class(one: Column, label: str = "label") -> list[Column]:
    return [F.sum(F.when(F.col(label) == lab, one).otherwise(0)).alias(f"n_{lab.lower()}") for lab in C.LABELS]


def _token_counts(docs: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """token and its occurrences in each class; repeated (token, class) pairs collapse map-side."""
    toks = (docs.select(F.col(label_col).alias("label"), F.explode(letter_runs(F.col(text_col))).alias("t"))
            .select("label", F.lower("t").alias("token")))
    return toks.groupBy("token").agg(*_by_class(F.lit(1)))


def _weights(counts: DataFrame) -> DataFrame:
    lows = [lab.lower() for lab in C.LABELS]
    totals = counts.select(F.struct(F.count(F.lit(1)).alias("vocab"),
                                    *[F.sum(f"n_{low}").alias(low) for low in lows])).scalar()   # one row
    return counts.select("token", *[
        F.ln((F.col(f"n_{low}") + 1) / (totals.getField(low) + totals.getField("vocab"))).alias(f"w_{low}")
        for low in lows])


def naive_bayes_counts(docs: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """Everything the model is made of, as counts that add up: a row per token, and one row without
    a token that counts the documents (n_all counts all of them, also those without a known label)."""
    tokens = _token_counts(docs, text_col, label_col).withColumn("n_all", F.lit(None).cast("long"))
    whole = docs.groupBy().agg(*_by_class(F.lit(1), label_col), F.count(F.lit(1)).alias("n_all"))
    return tokens.unionByName(whole.withColumn("token", F.lit(None).cast("string")))


def add_naive_bayes(docs: DataFrame, path: str, batch_id: int, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """Add newly labelled documents to the counts stored at `path`; returns the stored counts.

    `batch_id` rises from batch to batch and lies in the rows themselves: a batch that is in the
    counts already is not added again.  The table is replaced as a whole, safely against a crash.
    """
    spark = docs.sparkSession
    names = [f"n_{lab.lower()}" for lab in C.LABELS] + ["n_all"]
    schema = "token string, " + ", ".join(f"{n} long" for n in names) + ", upto long"
    old = sinks.read_state(spark, path, schema)
    last = old.agg(F.max("upto")).first()[0]
    if last is None or last < batch_id:
        both = old.drop("upto").unionByName(naive_bayes_counts(docs, text_col, label_col))
        merged = both.groupBy("token").agg(*[F.sum(n).alias(n) for n in names])
        sinks.overwrite_state(merged.withColumn("upto", F.lit(batch_id).cast("long")), path)
    return sinks.read_state(spark, path, schema)


def naive_bayes_of_counts(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(weights, priors) of counts, equal to a fit on all their documents at once."""
    lows = [lab.lower() for lab in C.LABELS]
    tokens = counts.where("token is not null").select("token", *[f"n_{low}" for low in lows])
    priors = counts.where("token is null").select(*[F.ln(F.col(f"n_{low}") / F.col("n_all")).alias(f"p_{low}") for low in lows])
    return _weights(tokens), priors


def save_naive_bayes(model: DataFrame, priors: DataFrame, path: str) -> str:
    """Store a fitted model (token weights and class priors) as two Parquet tables."""
    model.write.mode("overwrite").parquet(f"{path.rstrip('/')}/weights")
    priors.write.mode("overwrite").parquet(f"{path.rstrip('/')}/priors")
    return path


def load_naive_bayes(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(weights, priors) of a stored model, for scoring later batches without refitting."""
    return (spark.read.parquet(f"{path.rstrip('/')}/weights"),
            spark.read.parquet(f"{path.rstrip('/')}/priors"))


def naive_bayes_scorer(spark, path: str, **kw) -> Callable[[DataFrame], DataFrame]:
    """A scorer for `enrich` / the transform job backed by a stored model."""
    weights, priors = load_naive_bayes(spark, path)
    return lambda df: score_naive_bayes(df, weights, priors, **kw)


def naive_bayes_priors(docs: DataFrame, label_col: str = "label") -> DataFrame:
    """One row: ln(class share) for each class; null for a class without documents."""
    n = F.count(F.lit(1))
    return docs.agg(*[F.ln(F.sum(F.when(F.col(label_col) == lab, 1).otherwise(0)) / n)
                      .alias(f"p_{lab.lower()}") for lab in C.LABELS])


def score_naive_bayes(df: DataFrame, model: DataFrame, priors: DataFrame,
                      text_col: str = "cleaned_tweet_text", key: str = "tweet_id") -> DataFrame:
    """Class sums = prior + weights of the known tokens (each occurrence counts);
    softmax; label = arg max; score = the winner's probability rounded to 6.
    A post without a known token keeps the priors (left join); a class that had no document
    (null prior) cannot win and has probability zero; without any class label and score are null.

    The texts stay where they are, however large the vocabulary (see `_text_sums`).
    """
    weights = model.select("token", *[f"w_{lab.lower()}" for lab in C.LABELS])
    out = _text_sums(df.withColumn("_known", F.col(text_col).isNotNull()), key, text_col, weights,
                     {f"_s_{lab.lower()}": F.sum(F.col("n") * F.col(f"w_{lab.lower()}")) for lab in C.LABELS},
                     rank=sum(F.exp(f"w_{lab.lower()}") for lab in C.LABELS))
    one = priors.select(F.struct(*[f"p_{lab.lower()}" for lab in C.LABELS])).scalar()
    pri = {lab: F.coalesce(one.getField(f"p_{lab.lower()}"), F.lit(float("-inf"))) for lab in C.LABELS}
    logits = {lab: pri[lab] + F.coalesce(F.col(f"_s_{lab.lower()}"), F.lit(0.0)) for lab in C.LABELS}
    top = F.greatest(*logits.values())
    denom = sum((F.exp(v - top) for v in logits.values()), F.lit(0.0))
    # ties resolve in the fixed label order Negative, Neutral, Positive
    label = F.when(logits[C.LABEL_NEGATIVE] == top, F.lit(C.LABEL_NEGATIVE)) \
        .when(logits[C.LABEL_NEUTRAL] == top, F.lit(C.LABEL_NEUTRAL)) \
        .otherwise(F.lit(C.LABEL_POSITIVE))
    known = F.col("_known") & (top > float("-inf"))
    return (out.withColumns({
        "sentiment_label": F.when(known, label),
        "sentiment_score": F.when(known, F.round(F.lit(1.0) / denom, 6)),
    }).drop("_known", *[f"_s_{lab.lower()}" for lab in C.LABELS]))


# ---------------------------------------------------------------- plug-in model


class LexiconModel:
    """Deterministic stand-in for a pretrained classifier (same rule as `score_lexicon`).

    A real model is plugged in through `score_model(loader=...)`: the loader runs
    once per Python worker and returns an object with `predict(list[str]) ->
    list[tuple[label, score]]`.
    """

    def __init__(self, weights: dict[str, float] | None = None):
        import re

        self.weights = dict(C.FIXTURE_LEXICON if weights is None else weights)
        self._non_letters = re.compile(C.TOKEN_NON_LETTERS)

    def predict(self, texts: list[str | None]) -> list[tuple[str | None, float | None]]:
        out = []
        for t in texts:
            if t is None:
                out.append((None, None))
                continue
            toks = self._non_letters.sub(" ", t).lower().split(" ")
            hits = [self.weights[x] for x in toks if x in self.weights]
            s, h = sum(hits), sum(map(abs, hits))
            label = C.LABEL_POSITIVE if s > 0 else C.LABEL_NEGATIVE if s < 0 else C.LABEL_NEUTRAL
            out.append((label, round((1.0 + abs(s)) / (1.0 + h), 6)))
        return out


def default_model_loader() -> LexiconModel:
    return LexiconModel()


class FittedModel:
    """Logistic regression weights as arrays: feature batches in, labels and confidences out."""

    def __init__(self, weights: np.ndarray, intercepts: np.ndarray, labels: list[str]):
        self.weights, self.intercepts, self.labels = weights, intercepts, labels

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = x @ self.weights.T + self.intercepts
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        return np.array(self.labels, dtype=object)[p.argmax(1)], p.max(1)


def hashed_terms(df: DataFrame, text_col: str = "cleaned_tweet_text", features: int = 512, out: str = "features") -> DataFrame:
    """Term frequencies of the lower-cased letter runs, hashed to a vector (all in the JVM)."""
    terms = F.transform(F.coalesce(letter_runs(F.col(text_col)), F.array().cast("array<string>")), F.lower)
    return HashingTF(inputCol="_terms", outputCol=out, numFeatures=features).transform(df.withColumn("_terms", terms)).drop("_terms")


def fit_model(docs: DataFrame, text_col: str = "text", label_col: str = "label", features: int = 512):
    """A Spark ML logistic regression of labelled texts; numbers of classes follow C.LABELS.  Returns
    the fitted Spark ML model and the same weights as a FittedModel.  A class without a document
    is never predicted; documents without a known label are left out."""
    number = F.coalesce(*[F.when(F.col(label_col) == lab, F.lit(float(i))) for i, lab in enumerate(C.LABELS)])
    train = hashed_terms(docs.withColumn("_class", number).where("_class is not null"), text_col, features)
    ml = LogisticRegression(featuresCol="features", labelCol="_class", family="multinomial", regParam=0.01,
                            maxIter=50).fit(train.select("features", "_class"))
    weights = ml.coefficientMatrix.toArray()
    return ml, FittedModel(weights, ml.interceptVector.toArray(), C.LABELS[:len(weights)])


def score_fitted(df: DataFrame, model: FittedModel, text_col: str = "cleaned_tweet_text") -> DataFrame:
    """The scorer contract with a fitted model: features are made in the JVM, the iterator UDF gets
    them as numbers and multiplies whole batches; it sees no text.  Null text gives nulls."""
    shared = df.sparkSession.sparkContext.broadcast(model)      # classes x features numbers

    @F.pandas_udf(SENTIMENT_TYPE)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for rows in batches:
            label, score = model.predict(np.stack(rows.to_numpy())) if len(rows) else ([], [])
            yield pd.DataFrame({"label": label, "score": score})

    scored = hashed_terms(df, text_col, model.weights.shape[1], "_features")
    scored = scored.withColumn("_sentiment", _score(vector_to_array("_features")))
    known = F.col(text_col).isNotNull()
    return scored.withColumns({
        "sentiment_label": F.when(known, F.col("_sentiment.label")),
        "sentiment_score": F.when(known, F.round("_sentiment.score", 6))}).drop("_sentiment", "_features")


def ship_model_file(spark, path: str) -> str:
    """Ship a model file to every executor (`SparkContext.addFile`); returns its file name."""
    import os

    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped_weights_loader(file_name: str):
    """Loader for `score_model`: reads a shipped JSON word-weights file on the worker.

    The file is fetched once per worker through `SparkFiles`, never closed over
    from the driver.
    """
    def load() -> LexiconModel:
        import json

        from pyspark import SparkFiles

        with open(SparkFiles.get(file_name)) as fh:
            return LexiconModel(json.load(fh))

    return load


def model_udf(loader: Callable[[], object] = default_model_loader):
    @F.pandas_udf(SENTIMENT_TYPE)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = loader()                      # once per worker, not per row or per batch
        for texts in batches:
            values = texts.where(texts.notna(), None).tolist()
            res = model.predict(values)
            yield pd.DataFrame({"label": [r[0] for r in res], "score": [r[1] for r in res]})

    return _score


def score_model(df: DataFrame, loader: Callable[[], object] = default_model_loader,
                text_col: str = "cleaned_tweet_text") -> DataFrame:
    """One struct column evaluated once per row, then split (no double classifier call)."""
    s = model_udf(loader)(F.col(text_col))
    return (df.withColumn("_sentiment", s)
            .withColumns({"sentiment_label": F.col("_sentiment.label"),
                          "sentiment_score": F.col("_sentiment.score")})
            .drop("_sentiment"))


def score_struct(df: DataFrame, text_col: str = "cleaned_tweet_text", out: str = "s",
                 scorer=None) -> DataFrame:
    """The scorer contract as one column `out`: struct<label string, score double>."""
    scored = (scorer or score_lexicon)(df) if scorer else score_lexicon(df, text_col=text_col)
    return (scored.withColumn(out, F.when(F.col("sentiment_label").isNotNull(), F.struct(
        F.col("sentiment_label").alias("label"), F.col("sentiment_score").alias("score"))))
        .drop("sentiment_label", "sentiment_score"))
