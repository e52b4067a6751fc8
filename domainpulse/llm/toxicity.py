"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Fitting uses at most about ``TRAIN_ROWS`` labelled rows (a documented bound;
chosen by a hash of the id), parted by another hash of the id:

* lexicon part: word beginnings and words that stand in clearly more toxic
  than other texts, counted once per distinct text; a small fixed list of
  insults is added;
* tree part: gradient-boosted trees over the dense features;
* calibration part: isotonic regression of the trees' margin.

Scoring reads every whole text: one pass in Arrow batches for the features,
then the trees and the calibration inside the JVM.  Features are lexicon
densities (listed words, learned words, learned beginnings, also after
undoing digit-for-letter spelling), closeness of second-person words to
lexicon words, capitals, punctuation and obfuscation rates and the length.
The id, source, language and labels are no inputs.

Defined results: null and empty texts have all-zero features and are scored
like others; a null id counts as held out; rows labelled null are not
learned from, a row labelled both ways counts as toxic; repeated rows score
alike; with no labels of one kind the score is the share of toxic labels
(0 without labels); an empty table gives no rows; input columns named like
the added ones are replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import TEXT_BATCH, documents, small, stored, text_or_empty, without

#: Bound on the labelled rows that are learned from.
TRAIN_ROWS = 20_000
#: A lexicon entry stands in at least this share of the toxic texts, so there are at most 1 / SUPPORT times as many as an
#: average text holds, and is this much likelier there (log odds).
SUPPORT, LOG_ODDS = 0.01, 2.5
#: Texts whose entries are gathered at a time.
ENTRY_TEXTS = 64
BEGINNINGS = (4, 5, 6, 7)
NEAR = 6
THRESHOLD = 0.5
ADDED = ("held_out", "score", "predicted")

#: Common insults, and second-person words of four languages (fixed values).
INSULTS = frozenset("""idiot idiots moron morons stupid dumb loser losers pathetic worthless disgusting trash garbage
    scum clown fool imbecile hate idiota estúpido estúpida imbécil basura dumm dummkopf trottel abschaum müll
    idiote stupide débile ordure salaud""".split())
SECOND_PERSON = frozenset("""you your yours yourself u ur tu te toi vous votre vos du dich dir dein deine ihr euch
    usted ustedes tú ti contigo vosotros vuestro""".split())
#: Digits and signs written for letters (fixed values).
LEET = str.maketrans("013457@$!", "oieastasi")

WORDS = re.compile(r"\w+")
DISGUISED = re.compile(r"[^\W\d_]+[0-9@$!*#]+[^\W\d_]+")
SPELLED = re.compile(r"\b(?:\w[ .\-_*]){2,}\w\b")
STRETCHED = re.compile(r"(\w)\1{3,}")
RUNS = re.compile(r"[!?]{2,}")


@dataclass(frozen=True)
class Lexicon:
    words: dict[str, float]
    beginnings: dict[str, float]

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for n in BEGINNINGS:
            if n < len(word):
                found = max(found, self.beginnings.get(word[:n], 0.0))
        return found


def features(text: str, lexicon: Lexicon, known: dict[str, float]) -> list[float]:
    """The dense features of one whole text; ``known`` keeps the weights of words met before."""
    words = WORDS.findall(text.lower())
    if not words:
        return [0.0] * N_FEATURES
    weights = []
    for w in words:
        v = known.get(w)
        if v is None:
            v = known[w] = lexicon.weight(w)
        weights.append(v)
    n = len(words)
    hits = [i for i, v in enumerate(weights) if v > 0]
    insults = [i for i, w in enumerate(words) if w in INSULTS]
    marked = sorted({*hits, *insults})
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near, j = 0, 0
    for i in marked:
        while j < len(second) and second[j] < i - NEAR:
            j += 1
        near += j < len(second) and second[j] <= i + NEAR
    disguised = DISGUISED.findall(text.lower())
    unmasked = sum(1 for d in disguised if (p := d.translate(LEET)) in INSULTS or lexicon.weight(p) > 0)
    letters = sum(map(str.isalpha, text))
    capitals = sum(map(str.isupper, text))
    shouted = sum(1 for w in WORDS.findall(text) if len(w) > 2 and w.isupper())
    return [
        math.log1p(n), len(hits) / n, math.log1p(len(hits)), sum(weights) / n, max(weights), len(insults) / n,
        math.log1p(len(insults)), len(second) / n, near / n, near / max(1, len(marked)), capitals / max(1, letters),
        shouted / n, text.count("!") / n, text.count("?") / n, len(RUNS.findall(text)) / n, len(disguised) / n,
        unmasked / n, len(SPELLED.findall(text)) / n, len(STRETCHED.findall(text)) / n,
    ]


N_FEATURES = 19


def feature_column(lexicon: Lexicon) -> Column:
    @F.pandas_udf("array<double>")
    def compute(texts: pd.Series) -> pd.Series:
        known: dict[str, float] = {}
        return pd.Series([features(t, lexicon, known) for t in texts], dtype=object)

    return compute(text_or_empty())


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the row is in the fold that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def _train_rows(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(text, label, part) of about ``bound`` labelled rows at most, written to the shared folder."""
    usable = (
        labels.where("toxic is not null and doc_id is not null").where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    )
    n = usable.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
    chosen = usable.where(draw < int(1_000_000 * min(1.0, bound / max(n, 1)))).withColumnRenamed("doc_id", "_id")
    part = F.pmod(F.xxhash64("_id", F.lit(23)), F.lit(10))
    # Broadcast: at most about ``bound`` rows of an id and a label.
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return stored(rows.select("text", "label", F.when(part < 4, "lexicon").when(part < 8, "trees").otherwise("scale")
                              .alias("part")), "toxicity-train")


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words and word beginnings of toxic texts, from (text, label)."""
    distinct = rows.groupBy(F.md5("text").alias("_k")).agg(F.max("label").alias("label"), F.max("text").alias("text"))

    def entries(batches):
        # A few texts at a time: each gives some thousand entries.
        for batch in batches:
            for at in range(0, len(batch), ENTRY_TEXTS):
                out = []
                for text, label in zip(batch["text"][at:at + ENTRY_TEXTS], batch["label"][at:at + ENTRY_TEXTS]):
                    words = {w for w in WORDS.findall(text.lower()) if len(w) > 2 and not w.isdigit()}
                    keys = {(w, 0) for w in words} | {(w[:n], 1) for w in words for n in BEGINNINGS if n < len(w)}
                    out += [(k, kind, label) for k, kind in keys]
                yield pd.DataFrame(out, columns=["entry", "kind", "label"])

    distinct = stored(distinct.select("text", "label"), "toxicity-texts")
    n, toxic = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not toxic or toxic == n:
        return Lexicon({}, {})
    counts = distinct.mapInPandas(entries, "entry string, kind int, label int").groupBy("entry", "kind").agg(
        F.sum("label").alias("p"), F.count(F.lit(1)).alias("a"))
    odds = F.log((F.col("p") + 0.5) / (toxic + 1.0)) - F.log((F.col("a") - F.col("p") + 0.5) / (n - toxic + 1.0))
    top = (
        counts.withColumn("odds", odds)
        .where((F.col("p") >= max(3, math.ceil(SUPPORT * toxic))) & (F.col("odds") >= LOG_ODDS))
        .collect()  # the model: bounded by SUPPORT
    )
    return Lexicon({r["entry"]: r["odds"] for r in top if r["kind"] == 0},
                   {r["entry"]: r["odds"] for r in top if r["kind"] == 1})


class ToxicityModel:
    """Lexicon, trees and calibration; ``score`` is a frame-to-frame function."""

    def __init__(self, lexicon: Lexicon, trees, scale, base: float):
        self.lexicon, self.trees, self.scale, self.base = lexicon, trees, scale, base

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``score``."""
        if self.trees is None:
            return without(docs, "score").withColumn("score", F.lit(self.base))
        keep = without(docs, "score").columns
        vec = without(docs, "score").withColumn("_features", array_to_vector(feature_column(self.lexicon)))
        out = self.trees.transform(vec)
        if self.scale is not None:
            out = self.scale.transform(_margin(out))
            score = F.col("_scaled")
        else:
            score = vector_to_array("_probability")[1]
        return out.select(*[F.col(f"`{c}`") for c in keep], F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)).alias("score"))

    def keep_clean(self, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
        """The rows of ``docs`` scored below ``threshold``, with their own columns only.

        The rejected rows' ids and text hashes are written, and the rows without them returned.
        """
        text_hash = F.xxhash64(text_or_empty())
        rejected = self.score(docs.select("doc_id", "text")).where(F.col("score") >= threshold).select(
            F.col("doc_id").alias("_rejected_id"), text_hash.alias("_rejected_hash")).distinct()
        rejected = small(stored(rejected, "toxicity-rejected", batch=TEXT_BATCH))
        return docs.join(
            rejected, F.col("doc_id").eqNullSafe(F.col("_rejected_id")) & (text_hash == F.col("_rejected_hash")), "left_anti")


def _margin(df: DataFrame) -> DataFrame:
    return df.withColumn("_margin", vector_to_array("_raw")[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS) -> ToxicityModel:
    rows = _train_rows(docs, labels, bound)
    lexicon = learn_lexicon(rows.where("part = 'lexicon'"))
    fit = stored(rows.where("part <> 'lexicon'").select("label", "part", array_to_vector(
        feature_column(lexicon)).alias("_features")), "toxicity-features", batch=TEXT_BATCH)
    seen = {(r["part"], r["label"]): r["n"] for r in fit.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(seen.values())
    base = sum(n for (_, label), n in seen.items() if label) / total if total else 0.0
    if not (seen.get(("trees", 0)) and seen.get(("trees", 1))):
        return ToxicityModel(lexicon, None, None, base)
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", predictionCol="_predicted", maxIter=20, maxDepth=3, stepSize=0.2,
        seed=7,
    ).setRawPredictionCol("_raw").setProbabilityCol("_probability").fit(fit.where("part = 'trees'").coalesce(4))
    scale = None
    if seen.get(("scale", 0), 0) and seen.get(("scale", 1), 0):
        margins = _margin(trees.transform(fit.where("part = 'scale'"))).select(
            "_margin", F.col("label").cast("double").alias("label"))
        scale = IsotonicRegression(featuresCol="_margin", labelCol="label", predictionCol="_scaled").fit(margins)
    return ToxicityModel(lexicon, trees, scale, base)


def score_documents(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """Every row of ``docs`` with held_out, score and predicted, from a model fitted on ``learn_from`` or ``docs``."""
    model = fit_toxicity(docs if learn_from is None else learn_from, labels)
    return model.score(without(docs, *ADDED)).withColumn("held_out", held_out()).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_documents(docs, labels).select("doc_id", "held_out", "score", "predicted")
    return stored(scored, "toxicity-scores", batch=TEXT_BATCH)
