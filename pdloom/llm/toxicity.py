"""Toxicity: boosted trees over dense features, calibrated by isotonic regression (operator 7).

A bounded sample of labelled rows is cut into three parts by a hash. The first gives a lexicon:
words and word beginnings that toxic documents hold far more often than others. The second fits
the trees on features of whole texts: densities of the lexicon, closeness to words of the second
person, capitals, punctuation and obfuscation. The third calibrates their probability.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pdloom.llm.common import stored
from pdloom.llm.labelled import SAMPLE_ROWS, training_sample

#: Words of the second person in English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton"
    " ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split()
)
#: Common insults, in the lexicon whatever the sample holds, with this strength.
INSULTS = (
    "clown crap creep disgusting dumb dumbass fool garbage idiot imbecile jerk loser moron"
    " pathetic retard scum scumbag stupid trash ugly vermin worthless"
).split()
INSULT_STRENGTH = 2.0
#: Characters that stand for letters in obfuscated words.
LOOK_ALIKE = str.maketrans("013457@$", "oieastas")
#: A lexicon entry is so many times more often in toxic documents at least, with a likelihood ratio
#: statistic of so much at least; the most entries there are, the strongest first.
LEXICON_RATIO, LEXICON_STATISTIC, LEXICON_ENTRIES = 6.0, 22.0, 400
#: Letters of a word beginning.
STEM = 5
#: Words between an entry and a word of the second person that count as close.
CLOSE = 5
TREES, DEPTH = 30, 4
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_HIDDEN = re.compile(r"[^\W\d_][\d@$*#!+]+[^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_](?!\S)")
FEATURES = (
    "words", "stems", "word_density", "stem_density", "word_strength", "close_share", "closeness",
    "second_person", "capitals", "shouted", "marks", "exclaimed", "hidden", "stretched", "spaced",
    "log_words", "distinct",
)


def plain(word: str) -> str:
    """A word in lower case without marks around it, look-alike characters read as letters."""
    word = word.strip(MARKS + "¡¿«»“”‘’").lower()
    if not word or word.isalpha():
        return word
    return "".join(c for c in word.translate(LOOK_ALIKE) if c.isalpha())


@dataclass(frozen=True)
class Lexicon:
    """Strength (log ratio) of words and of word beginnings."""

    words: dict[str, float]
    stems: dict[str, float]

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        raw = text.split()
        n = max(1, len(raw))
        known = {w: plain(w) for w in set(raw)}
        tally = Counter(raw)
        hits = {w: p for w, p in known.items() if p in self.words}
        stems = {w for w, p in known.items() if p[:STEM] in self.stems and len(p) > STEM}
        second = {w for w, p in known.items() if p in SECOND_PERSON}
        n_hits, n_stems = sum(tally[w] for w in hits), sum(tally[w] for w in stems)
        close, nearest = 0.0, 0.0
        marked = hits or stems
        if marked and second:
            places = [i for i, w in enumerate(raw) if w in second]
            gaps = []
            for i, w in enumerate(raw):
                if w in marked:
                    at = bisect_left(places, i)
                    gaps.append(min(abs(i - p) for p in places[max(0, at - 1) : at + 1]))
            close = sum(g <= CLOSE for g in gaps) / len(gaps)
            nearest = 1 / (1 + min(gaps))
        letters = sum(map(len, raw)) or 1
        return [
            float(n_hits),
            float(n_stems),
            n_hits / n,
            n_stems / n,
            max((self.words[p] for p in hits.values()), default=0.0),
            close,
            nearest,
            sum(tally[w] for w in second) / n,
            sum(map(str.isupper, text)) / letters,
            sum(c for w, c in tally.items() if len(w) > 2 and w.isupper()) / n,
            (letters - sum(map(str.isalnum, text))) / letters,
            text.count("!") / letters,
            sum(c for w, c in tally.items() if not w.isalpha() and _HIDDEN.search(w)) / n,
            sum(c for w, c in tally.items() if _STRETCHED.search(w)) / n,
            len(_SPACED.findall(text)) / n,
            float(np.log1p(len(raw))),
            len(tally) / n,
        ]


def _times_log(count: Column, share: Column, expected: Column) -> Column:
    return F.when(count > 0, count * F.log(share / expected)).otherwise(0.0)


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Entries from rows (doc_id, text, label).

    Documents are counted by family, the smallest hash of their words, so that copies of one
    text count once. Counts are made per entry before they move.
    """
    from xxhash import xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, labels, families = [], [], []
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = {plain(w) for w in set((text or "").split())} - {""}
                found = {"w" + w for w in words} | {"s" + w[:STEM] for w in words if len(w) > STEM}
                family = min((xxh3_64_intdigest(w) >> 1 for w in words), default=0)
                entries += sorted(found)
                labels += [label] * len(found)
                families += [family] * len(found)
            yield pa.record_batch(
                [pa.array(entries, pa.string()), pa.array(labels, pa.int32()), pa.array(families)],
                names=["entry", "label", "family"],
            )

    totals = sample.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    rate = ((totals["toxic"] or 0) + 0.5) / (totals["n"] + 1)
    n, toxic = F.col("n").cast("double"), F.col("toxic").cast("double")
    share = toxic / n
    counts = (
        sample.mapInArrow(run, "entry string, label int, family bigint")
        .groupBy("entry", "family")
        .agg(F.max("label").alias("label"))
        .groupBy("entry")
        .agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
        .withColumn(
            "statistic",
            2 * _times_log(toxic, share, F.lit(rate))
            + 2 * _times_log(n - toxic, 1 - share, F.lit(1 - rate)),
        )
        .withColumn("ratio", ((toxic + 0.5) / rate) / ((n - toxic + 0.5) / (1 - rate)))
        .where((F.col("ratio") >= LEXICON_RATIO) & (F.col("statistic") >= LEXICON_STATISTIC))
        .orderBy(F.desc("statistic"), "entry")
        .limit(LEXICON_ENTRIES)
    )
    found = {r["entry"]: float(np.log(r["ratio"])) for r in counts.collect()}
    learned = {e[1:]: v for e, v in found.items() if e[0] == "w"}
    return Lexicon(
        {**dict.fromkeys(INSULTS, INSULT_STRENGTH), **learned},
        {e[1:]: v for e, v in found.items() if e[0] == "s"},
    )


def with_features(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """The kept columns and a vector of features of the column text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            values = pa.array([lexicon.features(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], values], names=[*keep, "values"]
            )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    rows = docs.select(*keep, "text").mapInArrow(run, f"{kinds}, values array<double>")
    return rows.withColumn("features", array_to_vector("values")).drop("values")


@dataclass(frozen=True)
class ToxicityModel:
    """Lexicon, trees and calibration; ``rate`` alone where the labels could not teach more."""

    lexicon: Lexicon
    rate: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents. With fewer than two classes in a part there
    are no trees, or no calibration; without rows every score is one half."""
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(10))
    sample = stored(
        training_sample(docs, labels, "toxic", usable, rows)
        .withColumn("part", part)
        .repartition("doc_id"),
        "toxic-sample",
    )
    total = sample.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    rate = ((total["toxic"] or 0) + 1) / (total["n"] + 2)
    lexicon = learn_lexicon(sample.where("part < 5").select("doc_id", "text", "label"))
    vectors = stored(
        with_features(sample.where("part >= 5"), lexicon, ["doc_id", "label", "part"]),
        "toxic-vectors",
    )
    # A few thousand short rows: one sorted partition makes the fit the same in every run.
    learn, adjust = (
        vectors.where(condition).coalesce(1).sortWithinPartitions("doc_id", "label", "features")
        for condition in ("part < 8", "part >= 8")
    )
    if learn.agg(F.countDistinct("label")).first()[0] < 2:
        return ToxicityModel(lexicon, rate)
    learn = learn.persist()
    trees = GBTClassifier(
        labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=3, minInstancesPerNode=5
    ).fit(learn)
    learn.unpersist()
    held = trees.transform(adjust).select(
        F.col("label").cast("double").alias("label"),
        vector_to_array("probability")[1].alias("raw"),
    )
    if held.agg(F.countDistinct("label")).first()[0] < 2:
        return ToxicityModel(lexicon, rate, trees)
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(held)
    return ToxicityModel(lexicon, rate, trees, calibration)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from the threshold on) for every row of ``docs``.

    Needs doc_id and text, other columns are ignored; whole texts are scored. A null text is
    scored like an empty one; repeated rows have equal scores; an empty table gives no row.
    """
    if model.trees is None:
        scored = docs.select("doc_id", F.lit(model.rate).alias("score"))
    else:
        rows = with_features(docs, model.lexicon, ["doc_id"])
        raw = model.trees.transform(rows).select(
            "doc_id", vector_to_array("probability")[1].alias("raw")
        )
        if model.calibration is None:
            scored = raw.withColumnRenamed("raw", "score")
        else:
            scored = model.calibration.transform(raw).select(
                "doc_id", F.col("prediction").alias("score")
            )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
