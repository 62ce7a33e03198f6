"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

The lexicon, the trees and the calibration are learned from labelled rows. Words are compared in a plain
form (lower case, look-alike characters undone, repeated letters and outer marks removed), so spelling
tricks do not hide them; how often that was needed is itself a feature.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .common import as_row, whole_text

TRAINING_ROWS = 40_000  # most labelled rows that lexicon, trees and calibration are learned from
LEXICON_WORDS = 2_000  # most forms in the lexicon
CANDIDATES = 100_000  # most forms of toxic documents that are looked up in the others
STEMS = (4, 5, 6, 7, 8)  # beginnings of words that may be lexicon forms
STEM_GAIN = 1.5  # a beginning must stand in so many times the documents of any one word with it
LEXICON_DOCUMENTS = 3  # fewest toxic documents of a lexicon form
LEXICON_RATIO = 8.0  # a lexicon form is so many times as frequent in toxic documents
TREES, DEPTH = 20, 4
NEAR_WORDS = 6
CACHED_WORDS = 200_000

# second-person words (fixed list, four languages)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos usted ustedes ti vosotros vuestro".split())
# characters written for the letter they look like (fixed table)
LOOKALIKES = str.maketrans("013457@$!|", "oieastasii")

FEATURES = (
    "log_words hits hit_density weight_density top_weight distinct_hits second_person near_second_person "
    "capital_letters capital_words exclamations mark_runs hidden_hits mixed_words spaced_letters"
).split()

_REPEATED = re.compile(r"(.)\1{2,}")
_INNER = re.compile(r"(?<=\w)[*._\-~^+]+(?=\w)")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .*_\-]){3,}\w(?!\w)")
_MAYBE_SPACED = re.compile(r"[ .*_\-]\w[ .*_\-]\w[ .*_\-]\w")
_MARKS = re.compile(r"[!?]{2,}|[#$%&*@^~]{3,}")
_MIXED = re.compile(r"[^\W\d_][\d@$*]+[^\W\d_]")
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ENDS = ".,;:!?\"'()[]{}<>#%&*_~-+=/\\"


def bare(word: str) -> str:
    """Lower case without marks at its ends."""
    return word.strip(_ENDS).lower()


def plain(word: str) -> str:
    """The bare word with look-alikes, inner marks and stretched letters undone."""
    core = word.strip(_ENDS).lower()
    if not core.isalpha():
        core = word.lower().strip(_ENDS.replace("!", "")).rstrip("!")
        core = _INNER.sub("", core)
        if any(c.isalpha() for c in core):
            core = core.translate(LOOKALIKES)
    return _REPEATED.sub(r"\1", core)


def words_of(text: str) -> list[str]:
    """Words; four or more single characters set apart by spaces or marks are put together first."""
    if _MAYBE_SPACED.search(text):
        text = _SPACED.sub(lambda m: re.sub(r"[ .*_\-]", "", m[0]), text)
    return text.split()


def forms_of(word: str) -> set[str]:
    """What a word is known by in the lexicon: bare, plain, and the beginnings of its plain form."""
    full = plain(word)
    return {f for f in (bare(word), full) if 2 <= len(f) <= 40} | {f"{full[:k]}*" for k in STEMS if len(full) > k}


SECOND, HIDDEN, CAPITAL, MIXED, MARKED = 1, 2, 4, 8, 16


class Features:
    """Feature rows of texts for one lexicon (form -> weight)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        # how a lexicon word may begin, stretched letters included
        self.heads = {f[:2] for f in lexicon} | {f[0] * 2 for f in lexicon}
        self.notable: dict[str, tuple[float, int]] = {}  # words with a weight or a flag
        self.common: set[str] = set()  # words without

    def _look(self, word: str) -> tuple[float, int]:
        """Weight and flags of a word."""
        core = bare(word)
        letters = core.isalpha()
        flags = SECOND if core in SECOND_PERSON else 0
        flags |= CAPITAL if len(word) > 2 and word.isupper() else 0
        if not letters:
            flags |= MIXED if _MIXED.search(word) else 0
        if len(word) > len(core):
            flags |= MARKED if _MARKS.search(word) else 0
        weight = 0.0
        if not letters or core[:2] in self.heads:
            lexicon = self.lexicon
            weight = max(lexicon.get(f, 0.0) for f in (forms_of(word) or {""}))
            if weight and core not in lexicon and not any(f"{core[:k]}*" in lexicon for k in STEMS if len(core) > k):
                flags |= HIDDEN
        return weight, flags

    def _learn(self, words: set[str]) -> None:
        if len(self.notable) > CACHED_WORDS:
            self.notable.clear()
        if len(self.common) > CACHED_WORDS:
            self.common.clear()
        for word in words.difference(self.notable, self.common):
            found = self._look(word)
            if found == (0.0, 0):
                self.common.add(word)
            else:
                self.notable[word] = found

    def rows(self, texts: list[str]) -> list[list[float]]:
        split = [words_of(t) for t in texts]
        self._learn(set().union(*split))
        return [self._row(t, words) for t, words in zip(texts, split)]

    def _row(self, text: str, words: list[str]) -> list[float]:
        notable = self.notable
        marked = [(i, w, *notable[w]) for i, w in enumerate(words) if w in notable]
        hits = [(i, word, weight) for i, word, weight, _ in marked if weight]
        persons = [i for i, _, _, flags in marked if flags & SECOND]
        near = 0
        if hits and persons:
            at = np.array(persons)
            near = sum(bool(np.any(np.abs(at - i) <= NEAR_WORDS)) for i, _, _ in hits)
        n, data = len(words), text.encode()
        total, letters = max(n, 1), max(len(data), 1)
        weights = [w for *_, w in hits]
        count = lambda flag: sum(1 for *_, flags in marked if flags & flag)
        return [
            math.log1p(n), float(len(hits)), 100 * len(hits) / total, 100 * sum(weights) / total, max(weights, default=0.0),
            float(len({plain(word) for _, word, _ in hits})), 100 * len(persons) / total, float(near),
            (len(data) - len(data.translate(None, _CAPITALS))) / letters, 100 * count(CAPITAL) / total, 100 * data.count(b"!") / letters,
            100 * count(MARKED) / total, float(count(HIDDEN)), 100 * count(MIXED) / total,
            float(len(_SPACED.findall(text))) if _MAYBE_SPACED.search(text) else 0.0,
        ]


def _with_features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """Adds the feature columns to ``rows``, which has ``whole``."""

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Features(lexicon)
        for texts in batches:
            values = texts.tolist()
            yield pd.Series([row for a in range(0, len(values), 256) for row in of.rows(values[a : a + 256])], dtype=object)

    return rows.withColumn("features_of", features("whole"))


def _vectors(rows: DataFrame) -> DataFrame:
    split = rows.select("*", *[F.col("features_of")[i].alias(f"f{i}") for i in range(len(FEATURES))])
    return VectorAssembler(inputCols=[f"f{i}" for i in range(len(FEATURES))], outputCol="features").transform(split)


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _counted(chosen: frozenset | None):
    """Documents per form of a task's rows, of the chosen forms or of all."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, int] = {}
        known: dict[str, tuple[str, ...]] = {}  # most words have no chosen form, and share one empty tuple
        for frame in frames:
            for text in frame["whole"]:
                found: set[str] = set()
                for word in set(words_of(text)):
                    if (forms := known.get(word)) is None:
                        if len(known) > CACHED_WORDS:
                            known.clear()
                        forms = known[word] = tuple(forms_of(word) if chosen is None else forms_of(word) & chosen)
                    found.update(forms)
                for form in found:
                    counts[form] = counts.get(form, 0) + 1
            if len(counts) > CACHED_WORDS:
                yield pd.DataFrame(counts.items(), columns=["form", "documents"])
                counts = {}
        yield pd.DataFrame(counts.items(), columns=["form", "documents"])

    return run


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Forms that stand in toxic documents much more often than chance allows, with their log odds.

    All given rows count. First the forms of toxic documents, of which the ``CANDIDATES`` most frequent
    reach the driver; then those forms in the others. A form must be ``LEXICON_RATIO`` times as frequent in
    toxic documents, and its counts less likely than one in the number of forms, so that with many rare
    words none gets in by luck.
    """

    def count(rows: DataFrame, chosen: frozenset | None) -> DataFrame:
        found = rows.select("whole").mapInPandas(_counted(chosen), "form string, documents long")
        return found.groupBy("form").agg(F.sum("documents").alias("documents"))

    toxic_all, all_rows = labelled.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    toxic = materialise(count(labelled.filter("toxic = 1"), None), "forms")
    chances = toxic.count()
    frequent = toxic.filter(F.col("documents") >= LEXICON_DOCUMENTS).orderBy(F.desc("documents"), "form").limit(CANDIDATES)
    in_toxic = {r["form"]: r["documents"] for r in frequent.collect()}
    in_clean = {r["form"]: r["documents"] for r in count(labelled.filter("toxic = 0"), frozenset(in_toxic)).collect()}
    share, kept = toxic_all / all_rows, {}
    longest: dict[str, int] = {}  # documents of the most frequent word with a beginning
    for form, hits in in_toxic.items():
        for stem in {f"{form[:k]}*" for k in STEMS if len(form) > k and form[-1] != "*"}:
            longest[stem] = max(longest.get(stem, 0), hits)
    for form, hits in in_toxic.items():
        if form[-1] == "*" and hits < STEM_GAIN * longest.get(form, 0):
            continue  # one word explains it
        misses = in_clean.get(form, 0)
        odds = math.log((hits + 0.5) / (toxic_all + 1) * (all_rows - toxic_all + 1) / (misses + 0.5))
        own = hits / (hits + misses)
        surprise = hits * math.log(own / share) + (misses * math.log((1 - own) / (1 - share)) if misses else 0.0)
        if odds >= math.log(LEXICON_RATIO) and surprise >= math.log(chances) + 1:
            kept[form] = odds
    best = sorted(kept, key=lambda f: (-kept[f] * math.log1p(in_toxic[f]), f))[:LEXICON_WORDS]
    return {form: kept[form] for form in best}


class ToxicityModel:
    """Lexicon, trees and calibration, learned from labelled documents."""

    def __init__(self, lexicon, trees, calibration, constant: float | None):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame) -> ToxicityModel:
        """Learns from the rows of ``docs`` with a 0/1 label whose id is not held out.

        Labels are joined by doc_id; rows without label or id are passed over. Of more than ``TRAINING_ROWS``
        labels so many are drawn. A fifth of the rows fits the calibration, the others lexicon and trees.
        With one class only, every score is that class.
        """
        known = labels.filter(F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
        known = known.filter(~is_held_out(F.col("labelled"))).groupBy("labelled").agg(F.max("toxic").alias("toxic"))
        # drawn by the id, bounded, and so fit to be sent to the documents
        known = known.withColumn("draw", F.pmod(F.xxhash64("labelled", F.lit("fold")), F.lit(1_000_000_007)))
        known = F.broadcast(known.orderBy("draw", "labelled").limit(TRAINING_ROWS))
        rows = docs.select(docs["doc_id"].cast("long").alias("labelled"), whole_text(docs).alias("whole")).join(known, "labelled")
        rows = materialise(rows.select("whole", "toxic", "draw"), "labelled")
        total, toxic = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
        if not total or toxic in (0, total):
            return cls({}, None, None, 1.0 if total and toxic == total else 0.0)
        fitting = F.col("draw") % 5 != 0
        classes = {(r[0], r[1]) for r in rows.select(fitting, "toxic").distinct().collect()}
        if len(classes) < 4:  # too few rows to hold some back: calibrate on the rows that fit the trees
            fitting = F.lit(True)
        lexicon = learn_lexicon(rows.filter(fitting))
        ready = materialise(_with_features(rows, lexicon).select("features_of", F.col("toxic").cast("double").alias("toxic"), fitting.alias("fitting")), "features")
        vectors = _vectors(ready)
        trees = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7).fit(vectors.filter("fitting"))
        held_back = vectors if len(classes) < 4 else vectors.filter("NOT fitting")
        scored = trees.transform(held_back).select("toxic", vector_to_array("probability")[1].alias("raw"))
        calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="score").fit(scored)
        return cls(lexicon, trees, calibration, None)

    def score(self, docs: DataFrame) -> DataFrame:
        """``row`` (all columns of ``docs``) and ``score`` 0..1 of every row.

        The text alone decides: equal texts score alike, an empty or null text has the features 0. The
        calibrated probability is mixed with a hundredth of the raw one, which orders the rows of one step.
        """
        rows = docs.select(as_row(docs), whole_text(docs).alias("whole"))
        if self.constant is not None:
            return rows.select("row", F.lit(self.constant).alias("score"))
        vectors = _vectors(_with_features(rows, self.lexicon).select("row", "features_of"))
        raw = self.trees.transform(vectors).select("row", vector_to_array("probability")[1].alias("raw"))
        calibrated = self.calibration.transform(raw)
        return calibrated.select("row", (F.col("score") * 0.99 + F.col("raw") * 0.01).alias("score"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5) of every document."""
    scored = ToxicityModel.fit(docs, labels).score(docs).select(F.col("row.doc_id").alias("doc_id"), "score")
    held = F.coalesce(is_held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, training: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, all columns unchanged."""
    scored = ToxicityModel.fit(training, labels).score(docs)
    return scored.filter("score < 0.5").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
