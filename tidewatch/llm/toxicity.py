"""Toxicity by a support vector machine with a subsequence string kernel.

A text is cut into sentences, long ones into pieces. The kernel of two sentences sums, over pairs of their words, a
gap-weighted subsequence kernel, so an insult with letters inserted or left out still resembles itself. Landmark
words give Nyström features, on which a linear machine is trained. Labels are of documents, so the sentences of toxic
documents are labelled in two rounds: first by word statistics, then by the machine itself. A trained machine gives
every word a number; scoring a text adds them up by sentence, and each task computes a word's number once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import chunks, stored
from tidewatch.llm.string_kernel import kernel

# Most labelled documents that a model is fitted on, half of each class if there are enough, and most clean sentences.
TRAIN_DOCS, CLEAN_SENTENCES = 6_000, 30_000
THRESHOLD = 0.7
LANDMARKS, CANDIDATES, ALIKE = 48, 600, 0.3
PIECE_WORDS, WORD_CHARS = 16, 24
# Most words whose numbers a worker remembers.
MEMORY = 300_000

_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n")
_INNER = re.compile(r"[\W_]+")
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&-_~/\\+=`^"


def words_of(sentence: str) -> list[str]:
    """Words without the marks around and in them; three or more single characters in a row are one word."""
    out: list[str] = []
    single: list[str] = []
    for word in sentence.split():
        word = word.strip(_EDGE)
        if not word.isalnum():
            word = _INNER.sub("", word)
        if len(word) == 1:
            single.append(word)
            continue
        if len(single) > 2:
            out.append("".join(single))
        single.clear()
        if len(word) > 2:
            out.append(word)
    if len(single) > 2:
        out.append("".join(single))
    return out


def pieces_of(text: str | None) -> list[set[str]]:
    """The distinct words of each sentence, at most ``PIECE_WORDS`` words at a time; the whole text is used."""
    out = []
    for sentence in _SENTENCE.split((text or "").lower()):
        words = words_of(sentence)
        out += [set(words[i : i + PIECE_WORDS]) for i in range(0, len(words), PIECE_WORDS)]
    return out


def grams_of(word: str) -> set[str]:
    """The word and its substrings of 4 to 6 characters."""
    return {word, *(word[i : i + n] for n in (4, 5, 6) for i in range(len(word) - n + 1))}


def parts_of(word: str) -> list[str]:
    """The word, or overlapping parts of a very long one."""
    return [word] if len(word) <= WORD_CHARS else [word[i : i + WORD_CHARS] for i in range(0, len(word) - WORD_CHARS // 2, WORD_CHARS // 2)]


@dataclass(frozen=True)
class Model:
    """Score = sigmoid(slope * margin + shift); margin = intercept + the best sentence's sum of its words' numbers."""

    landmarks: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    slope: float
    shift: float

    def numbers(self, words: list[str]) -> dict[str, float]:
        if not self.landmarks:
            return dict.fromkeys(words, 0.0)
        parts = [p for w in words for p in parts_of(w)]
        value = (kernel(parts, list(self.landmarks)).astype(np.float64) @ np.array(self.weights)).tolist()
        out: dict[str, float] = {}
        at = 0
        for word in words:
            size = len(parts_of(word))
            out[word] = max(value[at : at + size], key=abs)
            at += size
        return out

    def score(self, margin: float) -> float:
        z = self.slope * margin + self.shift
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


_REMEMBERED: dict[Model, dict[str, float]] = {}


def _score(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if model not in _REMEMBERED:
            _REMEMBERED.clear()
        known = _REMEMBERED.setdefault(model, {})
        for batch in batches:
            for part in chunks(batch, text):
                texts = [pieces_of(t) for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                new = {w for pieces in texts for p in pieces for w in p if w not in known}
                if len(known) + len(new) > MEMORY:
                    known.clear()
                    new = {w for pieces in texts for p in pieces for w in p}
                known.update(model.numbers(list(new)))
                best = [max((sum(map(known.__getitem__, p)) for p in pieces), default=0.0) for pieces in texts]
                scores = pa.array([model.score(model.intercept + b) for b in best], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], [*part.schema.names, "__score"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns plus ``__score``. Null and empty texts have no sentence and get the score of margin 0 words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.limit(0).withColumn("__score", F.lit(0.0)).schema
    return docs.mapInArrow(_score(shared, text), schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "label", "piece", "words"]
    for batch in batches:
        ids, labels, texts = (c.to_pylist() for c in batch.columns)
        rows = [(i, y, n, sorted(p)) for i, y, t in zip(ids, labels, texts) for n, p in enumerate(pieces_of(t))]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int64(), pa.float64(), pa.int32(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sentence's distinct strings that could be landmarks."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            grams = [sorted({g for w in words for g in grams_of(w) if len(g) <= WORD_CHARS}) for words in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(grams, pa.list_(pa.string()))], ["id", "label", "grams"])


def _features(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        landmarks, root, odds = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sentences = part.column(3).to_pylist()
                words = sorted({w for s in sentences for w in s})
                parts = [p for w in words for p in parts_of(w)]
                value = kernel(parts, landmarks).astype(np.float64) @ root
                ends = np.cumsum([len(parts_of(w)) for w in words])
                of = {w: value[e - len(parts_of(w)) : e].sum(axis=0) for w, e in zip(words, ends.tolist())}
                zero = np.zeros(len(landmarks))
                rows = [sum((of[w] for w in s), zero).tolist() for s in sentences]
                telling = {w: max((odds[g] for g in grams_of(w) if g in odds), default=0.0) for w in words}
                first = [sum(telling[w] for w in s) for s in sentences]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(first, pa.float64()), pa.array(rows, pa.list_(pa.float64()))], ["id", "label", "piece", "odds", "features"]
                )

    return run


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from; a null id is not held out, and has no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _choose(counts: list, documents: tuple[float, float]) -> tuple[list[str], dict[str, float]]:
    """Landmarks, most telling strings first and none too like an earlier one, and the log odds of the telling ones.

    Of strings that tell as much the longest comes first, so a whole word stands before its pieces, but the common
    beginning of a family of words stands before each of them.
    """
    odds = {}
    for word, toxic, clean in counts:
        odds[word] = math.log((toxic + 0.5) / (documents[1] + 1)) - math.log((clean + 0.5) / (documents[0] + 1))
    chosen: list[str] = []
    for word in sorted(odds, key=lambda w: (-odds[w], -len(w), w)):
        if len(chosen) == LANDMARKS:
            break
        if not any(word in c or c in word for c in chosen) and (not chosen or kernel([word], chosen).max() < ALIKE):
            chosen.append(word)
    return chosen, {w: v for w, v in odds.items() if v > 1}


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", train_docs: int = TRAIN_DOCS,
    clean_sentences: int = CLEAN_SENTENCES,
) -> Model:
    """Learn from labelled documents that are not held out, ``train_docs`` at most or so.

    Without labels every score is 0.5; with labels of one class it is about that class's share. Ids are integers.
    """
    spark = docs.sparkSession
    usable = labels.select(F.col(doc_id).cast("bigint").alias("id"), F.col(label).cast("double").alias("label"))
    usable = usable.filter(F.col("label").isin(0.0, 1.0) & F.col("id").isNotNull() & ~held_out(F.col("id"))).distinct()
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0.0, 0), sizes.get(1.0, 0)
    if not clean or not toxic:
        share = (toxic + 0.5) / (clean + toxic + 1)
        return Model((), (), 0.0, 0.0, math.log(share / (1 - share)))
    scale = 1 << 30
    part = F.when(F.col("label") == 1, train_docs / 2 / toxic).otherwise(train_docs / 2 / clean)
    picked = usable.filter(F.pmod(F.xxhash64("id"), F.lit(scale)) < part * scale)
    texts = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id").select("id", "label", "text")
    sentences = stored(texts.mapInArrow(_cut, "id bigint, label double, piece int, words array<string>"))
    grams = sentences.mapInArrow(_gram_rows, "id bigint, label double, grams array<string>")
    seen = grams.select("id", "label", F.explode("grams").alias("word")).distinct()
    counts = seen.groupBy("word").agg(F.count(F.when(F.col("label") == 1, 1)).alias("toxic"), F.count(F.when(F.col("label") == 0, 1)).alias("clean"))
    of = {r["label"]: r["n"] for r in sentences.groupBy("label").agg(F.count_distinct("id").alias("n")).collect()}
    documents = (float(of.get(0.0, 0)), float(of.get(1.0, 0)))
    telling = F.log((F.col("toxic") + 0.5) / (documents[1] + 1)) - F.log((F.col("clean") + 0.5) / (documents[0] + 1))
    top = counts.filter("toxic > 1").withColumn("odds", telling).orderBy(F.desc("odds"), "word").limit(CANDIDATES).select("word", "toxic", "clean").collect()
    landmarks, odds = _choose([tuple(r) for r in top], documents)
    if not landmarks:
        return Model((), (), 0.0, 0.0, math.log(toxic / clean))
    square = kernel(landmarks, landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    root = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    shared = spark.sparkContext.broadcast((landmarks, root, odds))
    rows = stored(sentences.mapInArrow(_features(shared), "id bigint, label double, piece int, odds double, features array<double>"))
    rows = rows.withColumn("features", array_to_vector("features"))
    total = rows.filter("label = 0").count()
    negative = rows.filter("label = 0").filter(F.pmod(F.xxhash64("id", "piece"), F.lit(scale)) < scale * min(1.0, clean_sentences / max(total, 1)))
    machine, guide = None, F.col("odds")
    for _ in range(2):
        positive = rows if machine is None else machine.transform(rows)
        guide = F.col("odds") if machine is None else vector_to_array("rawPrediction")[1]
        by_doc = Window.partitionBy("id").orderBy(F.desc(guide), "piece")
        best = positive.filter("label = 1").withColumn("n", F.row_number().over(by_doc)).filter("n = 1")
        train = stored(best.select("label", "features").union(negative.select("label", "features")))
        sizes = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
        heavy = max(1.0, sizes.get(0.0, 0) / max(1, 4 * sizes.get(1.0, 0)))
        weighed = train.withColumn("weight", F.when(F.col("label") == 1, heavy).otherwise(1.0))
        machine = LinearSVC(regParam=0.00001, standardization=False, maxIter=150, tol=1e-5, weightCol="weight").fit(weighed)
    weights = root @ machine.coefficients.toArray()
    margins = machine.transform(rows).groupBy("id", "label").agg(F.max(vector_to_array("rawPrediction")[1]).alias("margin"))
    curve = LogisticRegression(regParam=0.001).fit(stored(margins.select("label", array_to_vector(F.array("margin")).alias("features"))))
    return Model(tuple(landmarks), tuple(weights.tolist()), float(machine.intercept), float(curve.coefficients[0]), float(curve.intercept))
