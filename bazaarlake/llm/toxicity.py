"""A toxicity classifier that does not lean on who is mentioned.

Features of a text: its words, their first 3 to 6 letters and their last 3 or 4, each present or not.
A logistic regression with an L1 and an L2 penalty is fitted on a bounded sample of labelled texts.
Counterfactuals: in every labelled sentence with an identity term the term is swapped for the others
of its kind; the squared change of the score, times `fairness`, is added to the loss.  So no weight
stays on a term that tells one group from another, and a neutral mention does not raise the score.

Fitting works on hashed features of the sample alone, at most `per_class` documents of each label
(those with the smallest hash of their id); the share of toxic documents among all labelled ones sets
the intercept.  Features are counted and chosen in Spark; to the driver go a bit for each sampled document and
chosen feature, and at most `swaps_per_doc` swaps of each document (those met first).  Scoring runs over all
documents in Arrow batches.

Defined cases: a null or empty text, or one without known features, gets the intercept's score; rows
with equal ids or repeated whole are scored alike; labels that are null or have no document are not
used; where a label is missing from the sample all scores are the share of toxic labels (0.5 of none);
an empty table gives no rows; a very long text is read whole, for fitting and for scoring.  Only id and text of
the documents are read, whatever else they hold.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import smallest_hashes, written
from bazaarlake.llm.terms import slices

# Groups of identity terms that can stand for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "hispanic", "indigenous"),
    ("africans", "europeans", "americans", "mexicans", "chinese", "indians"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "blind", "deaf", "elderly"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einwanderer"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "immigrés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "inmigrantes"),
)

PER_CLASS = 4000
MAX_FEATURES = 20_000
MIN_DOCS = 3
FAIRNESS = 10.0
SWAPS_PER_DOC = 32
#: Texts whose features are held at once: thousands of numbers each, and a whole sample may lie in one batch.
DOCS_AT_ONCE, BYTES_AT_ONCE = 256, 1 << 20
#: Words that a scorer keeps the features of.
KNOWN_WORDS = 150_000
_WORD = re.compile(r"[^\W_]+")


def word_features(word: str) -> tuple[int, ...]:
    names = [f"w{word}"]
    names += [f"p{word[:k]}" for k in range(3, 7) if len(word) >= k]
    names += [f"s{word[-k:]}" for k in (3, 4) if len(word) > k]
    return tuple(zlib.crc32(n.encode("utf-8", "surrogatepass")) for n in names)


def features(words: set[str]) -> set[int]:
    return {f for w in words for f in word_features(w)}


def others_of(identity_terms) -> dict[str, tuple[str, ...]]:
    """For each term the others of its group."""
    return {t: tuple(o for o in kind if o != t) for kind in identity_terms for t in kind}


def swaps(text: str, others: dict[str, tuple[str, ...]], most: int) -> Iterator[tuple[set[int], set[int]]]:
    """Features that the text loses and wins where a term of one of its sentences stands for another of its kind."""
    text, found = text.lower(), 0
    own = None
    for sentence in re.split(r"[.!?\n]+", text):
        said = set(_WORD.findall(sentence))
        for term in sorted(said & others.keys()):
            if own is None:
                words = set(_WORD.findall(text))
                own = features(words)
            for other in others[term]:
                if found == most:
                    return
                found += 1
                now = features((words - {term}) | {other} if other not in words else words - {term})
                yield own - now, now - own


@dataclass
class ToxicityModel:
    """weights by feature: at most MAX_FEATURES."""

    weights: dict[int, float]
    intercept: float

    def scorer(self):
        known: dict[str, tuple[int, ...]] = {}
        weights = self.weights

        def score(text: str | None) -> float:
            present: set[int] = set()
            for word in set(_WORD.findall((text or "").lower())):
                own = known.get(word)
                if own is None:
                    own = known[word] = tuple(f for f in word_features(word) if f in weights)
                    if len(known) > KNOWN_WORDS:
                        known.clear()
                if own:
                    present.update(own)
            z = self.intercept + math.fsum(weights[f] for f in present)
            return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

        return score


def _features(labelled: DataFrame) -> DataFrame:
    """Rows label, feats (distinct hashed features) of rows label, body."""

    def map_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, BYTES_AT_ONCE, DOCS_AT_ONCE):
            feats = [sorted(features(set(_WORD.findall((text or "").lower())))) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(feats, pa.list_(pa.int64()))], names=["label", "feats"])

    return labelled.mapInArrow(map_features, "label int, feats array<long>")


def chosen_features(featured: DataFrame, labels: tuple[int, int]) -> np.ndarray:
    """The features that tell the labels apart best, in rising order; labels: sampled documents in all, toxic ones."""
    n, toxic = labels
    share = toxic / n
    counted = featured.select("label", F.explode("feats").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("docs"), F.sum("label").alias("toxic")).where(F.col("docs") >= MIN_DOCS)
    z = F.abs(F.col("toxic") - F.col("docs") * share) / F.sqrt(F.col("docs") * (share * (1 - share)) + 1e-9)
    best = counted.orderBy(F.desc(z), "feature").limit(MAX_FEATURES)
    return np.sort(np.array([r[0] for r in best.select("feature").collect()], np.int64))  # at most MAX_FEATURES numbers


def _in_columns(labelled: DataFrame, columns: np.ndarray, others: dict, swaps_per_doc: int) -> DataFrame:
    """Rows label, bits (a bit for each column), lost and won (column numbers for each swap, ended by -1)."""
    shared = labelled.sparkSession.sparkContext.broadcast((columns, others))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, others = shared.value
        number = {f: i for i, f in enumerate(columns.tolist())}
        of = lambda feats: sorted(number[f] for f in feats if f in number)
        for batch in slices(batches, 1, BYTES_AT_ONCE, DOCS_AT_ONCE):
            out = ([], [], [])
            for text in batch.column(1).to_pylist():
                bits = np.zeros(len(columns), bool)
                bits[of(features(set(_WORD.findall((text or "").lower()))))] = True
                lost, won = [], []
                for gone, come in swaps(text or "", others, swaps_per_doc):
                    lost += [*of(gone), -1]
                    won += [*of(come), -1]
                for column, value in zip(out, (np.packbits(bits), np.array(lost, "<i4"), np.array(won, "<i4"))):
                    column.append(value.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.binary()) for c in out)], names=["label", "bits", "lost", "won"])

    return labelled.mapInArrow(mapped, "label int, bits binary, lost binary, won binary")


def _swap_cells(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Swap and column numbers."""
    flat = np.frombuffer(raw, "<i4").astype(np.int64)
    swap, here = np.cumsum(flat < 0), flat >= 0
    return swap[here], flat[here]


def fit_weights(rows: np.ndarray, cols: np.ndarray, k: int, labels: np.ndarray, lost: tuple, won: tuple, m: int, fairness: float = FAIRNESS,
                l1: float = 2e-4, l2: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights of k columns and the intercept, by accelerated proximal gradient steps.

    rows and cols say which documents have which features; lost and won, which of m swaps takes away and brings which.
    """
    share = labels.mean()
    (lost_rows, lost_cols), (won_rows, won_cols) = lost, won
    n = len(labels)

    def times(rows, cols, w, size):
        return np.bincount(rows, weights=w[cols], minlength=size)

    w, bias = np.zeros(k), math.log(share / (1 - share))
    ahead, bias_ahead, t = w.copy(), bias, 1.0
    # Step sizes from row and column sums, a bound of the curvature for each weight alone.
    width = np.bincount(rows, minlength=n) + 1.0
    curve = 0.25 * np.bincount(cols, weights=width[rows], minlength=k) / n + l2
    if m:
        swap_width = np.bincount(lost_rows, minlength=m) + np.bincount(won_rows, minlength=m) + 1.0
        curve += 2 * fairness / n * (np.bincount(lost_cols, weights=swap_width[lost_rows], minlength=k)
                                     + np.bincount(won_cols, weights=swap_width[won_rows], minlength=k))
    bias_curve = 0.25 * width.mean()
    for _ in range(steps):
        score = np.clip(times(rows, cols, ahead, n) + bias_ahead, -30, 30)
        error = 1 / (1 + np.exp(-score)) - labels
        slope = np.bincount(cols, weights=error[rows], minlength=k) / n + l2 * ahead
        if m:
            change = times(won_rows, won_cols, ahead, m) - times(lost_rows, lost_cols, ahead, m)
            slope += 2 * fairness / n * (np.bincount(won_cols, weights=change[won_rows], minlength=k)
                                         - np.bincount(lost_cols, weights=change[lost_rows], minlength=k))
        moved = ahead - slope / curve
        moved = np.sign(moved) * np.maximum(np.abs(moved) - l1 / curve, 0)
        bias_moved = bias_ahead - error.mean() / bias_curve
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, bias_ahead = moved + (t - 1) / t_next * (moved - w), bias_moved + (t - 1) / t_next * (bias_moved - bias)
        w, bias, t = moved, bias_moved, t_next
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = PER_CLASS, fairness: float = FAIRNESS, identity_terms=IDENTITY_TERMS, swaps_per_doc: int = SWAPS_PER_DOC) -> ToxicityModel:
    """From the labelled documents given; the caller leaves out those that it holds back.

    identity_terms: groups of words that may stand for one another, in lower case.
    """
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    total, positive = marked.agg(F.count("*"), F.sum("label")).first()
    share = min(max(positive / total if total else 0.5, 1e-6), 1 - 1e-6)
    sample = smallest_hashes(marked, "id", per_class, "label", {1: positive or 0, 0: total - (positive or 0)})
    # At most 2 * per_class rows of two numbers each are sent to the tasks.
    texts = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")).join(F.broadcast(sample), "id").select("label", "body"), "toxicity-sample")
    n, toxic = texts.agg(F.count("*"), F.sum("label")).first()
    if not n or toxic in (0, n):
        return ToxicityModel({}, math.log(share / (1 - share)))
    columns = chosen_features(_features(texts), (n, toxic))
    found = _in_columns(texts, columns, others_of(identity_terms), swaps_per_doc).toArrow()
    y = found.column("label").to_numpy().astype(np.float64)
    bits = np.frombuffer(b"".join(found.column("bits").to_pylist()), np.uint8).reshape(n, -1)
    cells = [np.flatnonzero(np.unpackbits(row, count=len(columns))) for row in bits]
    rows, cols = np.repeat(np.arange(n), [len(c) for c in cells]), np.concatenate(cells)
    lost, won = (_swap_cells(b"".join(found.column(name).to_pylist())) for name in ("lost", "won"))
    m = sum(raw.count(b"\xff\xff\xff\xff") for raw in found.column("lost").to_pylist())
    del bits, cells, found
    weights, bias = fit_weights(rows, cols, len(columns), y, lost, won, m, fairness)
    bias += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))  # the sample's share is not the corpus's
    used = weights != 0
    return ToxicityModel(dict(zip(columns[used].tolist(), weights[used].tolist())), float(bias))


def scored(docs: DataFrame, model: ToxicityModel, score_col: str, text_col: str = "text") -> DataFrame:
    """The frame with a score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = shared.value.scorer()
        for batch in texts:
            yield pa.array([scorer(t.as_py()) for t in batch], pa.float64())

    score.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(score_col, F.arrow_udf(score, "double")(F.col(text_col)))
