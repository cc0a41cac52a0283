"""Document quality from its lines: a linear-chain conditional random field labels each line good or bad.

A line's features are bins of its measures (length, words, capitals, digits, symbols, repeated words, ...),
and the bins of the line before and the line after it.  The score of a labelling is the sum of the feature weights of
its good lines and of a weight for each two labels in a row.  Forward and backward sums give each line's
probability of being good; a document's quality is their mean, weighted by the lines' lengths, as a
probability by a logistic curve fitted last.

Lines have no labels of their own.  All lines of a document labelled good are taken as good; of one labelled
bad at least one line is bad, whichever: its likelihood is 1 - P(all lines good).  Both have the gradient
c * (features if all lines were good - expected features), with c = 1 or c = -P / (1 - P).

Fitting works on a bounded sample: `per_class` documents of each label, those of the smallest hash of the id, and of
each at most `sample_lines` lines in a row.  Only bins are brought together, a byte for each line and measure.
Scoring runs over all lines of all documents in Arrow batches.

Defined cases: a null text is an empty one, which has one empty line; where all lines are empty their plain mean
counts; rows with equal ids or repeated whole are scored alike; a very long text or line is scored whole; labels
that are null or have no document are not used, of several labels of an id each counts; where a label is
missing from the sample all scores are the share of good labels (0.5 of none); empty tables give no rows.  Only id
and text of the documents are read, whatever else they hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import terms as packed
from bazaarlake.llm.common import smallest_hashes

PER_CLASS = 3000
SAMPLE_LINES = 200
STEPS = 150
RATE = 0.15
DECAY = 0.02
#: Of a bad document that looks wholly good: the largest weight of its gradient.
MOST_PULL = 20.0
SLICE_BYTES = 4 << 20
SLICE_DOCS = 1 << 14

BINS = 16
MEASURES = ("bytes", "words", "letters", "capitals", "digits", "symbols", "exclamations", "marks", "accents",
            "word length", "same word again", "repeated words", "line seen before", "ends", "begins")
#: Upper ends of the bins of shares.
_SHARES = np.array([0, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.55, 0.7, 0.85, 1.0])

_SPACE = packed.member_bytes((0x09, 0x0D), (0x20, 0x20))
_UPPER, _LOWER, _DIGIT = packed.member_bytes((0x41, 0x5A)), packed.member_bytes((0x61, 0x7A)), packed.member_bytes((0x30, 0x39))
_HIGH = packed.member_bytes((0x80, 0xFF))


def _bytes_in(marks: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(marks)] = True
    return table


_SYMBOL, _EXCLAIM, _MARK = _bytes_in(b"#*$%&|<>@^~=_\\{}[]+"), _bytes_in(b"!?"), _bytes_in(b".,;:'\"()-")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeats(*keys: np.ndarray) -> np.ndarray:
    """Marks every entry that equals an earlier one."""
    order = np.lexsort(keys[::-1])
    again = np.zeros(len(order), bool)
    if len(order):
        same = np.ones(len(order) - 1, bool)
        for key in keys:
            same &= key[order][1:] == key[order][:-1]
        again[order[1:][same]] = True
    return again


def line_bins(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts as bytes: the bins of each line (a row of MEASURES), its length, and where each text's lines begin."""
    n_texts = len(ends) - 1
    breaks = np.flatnonzero(data == 0x0A)
    # Lines begin at each text's start and after each break.
    text_of_break = np.searchsorted(ends, breaks, "right") - 1
    first_line = np.concatenate([[0], np.cumsum(1 + np.bincount(text_of_break, minlength=n_texts))]) if n_texts else np.zeros(1, np.int64)
    n = int(first_line[-1])
    start, stop = np.empty(n, np.int64), np.empty(n, np.int64)
    starts_text = np.zeros(n, bool)
    starts_text[first_line[:-1]] = True
    start[starts_text] = ends[:-1]
    start[~starts_text] = breaks + 1
    last_of_text = np.zeros(n, bool)
    last_of_text[first_line[1:] - 1] = True
    stop[last_of_text] = ends[1:]
    stop[~last_of_text] = breaks
    size = stop - start

    def count(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        return total[stop] - total[start]

    upper, lower, high = count(_UPPER), count(_LOWER), count(_HIGH)
    inside = ~_SPACE[data]
    before = np.ones(len(data), bool)
    before[1:] = ~inside[:-1]
    before[ends[:-1][ends[:-1] < len(data)]] = True
    after = np.ones(len(data), bool)
    after[:-1] = before[1:] | ~inside[1:]
    word_start, word_stop = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    line = np.searchsorted(start, word_start, "right") - 1
    words = np.bincount(line, minlength=n)
    pairs = _pair_sums(data)
    line_code = _code_of(data, pairs, start, size)
    word_code = _code_of(data, pairs, word_start, word_stop - word_start)
    same = np.zeros(len(line), bool)
    same[1:] = (word_code[1:] == word_code[:-1]) & (line[1:] == line[:-1])
    again = _repeats(line, word_code)
    text_of_line = np.repeat(np.arange(n_texts), np.diff(first_line))
    seen_before = _repeats(text_of_line, line_code) & (words > 0)

    share = lambda a, b: np.searchsorted(_SHARES, np.minimum(a / np.maximum(b, 1), 1.0))
    bits = lambda x: np.minimum(np.frexp(x.astype(np.float64))[1], BINS - 1)
    lone = np.maximum(stop - 1, 0)
    last, first = (data[np.minimum(x, max(len(data) - 1, 0))] if len(data) else np.zeros(n, np.uint8) for x in (lone, start))
    kind = lambda b: np.where(size == 0, 0, np.select([_UPPER[b], _LOWER[b], _DIGIT[b], _SYMBOL[b], _EXCLAIM[b], _MARK[b], _HIGH[b]], range(1, 8), 8))
    bins = np.stack([
        bits(size), bits(words), share(upper + lower + high, size), share(upper, upper + lower), share(count(_DIGIT), size), share(count(_SYMBOL), size),
        share(count(_EXCLAIM), size), share(count(_MARK), size), share(high, size), np.minimum(size // np.maximum(words, 1), BINS - 1),
        share(np.bincount(line[same], minlength=n), words), share(np.bincount(line[again], minlength=n), words), seen_before.astype(np.int64),
        kind(last), kind(first)], axis=1).astype(np.uint8) if n else np.empty((0, len(MEASURES)), np.uint8)
    return bins, size, first_line


def _pair_sums(data: np.ndarray) -> np.ndarray:
    """Running sums, modulo 2^64, of a mixed number for each byte with the next."""
    sums = np.zeros(len(data) + 1, np.uint64)
    if len(data):
        pairs = _mixed(np.arange(1, 65537, dtype=np.uint64))[data.astype(np.intp) * 256 + np.append(data[1:], 0)]
        sums[1:] = np.cumsum(pairs, dtype=np.uint64)
    return sums


def _code_of(data: np.ndarray, pairs: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit code of each byte range, equal for equal ranges: of its pairs of bytes, its first and last byte and its size."""
    if not len(data):
        return np.zeros(len(start), np.uint64)
    last = np.maximum(start + size - 1, 0)
    inner = np.where(size > 1, pairs[last] - pairs[np.minimum(start, last)], np.uint64(0))
    ends = data[np.minimum(start, len(data) - 1)].astype(np.uint64) * np.uint64(256) + data[last]
    return _mixed(inner + _mixed(np.where(size > 0, ends, np.uint64(0)) + _mixed(size.astype(np.uint64))))


@dataclass
class Chains:
    """Sequences of lines, the longest first, so that those with a line t are the first `active[t]`."""

    begins: np.ndarray
    sizes: np.ndarray
    active: np.ndarray

    @staticmethod
    def of(first_line: np.ndarray) -> tuple["Chains", np.ndarray]:
        sizes = np.diff(first_line)
        order = np.argsort(-sizes, kind="stable")
        ordered = sizes[order]
        active = np.searchsorted(-ordered, -np.arange(1, (ordered[0] if len(ordered) else 0) + 1), "right")
        return Chains(first_line[:-1][order], ordered, active), order


@dataclass
class LineField:
    """weights[side][measure][bin] for a good line (side: own, before, after), steps[label][next label], scale and shift
    of a document's quality."""

    weights: np.ndarray
    steps: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def emissions(self, bins: np.ndarray, first_line: np.ndarray) -> np.ndarray:
        """The score that each line adds where it is good."""
        places = np.arange(len(MEASURES))
        total = lambda side: self.weights[side][places, bins].sum(axis=1)
        out, before, after = total(0), total(1), total(2)
        inner = np.ones(len(bins), bool)
        inner[first_line[:-1]] = False  # lines with one before them in their text
        follows = np.flatnonzero(inner)
        out[follows] += before[follows - 1]
        out[follows - 1] += after[follows]
        return out

    def odds(self, emission: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of good against bad of each line, by the lines up to it and by those after it; their sum is that of its marginal."""
        (bad_bad, bad_good), (good_bad, good_good) = self.steps
        ahead, behind = emission.copy(), np.zeros(len(emission))
        for t in range(1, len(chains.active)):
            at = chains.begins[:chains.active[t]] + t
            x = ahead[at - 1]
            ahead[at] += np.logaddexp(good_good + x, bad_good) - np.logaddexp(good_bad + x, bad_bad)
        for t in range(len(chains.active) - 2, -1, -1):
            at = chains.begins[:chains.active[t + 1]] + t
            x = behind[at + 1] + emission[at + 1]
            behind[at] = np.logaddexp(good_good + x, good_bad) - np.logaddexp(bad_good + x, bad_bad)
        return ahead, behind

    def quality(self, bins: np.ndarray, size: np.ndarray, first_line: np.ndarray) -> np.ndarray:
        """The mean probability of a text's lines to be good, weighted by their lengths."""
        chains, _ = Chains.of(first_line)
        ahead, behind = self.odds(self.emissions(bins, first_line), chains)
        good = _sigmoid(ahead + behind)
        text = np.repeat(np.arange(len(first_line) - 1), np.diff(first_line))
        total = np.bincount(text, size, len(first_line) - 1)
        weight = np.where(total[text] > 0, size, 1)
        return np.bincount(text, good * weight, len(first_line) - 1) / np.bincount(text, weight, len(first_line) - 1)

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(ends) < 2:
            return np.empty(0)
        return _sigmoid(self.scale * _logit(self.quality(*line_bins(data, ends))) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def slopes(field: LineField, bins: np.ndarray, first_line: np.ndarray, good: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log-likelihood of the labelled documents, and its gradients by weights and steps."""
    chains, order = Chains.of(first_line)
    emission = field.emissions(bins, first_line)
    ahead, behind = field.odds(emission, chains)
    marginal = _sigmoid(ahead + behind)
    (bad_bad, bad_good), (good_bad, good_good) = field.steps
    # P(all good) = P(first line good) * the product of P(next good | good), from the chances of each line after a good one.
    n = len(first_line) - 1
    text = np.repeat(np.arange(n), np.diff(first_line))
    inner = np.ones(len(bins), bool)
    inner[first_line[:-1]] = False
    at = np.flatnonzero(inner)
    onward = emission[at] + behind[at]
    stays = -np.logaddexp(0, good_bad - good_good - onward)  # log P(good | line before is good)
    log_all = np.bincount(text[at], stays, n) - np.logaddexp(0, -(ahead + behind)[first_line[:-1]])
    all_good = np.exp(np.minimum(log_all, -1e-12))
    likelihood = np.where(good, log_all, np.log1p(-np.minimum(all_good, 1 - 1e-12)))
    pull = np.where(good, 1.0, -np.minimum(all_good / np.maximum(1 - all_good, 1e-12), MOST_PULL)) / n
    missing = (1 - marginal) * pull[text]
    by_weight = np.zeros_like(field.weights)
    cells = len(MEASURES) * BINS
    place = bins + np.arange(len(MEASURES)) * BINS
    by_weight[0] = np.bincount(place.ravel(), np.repeat(missing, len(MEASURES)), cells).reshape(len(MEASURES), BINS)
    by_weight[1] = np.bincount(place[at - 1].ravel(), np.repeat(missing[at], len(MEASURES)), cells).reshape(len(MEASURES), BINS)
    by_weight[2] = np.bincount(place[at].ravel(), np.repeat(missing[at - 1], len(MEASURES)), cells).reshape(len(MEASURES), BINS)
    # Chances of two labels in a row: the first label's marginal times the chance of the next after it.
    after_good, after_bad = _sigmoid(onward + good_good - good_bad), _sigmoid(onward + bad_good - bad_bad)
    was_good = marginal[at - 1]
    pair = pull[text[at]]
    by_step = np.array([[-(pair * (1 - was_good) * (1 - after_bad)).sum(), -(pair * (1 - was_good) * after_bad).sum()],
                        [-(pair * was_good * (1 - after_good)).sum(), (pair * (1 - was_good * after_good)).sum()]])
    return float(likelihood.mean()), by_weight, by_step


def train(bins: np.ndarray, size: np.ndarray, first_line: np.ndarray, good: np.ndarray, share: float, steps: int = STEPS, rate: float = RATE,
          decay: float = DECAY) -> LineField:
    """From labelled documents with both labels; share: of good ones among all labelled."""
    field = LineField(np.zeros((3, len(MEASURES), BINS)), np.zeros((2, 2)))
    field.weights[0] += 2.0 / len(MEASURES)  # lines are good before anything is known
    params = (field.weights, field.steps)
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        _, *found = slopes(field, bins, first_line, good)
        for p, g, a, b in zip(params, found, first, second):
            g = g - decay / len(good) * p
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    x = _logit(field.quality(bins, size, first_line))
    y = good.astype(np.float64)
    weight = np.where(good, share / y.mean(), (1 - share) / (1 - y.mean()))
    field.scale, field.shift = _logistic(x, y, weight)
    return field


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (0 or more) and shift of the logistic curve of y by x, by Newton's steps with a small penalty on the slope."""
    scale, shift = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(scale * x + shift)
        error, curve = weight * (y - p), weight * p * (1 - p) + 1e-9
        g = np.array([(error * x).sum() - scale, error.sum()])
        h = np.array([[(curve * x * x).sum() + 1, (curve * x).sum()], [(curve * x).sum(), curve.sum()]])
        move = np.linalg.solve(h, g)
        scale, shift = scale + float(np.clip(move[0], -1, 1)), shift + float(np.clip(move[1], -2, 2))
    return max(scale, 0.0), shift


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_class: int = PER_CLASS, sample_lines: int = SAMPLE_LINES) -> LineField:
    """From the labelled documents given; the caller leaves out those that it holds back."""
    marked = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    total, positive = marked.agg(F.count("*"), F.sum("label")).first()
    share = min(max(positive / total if total else 0.5, 1e-6), 1 - 1e-6)
    # 2 * per_class rows of two numbers are sent to the tasks.
    sample = smallest_hashes(marked, "id", per_class, "label", {1: positive or 0, 0: total - (positive or 0)})

    def bins_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in packed.slices(batches, 1, SLICE_BYTES, SLICE_DOCS):
            bins, size, first = line_bins(*packed.text_bytes(rows.column(1)))
            out = ([], [])
            for a, b in zip(first[:-1], first[1:]):
                at = a + (b - a) // 2 - min(sample_lines // 2, (b - a) // 2)
                some = slice(at, min(at + sample_lines, b))
                out[0].append(bins[some].tobytes())
                out[1].append(size[some].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(x, pa.binary()) for x in out)], names=["label", "bins", "sizes"])

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body")).join(F.broadcast(sample), "id")
    rows = texts.select("label", "body").mapInArrow(bins_of, "label int, bins binary, sizes binary").toArrow()
    good = rows.column("label").to_numpy() == 1
    if not len(good) or good.all() or not good.any():
        return LineField(np.zeros((3, len(MEASURES), BINS)), np.zeros((2, 2)), 0.0, math.log(share / (1 - share)))
    raw = sorted(zip(good.tolist(), rows.column("bins").to_pylist(), rows.column("sizes").to_pylist()))
    bins = np.frombuffer(b"".join(r[1] for r in raw), np.uint8).reshape(-1, len(MEASURES))
    size = np.frombuffer(b"".join(r[2] for r in raw), "<i8")
    first_line = np.concatenate([[0], np.cumsum([len(r[2]) // 8 for r in raw])])
    return train(bins, size, first_line, np.array([r[0] for r in raw]), share)


def scored(docs: DataFrame, field: LineField, score_col: str = "score", text_col: str = "text") -> DataFrame:
    """The frame with the quality of each whole text, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            rows = pa.RecordBatch.from_arrays([batch], names=["text"])
            found = [shared.value.scores(*packed.text_bytes(some.column(0))) for some in packed.slices(iter([rows]), 0, SLICE_BYTES, SLICE_DOCS)]
            yield pa.array(np.concatenate(found) if found else np.empty(0), pa.float64())

    score.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(score_col, F.arrow_udf(score, "double")(F.col(text_col)))
