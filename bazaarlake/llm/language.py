"""Language identification by a convolutional network over bytes, trained here in numpy.

A window is a fixed number of lower-cased UTF-8 bytes, the last one of a text padded with zeros.
Filters of several widths slide over it; a filter is a table of a weight per byte for each of its
positions (a convolution over one-hot bytes).  Each filter keeps its largest response in the window;
a rectifier and a softmax layer turn those into a probability per language.  A text gets the mean over
all its windows, weighted by their bytes.

Training: at most `per_lang` windows of each language, cut at a hash-given place of the texts with the
smallest hashes; gradients flow through the largest response only, so a step touches a few table rows.
For use, the tables of a filter's neighbouring positions are added up per pair of bytes: two look-ups
per position serve all filters.

Defined cases: `und` with score 0 for a null text or one without a letter; a null language is not
learned from; with no language to learn every text is `und`; with one, it is that one; rows with
equal ids or repeated whole get the same answer; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
WINDOW_BYTES = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
PER_LANG = 600
EPOCHS = 24
BATCH = 64
WINDOWS_AT_ONCE = 32
_HASHES = 1 << 40
_LETTER = regex.compile(r"\p{L}")


def windows_of(raw: bytes, width: int = WINDOW_BYTES) -> np.ndarray:
    """All bytes of a text as rows of one width."""
    return np.frombuffer(raw.ljust(-(-max(len(raw), 1) // width) * width, b"\0"), np.uint8).reshape(-1, width)


@dataclass
class ByteNetwork:
    """tables[i][o][b]: weights of the filters of width WIDTHS[i] for byte b at their position o."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def paired(self) -> tuple[np.ndarray, np.ndarray]:
        """Per pair of bytes: what positions 0 and 1 add to each filter, and what positions 2 and 3 add."""
        two, three, four = self.tables
        pair = lambda t, o: (t[o][:, None, :] + t[o + 1][None, :, :]).reshape(65536, -1)
        head = np.concatenate([pair(two, 0), pair(three, 0), pair(four, 0)], axis=1)
        tail = np.concatenate([np.repeat(three[2], 256, axis=0), pair(four, 2)], axis=1)
        return np.ascontiguousarray(head, np.float32), np.ascontiguousarray(tail, np.float32)

    def probabilities(self, windows: np.ndarray, paired: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        head, tail = paired
        first = self.tables[0].shape[2]
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), WINDOWS_AT_ONCE):
            block = windows[at:at + WINDOWS_AT_ONCE].astype(np.intp)
            pairs = block[:, :-1] * 256 + block[:, 1:]
            response = head.take(pairs[:, :-2], axis=0)
            response[:, :, first:] += tail.take(pairs[:, 2:], axis=0)
            pooled = np.maximum(response.max(axis=1) + self.bias, 0)
            logits = pooled @ self.dense + self.dense_bias
            logits = np.exp(logits - logits.max(axis=1, keepdims=True))
            out[at:at + WINDOWS_AT_ONCE] = logits / logits.sum(axis=1, keepdims=True)
        return out


def train(windows: list[bytes], labels: np.ndarray, languages: list[str], filters: int = FILTERS, epochs: int = EPOCHS,
          rate: float = 0.02, decay: float = 1e-5, seed: int = 7) -> ByteNetwork:
    """Adam on shuffled batches; each epoch sees another crop of each window, short ones among them."""
    rng = np.random.default_rng(seed)
    n, classes = len(windows), len(languages)
    params = [rng.normal(0, 0.1, (w, 256, filters)) for w in WIDTHS]
    params += [np.zeros(filters * len(WIDTHS)), rng.normal(0, 0.2, (filters * len(WIDTHS), classes)), np.zeros(classes)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            members = order[at:at + BATCH]
            crops = []
            for i in members:
                size = int(rng.integers(12, WINDOW_BYTES + 1))
                start = int(rng.integers(0, max(len(windows[i]) - size, 0) + 1))
                crops.append(windows_of(windows[i][start:start + size])[0])
            x, y, rows = np.array(crops, np.intp), labels[members], np.arange(len(members))
            places, pooled = [], []
            for w, table in zip(WIDTHS, params):
                span = WINDOW_BYTES - WIDTHS[-1] + 1
                response = sum(table[o][x[:, o:o + span]] for o in range(w))
                places.append(response.argmax(axis=1))
                pooled.append(response.max(axis=1))
            hidden = np.concatenate(pooled, axis=1) + params[-3]
            active = np.maximum(hidden, 0)
            logits = active @ params[-2] + params[-1]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[rows, y] -= 1
            p /= len(members)
            back = (p @ params[-2].T) * (hidden > 0)
            slopes = []
            for k, (w, table) in enumerate(zip(WIDTHS, params)):
                slope, own = np.zeros_like(table), back[:, k * filters:(k + 1) * filters]
                for o in range(w):
                    np.add.at(slope[o], (x[rows[:, None], places[k] + o], np.arange(filters)[None, :]), own)
                slopes.append(slope)
            slopes += [back.sum(axis=0), active.T @ p, p.sum(axis=0)]
            steps += 1
            for q, g, a, b in zip(params, slopes, first, second):
                g = g + decay * q
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                q -= rate * (a / (1 - 0.9 ** steps)) / (np.sqrt(b / (1 - 0.999 ** steps)) + 1e-8)
    tables = [p.astype(np.float32) for p in params[:len(WIDTHS)]]
    return ByteNetwork(languages, tables, *(p.astype(np.float32) for p in params[len(WIDTHS):]))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_lang: int = PER_LANG) -> ByteNetwork | None:
    """From the documents given; the caller leaves out those that it holds back.  None where no language is marked."""
    body = F.col(text_col)
    picked = F.xxhash64(F.col(id_col), F.lit("window"))
    room = F.greatest(F.length(body) - WINDOW_BYTES, F.lit(0)) + 1
    windows = docs.where(F.col(lang_col).isNotNull() & body.rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), picked.alias("picked"),
        F.lower(F.substring(body, (F.pmod(picked, room) + 1).cast("int"), F.lit(WINDOW_BYTES))).alias("body"))
    sizes = {r[0]: r[1] for r in windows.groupBy("lang").agg(F.count("*")).collect()}  # a row per language
    # Of a frequent language only a share, by hash, enters the window, so its task stays small.
    share = F.lit(0)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(_HASHES, 2 * per_lang * _HASHES // size))).otherwise(share)
    some = windows.where(F.pmod(F.col("picked"), F.lit(_HASHES)) < share) if sizes else windows
    order = Window.partitionBy("lang").orderBy(F.pmod(F.col("picked"), F.lit(_HASHES)), "body")
    rows = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang).select("lang", "body").collect()
    if not rows:
        return None
    rows.sort()
    languages = sorted({r[0] for r in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    return train([r[1].encode("utf-8", "surrogatepass") for r in rows], np.array([number[r[0]] for r in rows]), languages)


def identified(docs: DataFrame, network: ByteNetwork | None, lang_col: str = "lang_pred", score_col: str = "score",
               text_col: str = "text") -> DataFrame:
    """The frame with the likeliest language of each whole text and its probability."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = shared.value
        paired = net.paired() if net else None
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                if net is None or not text or not _LETTER.search(text):
                    out.append({"lang": UNKNOWN, "score": 0.0})
                    continue
                raw = text.lower().encode("utf-8", "surrogatepass")
                windows = windows_of(raw)
                weight = np.full(len(windows), WINDOW_BYTES, np.float64)
                weight[-1] -= len(windows) * WINDOW_BYTES - len(raw)
                mean = np.average(net.probabilities(windows, paired), axis=0, weights=weight)
                best = int(mean.argmax())
                out.append({"lang": net.languages[best], "score": float(min(mean[best], 1.0))})
            yield pa.array(out, kind)

    identify.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found = F.arrow_udf(identify, "lang string, score double")(F.col(text_col))
    return docs.withColumn(lang_col, found).withColumn(score_col, F.col(lang_col)["score"]).withColumn(lang_col, F.col(lang_col)["lang"])
