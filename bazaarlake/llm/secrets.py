"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Two first-order models over ASCII characters are counted from labelled samples: random strings are the
secrets that the fixed patterns find, ordinary identifiers are all words, long ones too, of documents without such a
secret, also in capitals, and the short list ORDINARY_SAMPLES of names, paths, dates and separators.  The random model
is mixed with the uniform one, the ordinary model with the frequencies of single characters, in shares that are fixed
once characters are seen often, so that more documents do not shift the two against each other.  A long unbroken token is reported when the log-likelihood ratio of the two models,
summed over its pairs of characters, is above a threshold and, so that long tokens do not pass by their length alone,
its mean per pair is above another; when it has not the shape of a UUID; and when it overlaps nothing the patterns found.

Everything is built-in Spark functions: the scan is one projection without a shuffle, the model a table
of 128 x 128 ratios in the plan.  Training counts all documents: words first, so that a word's pairs are
formed once however often it occurs; it brings at most 2 x 128 x 128 counts to the driver.

Positions are code points, from 0, the end exclusive.  Defined cases: a null text is an empty one; very
long texts are scanned whole; without labelled samples all ratios are 0 and nothing is added; rows with
equal ids or repeated whole are scanned one by one; an empty table gives no rows.  Other columns are kept
by `scanned` and `masked`, whatever their names, unless they have the name asked for.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import free_name

# The patterns, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_VALUE_CHARS = 8

TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ORDINARY_WORD = r"[A-Za-z0-9+/_=-]{6,}"
UUID = r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
THRESHOLD = 20.0
MEAN_THRESHOLD = 1.5
#: Share of the uniform model in the random one, and least share of single characters in the ordinary one.
UNIFORM_SHARE, SINGLE_SHARE = 0.5, 0.03
#: Characters seen less often than about this many times lean on the frequencies of single characters.
SEEN_OFTEN = 200
#: Share of ORDINARY_SAMPLES in the counts of the ordinary model.
SAMPLES_SHARE = 0.01
CODES = 128
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Labelled as ordinary: what texts of plain words hold too seldom.
ORDINARY_SAMPLES = (
    "getUserAccountById", "parseHttpResponseHeaders", "AbstractConnectionPoolManager", "maxRetryAttemptCount", "setDefaultLocaleProvider",
    "user_account_created_at", "max_connections_per_host", "DEFAULT_BUFFER_SIZE_BYTES", "HTTP_STATUS_NOT_FOUND", "is_valid_session_identifier",
    "content-security-policy", "background-color-transition", "application/octet-stream", "well-known/configuration",
    "/usr/local/share/applications", "src/main/java/org/example/service", "home/user/documents/report_final", "lib/python/site-packages/module/__init__",
    "2024-01-31/daily-summary-report", "release-2023-11-04", "version_10_2_build_4571", "2020-12-31_23-59-59", "123456789012345678901234567890",
    "----------------", "================", "________________", "++++++++++++++++", "////////////////", "=-=-=-=-=-=-=-=-",
    "xxxxxxxxxxxxxxxx", "0000000000000000", "AAAAAAAAAAAAAAAA", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
)
_SPAN = "array<struct<start: int, kind: int, end: int>>"
MASK = "[SECRET]"


def _found(text: Column, pattern: str, kind: int, value_group: int | None = None, worth: Column | None = None) -> Column:
    """Spans of all matches: the gaps between them and the matches, added up from the left."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else matches
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))
    empty = F.from_json(F.lit("[]"), _SPAN)

    def step(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["match"]), F.lit(0))
        long_enough = F.length(piece["value"]) >= (ASSIGN_VALUE_CHARS if value_group else 1)
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.coalesce(long_enough, F.lit(False)), F.array_append(done["spans"], span))
                        .otherwise(done["spans"]).alias("spans"))

    spans = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda done: done["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans (start, kind, end) of the fixed patterns, by start and then kind."""
    return F.array_sort(F.concat(_found(text, ASSIGN, 0, 2), _found(text, ACCESS, 1), _found(text, HEX, 2)))


def _pair_counts(words: DataFrame) -> DataFrame:
    """Rows random, a, b, n from rows random, word, n."""
    place = F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("i")
    pairs = words.where(F.length("word") > 1).select("random", "word", "n", place).select(
        "random", "n", F.ascii(F.expr("substring(word, i, 1)")).alias("a"), F.ascii(F.expr("substring(word, i + 1, 1)")).alias("b"))
    return pairs.groupBy("random", "a", "b").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", samples: Sequence[str] = ORDINARY_SAMPLES) -> list[float]:
    """The log-likelihood ratio of each pair of character codes, at a * CODES + b."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    secrets = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda x: F.length(x) >= ASSIGN_VALUE_CHARS),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    marked = texts.select(secrets.alias("secrets"), "text")
    random = F.size("secrets") > 0
    ordinary = F.regexp_extract_all("text", F.lit(ORDINARY_WORD), F.lit(0))
    words = marked.select(random.alias("random"), F.explode(F.when(random, F.col("secrets")).otherwise(ordinary)).alias("word"))
    words = words.groupBy("random", "word").agg(F.count("*").alias("n"))
    counts = {True: {}, False: {}}
    for row in _pair_counts(words).collect():
        counts[row["random"]][row["a"], row["b"]] = row["n"]
    return log_ratios(counts[True], counts[False], samples)


def log_ratios(random: dict, ordinary: dict, samples: Sequence[str] = ORDINARY_SAMPLES) -> list[float]:
    """The ratios from the counts {(a, b): n} of both classes; all 0 where one of them has none."""
    if not random or not ordinary:
        return [0.0] * (CODES * CODES)
    known = Counter(ordinary)
    for (a, b), n in ordinary.items():  # the same words in capitals
        if chr(a).islower() and chr(b).islower():
            known[a - 32, b - 32] += n
    listed = Counter((ord(a), ord(b)) for word in samples for a, b in zip(word, word[1:]))
    weight = SAMPLES_SHARE / (1 - SAMPLES_SHARE) * sum(known.values()) / max(1, sum(listed.values()))
    for pair, n in listed.items():
        known[pair] += n * weight
    alphabet = sorted({ord(c) for c in ALPHABET} | {c for pair in (*random, *known) for c in pair})

    def chances(pairs: dict, least_share: float, single: dict) -> dict:
        after = Counter()
        for (a, _), n in pairs.items():
            after[a] += n
        share = {a: max(least_share, SEEN_OFTEN / (SEEN_OFTEN + after[a])) for a in alphabet}
        return {(a, b): (1 - share[a]) * pairs.get((a, b), 0) / max(after[a], 1) + share[a] * single[b] for a in alphabet for b in alphabet}

    second = Counter()
    for (_, b), n in known.items():
        second[b] += n
    everything = sum(second.values()) + len(alphabet)
    of_random = chances(random, UNIFORM_SHARE, dict.fromkeys(alphabet, 1 / len(alphabet)))
    of_ordinary = chances(known, SINGLE_SHARE, {b: (second[b] + 1) / everything for b in alphabet})
    ratios = [0.0] * (CODES * CODES)
    for a, b in of_random:
        if a < CODES and b < CODES:
            ratios[a * CODES + b] = round(math.log(of_random[a, b] / of_ordinary[a, b]), 4)
    return ratios


def _ratio(token: Column, ratios: list[float]) -> Column:
    # One string that the optimizer turns into one constant array.
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    code = lambda i: F.ascii(F.substring(token, i, F.lit(1)))
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0),
                       lambda total, i: total + F.element_at(table, code(i) * CODES + code(i + 1) + 1))


def looks_random(token: Column, ratios: list[float], threshold: float = THRESHOLD, mean: float = MEAN_THRESHOLD) -> Column:
    """Is the ratio of the token high, as a sum and for its length, and is it no UUID?"""
    return ~token.rlike(UUID) & (_ratio(token, ratios) > F.greatest(F.lit(threshold), (F.length(token) - 1) * F.lit(mean)))


def markov_spans(text: Column, base: Column, ratios: list[float], threshold: float = THRESHOLD) -> Column:
    """Spans of tokens that look random and overlap no base span."""
    found = _found(text, TOKEN, 3)
    free = lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    token = lambda x: F.substring(text, x["start"] + 1, x["end"] - x["start"])
    return F.filter(found, lambda x: free(x) & looks_random(token(x), ratios, threshold))


def scanned(docs: DataFrame, ratios: list[float], base_col: str = "base", spans_col: str = "spans", text_col: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """The frame with two arrays of structs (start, kind, end): what the patterns find, and all spans; kind numbers KINDS."""
    text = free_name(docs, "__text")
    held = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit(""))).withColumn(base_col, base_spans(F.col(text)))
    more = markov_spans(F.col(text), F.col(base_col), ratios, threshold)
    return held.withColumn(spans_col, F.array_sort(F.concat(F.col(base_col), more))).drop(text)


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with each run of overlapping spans replaced by the mask."""

    def step(done: Column, x: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, F.greatest(x["start"] - done["at"], F.lit(0)))
        return F.struct(F.greatest(done["at"], x["end"]).alias("at"),
                        F.when(x["start"] >= done["at"], F.concat(done["out"], gap, F.lit(mask))).otherwise(done["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, clean).otherwise(text)
