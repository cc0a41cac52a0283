"""Line field, lexical search, divergence audit: against enumeration, SQL and brute force."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from check_queries import compare, duck

from bazaarlake.llm import divergence, lexical, line_crf, terms
from bazaarlake.llm.queries import ORACLE_SQL, QUERIES

from .conftest import EDGE_TEXTS, SF, labels_of

LETTER_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
WORD_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def odd_texts(n, seed):
    r = random.Random(seed)
    words = ["a", "Ab", "abcdefgh", "abcdefghi", "É" * 4, "É" * 5, "x" * 16, "x" * 17, "y" * 40, "中文" * 9, "😀", "7up", "_", "z" * 300]
    return ["".join(r.choice(words) + r.choice([" ", "-", "", "\n", "\x00", "1"]) for _ in range(r.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("members,pattern", [(terms.LETTERS, LETTER_TERM), (terms.LETTERS_AND_DIGITS, WORD_TERM)])
def test_terms_and_their_counts_are_those_of_the_pattern(members, pattern):
    texts = [None, "", *odd_texts(200, 1), ""]
    found = terms.terms_of(*terms.text_bytes(pa.array(texts).slice(1)), members)
    plain = [(i, t) for i, text in enumerate(texts[1:]) for t in pattern.findall(lowered(text))]
    assert list(zip(found.text.tolist(), found.strings(np.arange(len(found.start))).to_pylist())) == plain
    part = found.text % 3
    got = Counter()
    for which, fresh in terms.grouped(found, part):
        begins = np.flatnonzero(fresh)
        for first, n in zip(which[begins], np.diff(np.append(begins, len(which)))):
            got[int(part[first]), found.strings(np.array([first]))[0].as_py()] += int(n)
    assert got == Counter((i % 3, t) for i, t in plain)


def test_slices_keep_all_rows_within_their_limits():
    texts = ["x" * n for n in (3, 0, 5, 50, 1, 1, 1, 1, 9)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[a:b], pa.string())], names=["t"]) for a, b in ((0, 2), (2, 2), (2, 7), (7, 9))]
    out = [s.column(0).to_pylist() for s in terms.slices(iter(batches), 0, 10, 3)]
    assert [t for s in out for t in s] == texts
    assert all(len(s) <= 3 and (len(s) == 1 or sum(map(len, s)) <= 10) for s in out)


@pytest.mark.parametrize("name", ["op12_nra_search", "op13_packed_divergence"])
def test_query_equals_its_statement(spark, name):
    assert compare(QUERIES[name](spark, SF).toPandas(), duck(SF).execute(ORACLE_SQL[name]).df()) == ""


def plain_search(docs, queries, top):
    split = [(i, WORD_TERM.findall(lowered(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    df = Counter(t for _, own in split for t in set(own))
    asked = {}
    for item, text in dict.fromkeys(queries):
        asked.setdefault(item, []).extend(WORD_TERM.findall(lowered(text)))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, own in split:
            m, tf = 75 + 25 * len(own) * n_docs // max(n_terms, 1), Counter(own)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in wanted if t in tf)
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("top,block_terms", [(3, 200_000), (20, 5)])
def test_search_is_that_of_brute_force(spark, monkeypatch, top, block_terms):
    monkeypatch.setattr(lexical, "SLICE_DOCS", 40)
    r = random.Random(top)
    words = [f"w{int(r.expovariate(0.15))}" for _ in range(400)] + ["Éa", "中文", "x" * 20, "123"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 25))) for _ in range(150)]
    docs = [(None if i == 7 else i, t) for i, t in enumerate(texts + texts[:20] + [None, "", "--"])] + [(3, texts[3])]
    queries = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 30)))) for i in range(12)]
    queries += [(20, None), (21, ""), (22, "unknown"), (None, "w0 w1 w1"), (0, queries[0][1]), (1, "w2 w3")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item string")
    qs = spark.createDataFrame(queries, "item_id int, text string")
    got = lexical.search(df, qs, top=top, block_terms=block_terms).collect()
    assert sorted((tuple(x) for x in got), key=repr) == plain_search(docs, queries, top)


def test_search_of_odd_rows(spark, edge, none):
    qs = spark.createDataFrame([(1, "word end"), (2, "repeated row text")], "item_id int, text string")
    got = sorted((tuple(x) for x in lexical.search(edge, qs).collect()), key=repr)
    docs = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    assert got == plain_search(docs, [tuple(x) for x in qs.collect()], 20)
    assert lexical.search(none, qs).count() == 0 and lexical.search(edge, qs.limit(0)).count() == 0


def plain_audit(rows, min_docs, top=10):
    rows = [(lang or "", source or "", LETTER_TERM.findall(lowered(text))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [(s, t) for l, s, t in rows if l == lang]
        df, all_n = Counter(x for _, t in own for x in set(t)), Counter(x for _, t in own for x in t)
        kept = sorted(x for x in df if df[x] >= min_docs)
        n = {s: Counter(x for s2, t in own if s2 == s for x in t if df[x] >= min_docs) for s in {s for s, _ in own}}
        p = lambda c, total: 1 + 10 ** 9 * (c + 2) // (total + 2 * len(kept))  # noqa: E731, B023
        f = lambda a, b: (a - b) ** 2 // (a + b)
        share = {s: [p(c[x], sum(c.values())) for x in kept] for s, c in n.items()}
        whole = [p(all_n[x], sum(all_n[y] for y in kept)) for x in kept]
        for s in n:
            pairs = sorted((-sum(map(f, share[s], share[o])), o.encode(), o) for o in n if o != s)
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(pairs, 1)]
            lead = sorted((-f(a, b), x.encode(), x) for x, a, b in zip(kept, share[s], whole) if n[s][x] and a > b)
            out += [(lang, s, "term", x, -v, i) for i, (v, _, x) in enumerate(lead[:top], 1)]
    return sorted(out)


def test_audit_is_that_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 2)
    monkeypatch.setattr(divergence, "CELLS_AT_ONCE", 3)
    r = random.Random(5)
    rows = [(r.choice(["en", None, "de", "zz"]), r.choice(["a", "b", None, "é"]), t) for t in odd_texts(160, 3)] + [("none", "a", ""), ("none", "b", None), ("one", "a", "x")]
    df = spark.createDataFrame([(*x, "y") for x in rows + rows[:5]], "lang string, source string, text string, term string")
    got = sorted(tuple(x) for x in divergence.Audit(df, min_docs=3).report().collect())
    assert got == plain_audit(rows + rows[:5], 3) and any(x[2] == "term" for x in got)


def test_audit_of_odd_rows(spark, edge, none):
    rows = [(x["lang"], x["source"], x["text"]) for x in edge.select("lang", "source", "text").collect()]
    assert sorted(tuple(x) for x in divergence.Audit(edge, min_docs=2).report().collect()) == plain_audit(rows, 2)
    assert divergence.Audit(none).report().count() == 0


def some_field(seed=1):
    rng = np.random.default_rng(seed)
    first = np.array([0, 1, 4, 10, 11, 20, 30])
    bins = rng.integers(0, line_crf.BINS, (30, len(line_crf.MEASURES))).astype(np.uint8)
    return line_crf.LineField(rng.normal(0, .3, (3, len(line_crf.MEASURES), line_crf.BINS)), rng.normal(0, .5, (2, 2))), bins, first


def test_marginals_are_those_of_all_labellings():
    field, bins, first = some_field()
    emission = field.emissions(bins, first)
    ahead, behind = field.odds(emission, line_crf.Chains.of(first)[0])
    for a, b in zip(first, first[1:]):
        weight, good = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=b - a):
            w = math.exp(sum(emission[a + i] for i, y in enumerate(labels) if y) + sum(field.steps[y, z] for y, z in zip(labels, labels[1:])))
            weight, good = weight + w, good + w * np.array(labels)
        assert np.allclose(good / weight, line_crf._sigmoid(ahead[a:b] + behind[a:b]))


def test_gradients_are_the_slopes_of_the_likelihood():
    field, bins, first = some_field()
    good = np.array([1, 0, 1, 0, 0, 1], bool)
    _, by_weight, by_step = line_crf.slopes(field, bins, first, good)
    rng, h = np.random.default_rng(2), 1e-5
    for params, slopes in ((field.weights, by_weight), (field.steps, by_step)):
        for _ in range(12):
            at = tuple(rng.integers(n) for n in params.shape)
            params[at] += h
            up = line_crf.slopes(field, bins, first, good)[0]
            params[at] -= 2 * h
            down = line_crf.slopes(field, bins, first, good)[0]
            params[at] += h
            assert abs((up - down) / 2 / h - slopes[at]) < 1e-7


def test_lines_and_their_measures():
    texts = ["one two two\nTHREE!!\n\none two two\none two one", "", "x\n", None, "a" * 5000]
    bins, size, first = line_crf.line_bins(*terms.text_bytes(pa.array(texts)))
    lines = [line for t in texts for line in (t or "").split("\n")]
    assert size.tolist() == [len(x.encode()) for x in lines] and np.diff(first).tolist() == [5, 1, 2, 1, 1]
    of = lambda name: bins[:, line_crf.MEASURES.index(name)].tolist()
    assert [x > 0 for x in of("line seen before")] == [False, False, False, True, False] + [False] * 5
    assert [x > 0 for x in of("same word again")] == [True, False, False, True] + [False] * 6
    assert [x > 0 for x in of("repeated words")] == [True, False, False, True, True] + [False] * 5
    assert of("capitals")[1] == 14 and of("capitals")[0] == 0 and of("exclamations")[1] > 0


def test_quality_of_held_out_documents(spark):
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = QUERIES["op11_line_crf_quality"](spark, "/root/testdata/sf0.01").join(marks, "doc_id").where("held_out").toPandas()
    good, bad = rows[rows.quality == 1].score.to_numpy(), rows[rows.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95 and (rows.predicted == rows.quality).mean() > 0.95


def test_quality_of_odd_rows(spark, edge, none):
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(8)] + [(8, None, None), (None, 1, 1), (999, 0, 1)])
    field = line_crf.fit(edge, labels)
    rows = line_crf.scored(edge, field, "found").collect()
    assert len(rows) == len(EDGE_TEXTS) + 1 and all(0 <= r["found"] <= 1 for r in rows)
    assert len({r["found"] for r in rows if r["text"] and "repeated" in r["text"]}) == 1
    assert line_crf.scored(none, field, "found").count() == 0
    half = line_crf.scored(edge, line_crf.fit(none, labels_of(spark, [])), "found").collect()
    assert {round(r["found"], 9) for r in half} == {0.5}
