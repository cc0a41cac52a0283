"""Near duplicates, nearest vectors, line dedup: against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlake.llm import line_dedup, neighbours, order_minhash
from bazaarlake.llm.queries import QUERIES

from .conftest import EDGE_TEXTS, SF


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(text, times, r, letters="abé"):
    chars = list(text)
    for _ in range(times):
        at, kind = r.randrange(len(chars) + 1), r.randrange(3)
        if kind == 0 and at < len(chars):
            chars[at] = r.choice(letters)
        elif kind == 1 and at < len(chars):
            del chars[at]
        else:
            chars.insert(at, r.choice(letters))
    return "".join(chars)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_banded_edit_distance(spark, most):
    r = random.Random(most)
    pairs = [(a, changed(a, r.randint(0, 4), r)) for a in ("".join(r.choice("abé") for _ in range(r.randint(0, 14))) for _ in range(150))]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.select("a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), most).alias("near")).collect():
        assert row["near"] == (edits(row["a"], row["b"]) <= most), row


def plain_removed(df):
    """Occurrences in order; a line goes if the same or a near one comes earlier."""
    places = []
    for r in df.select("doc_id", "text", line_dedup.text_key(F.col("text")).alias("key")).collect():
        for n, line in enumerate(r["text"].split("\n") if r["text"] is not None else []):
            if len(line) >= line_dedup.MIN_CHARS:
                places.append((-(1 << 70) if r["doc_id"] is None else r["doc_id"], (r["key"] >> 33) & 0x7FFFFFFF, n, line, r["doc_id"], r["text"]))
    out = {}
    places = sorted(set(places))
    for i, p in enumerate(places):
        if any(q[:3] < p[:3] and abs(len(q[3]) - len(p[3])) <= 2 and edits(q[3], p[3]) <= 2 for q in places[:i]):
            out.setdefault((p[4], p[5]), []).append(p[2])
    return out


def test_lines_go_as_by_brute_force(spark):
    r = random.Random(3)
    lines = ["".join(r.choice("abcdé ") for _ in range(r.randint(18, 30))) for _ in range(25)]
    rows = [(i if i % 17 else None, "\n".join(changed(r.choice(lines), r.randint(0, 3), r) for _ in range(r.randint(1, 4))) if i % 19 else None)
            for i in range(70)]
    df = spark.createDataFrame(rows + rows[5:8] + [(5, "another text of an id that repeats")], "doc_id long, text string")
    want = plain_removed(df)
    got = {(x["doc_id"], x["text"]): sorted(x["removed"]) for x in line_dedup.marked(df).collect()}
    assert {k: v for k, v in got.items() if v} == want and sum(map(len, want.values())) > 20
    assert line_dedup.without_copies(df).count() == df.count()


def test_lines_of_odd_rows(spark, edge, none):
    rows = line_dedup.without_copies(edge).collect()
    assert rows[0].__fields__ == edge.columns and len(rows) == len(EDGE_TEXTS) + 1
    texts = [r["text"] for r in rows]
    assert texts.count(None) == 1 and "same line that is long enough" in texts
    # The first of the rows with one text keeps it; rows repeated whole come out alike.
    assert sorted(t for t in texts if t is not None and "repeated" in t) == ["repeated row text with some words in it"]
    assert line_dedup.without_copies(none).count() == 0


def test_line_query(spark, given):
    want = plain_removed(given)
    texts = dict(given.select("doc_id", "text").collect())
    for r in QUERIES["op10_segment_line_dedup"](spark, SF).collect():
        assert r["removed"] == ",".join(map(str, want.get((r["doc_id"], texts[r["doc_id"]]), []))), r["doc_id"]


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_classes(texts):
    """Smallest index of each text's component of pairs of similarity 0.8 or more."""
    own, root = [shingles(t) for t in texts], list(range(len(texts)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "") or (own[i] and own[j] and jaccard(own[i], own[j]) >= 0.8)
            if same and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def near_texts(seed, groups=12):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        words = [f"w{r.randint(0, 2000)}" for _ in range(r.randint(6, 160))]
        for _ in range(r.randint(1, 7)):
            copy = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                copy[r.randrange(len(copy))] = f"x{r.randint(0, 2000)}"
            out.append(" ".join(copy))
    return out


def test_classes_are_those_of_brute_force(spark):
    texts = near_texts(1) + [None, "", " ", "one", "one", "two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.classed(df).collect()}
    assert [got[i] for i in range(len(texts))] == plain_classes(texts)


def test_many_near_copies_of_one_text_are_one_class(spark):
    r = random.Random(7)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(150):
        copy = list(words)
        copy[r.randrange(200)] = f"x{r.randint(0, 10 ** 6)}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["class_id"] for r in order_minhash.classed(df).collect()} == {0}


def test_every_pair_of_a_large_key_is_tested(spark):
    """Many different texts under one key, near copies only in pairs: leaders would meet few of those."""
    r = random.Random(5)
    texts = []
    for i in range(300):
        words = [f"w{r.randint(0, 10 ** 6)}" for _ in range(60)]
        texts.append(" ".join(words))
        if i % 3 == 0:
            texts.append(" ".join(words[:-1] + ["end"]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = order_minhash.written(order_minhash.nodes_of(df).withColumn("keys", F.array(F.lit(7).cast("long"))), "test-nodes")
    links, labels = order_minhash.near_links(df, nodes)
    assert links.distinct().count() == 100
    assert labels.groupBy("label").count().where("count = 2").count() == 100


def test_bit_maps_lose_no_similar_pair(spark):
    r = random.Random(13)
    rows = []
    for _ in range(300):
        a = [r.randint(0, 2 ** 63) for _ in range(r.randint(1, 400))]
        b = [x if r.random() > 0.12 else r.randint(0, 2 ** 63) for x in a]
        a, b = (np.unique(np.array(x, np.uint64)) for x in (a, b))
        shared = len(np.intersect1d(a, b))
        rows.append((len(a), order_minhash.parities(a).tolist(), len(b), order_minhash.parities(b).tolist(), shared / (len(a) + len(b) - shared)))
    df = spark.createDataFrame(rows, "n_a int, x array<long>, n_b int, y array<long>, exact double")
    out = df.select("exact", order_minhash.may_align(*map(F.col, ("n_a", "x", "n_b", "y")), 0.8).alias("may")).collect()
    assert all(x["may"] for x in out if x["exact"] >= 0.8) and any(x["exact"] >= 0.8 for x in out) and not all(x["may"] for x in out)


def test_alignment_is_the_jaccard_of_texts_in_order_and_sees_the_order():
    r = random.Random(11)
    code = lambda words: order_minhash.labelled_shingles(np.array([hash(w) & (2 ** 64 - 1) for w in words], np.uint64))
    for _ in range(50):
        a = [str(r.randint(0, 10 ** 9)) for _ in range(r.randint(20, 120))]
        b = list(a)
        for _ in range(r.randint(0, 2)):
            b[r.randrange(len(b))] = "z" + str(r.random())
        exact = jaccard(shingles(" ".join(a)), shingles(" ".join(b)))
        found = order_minhash.alignment_similarity(code(a), code(b))
        assert abs(found - exact) < 1e-9 if exact >= 0.8 else found < 0.8
    turned = a[len(a) // 2:] + a[:len(a) // 2]
    assert order_minhash.alignment_similarity(code(a), code(turned)) < 0.8
    assert order_minhash.alignment_similarity(code(["a"] * 30), code(["a"] * 31)) > 0.9


def test_components_of_chains_and_stars(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(500, 400)]
    r.shuffle(links)
    got = dict(order_minhash.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 500: 400, 400: 400}


def test_one_of_each_class_stays(spark, edge, none):
    rows = order_minhash.one_of_each(edge).collect()
    assert rows[0].__fields__ == edge.columns
    assert sorted((r["text"] or "") for r in rows) == sorted({t or "" for t in EDGE_TEXTS})
    assert order_minhash.one_of_each(none).count() == 0 and order_minhash.classed(none).count() == 0


def exact_neighbours(ids, vectors, asks, k):
    out = {}
    for i, own in enumerate(ids):
        if asks(own):
            inner = vectors @ vectors[i]
            order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-inner[j], ids[j]))[:k]
            out[own] = [(ids[j], inner[j]) for j in order]
    return out


def test_forest_reaches_the_recall_and_scores_exactly(spark):
    rows = QUERIES["op9_hash_prefix_forest"](spark, "/root/testdata/sf0.1").toPandas()
    d = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    ids, vectors = d.vec_id.to_numpy(), np.stack(d.embedding).astype(np.float64)
    place = {v: i for i, v in enumerate(ids)}
    hits = total = 0
    for query, own in rows.groupby("query_id"):
        inner = vectors @ vectors[place[query]]
        inner[place[query]] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -inner))[:20]]) & set(own.vec_id))
        total += 20
        assert own.sort_values("rank")["rank"].tolist() == list(range(1, 21))
        assert np.allclose(own.score, [inner[place[v]] for v in own.vec_id], atol=1e-12)
    assert total == 20 * (ids % 20 == 0).sum() and hits / total >= 0.9


@pytest.mark.parametrize("rows,candidates", [(4000, 1700), (4000, 50), (6000, 50)])
def test_forest_takes_candidates_until_the_recall_holds(spark, rows, candidates):
    """A target that is just met at level 1 (about TREES * rows / 128 matches), and ones that level 2 meets."""
    vectors = np.random.default_rng(6).normal(size=(rows, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    want = exact_neighbours(list(range(rows)), vectors, lambda i: i % 40 == 0, 20)
    got = neighbours.nearest(df, F.col("vec_id") % 40 == 0, k=20, candidates=candidates).collect()
    hits = sum(any(r["vec_id"] == v for v, _ in want[r["query_id"]]) for r in got)
    assert hits >= 0.9 * 20 * len(want)


def test_forest_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(40, 6)) * rng.uniform(0.2, 5, (40, 1))  # norms differ: the largest inner product is not the nearest angle
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(vectors)]
    rows += [(100 + i, rows[0][1], "copy") for i in range(30)]  # equal vectors
    good = list(rows)
    rows += [(200, None, "x"), (220, [0.0] * 6, "x"), (240, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (260, [float("nan")] * 6, "x"),
             (280, [float("inf")] * 6, "x"), (300, [1.0, 2.0], "x"), (None, [1.0] * 6, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, entry string")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact_neighbours([r[0] for r in good], np.array([r[1] for r in good]), lambda i: i % 20 == 0, 20)
    assert set(got) == set(want)
    for query, found in got.items():
        assert [v for _, v, _ in sorted(found)] == [v for v, _ in want[query]]
        assert np.allclose([s for *_, s in sorted(found)], [s for _, s in want[query]])
    few = neighbours.nearest(df.where("vec_id < 3"), F.lit(True), k=20).collect()
    assert len(few) == 6
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_a_family_that_shares_a_passage_makes_few_pairs(spark, monkeypatch):
    """3,000 texts of two thirds of one passage each; a few are copies of one another beyond it."""
    r = random.Random(17)
    passage = [f"p{i}" for i in range(120)]
    texts = []
    for i in range(3000):
        if i % 100 == 1:
            texts.append(" ".join([*texts[-1].split()[:-1], "end"]))
        else:
            texts.append(" ".join(passage + [f"w{r.randint(0, 10 ** 7)}" for _ in range(60)]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = []
    real = order_minhash._rare_pairs

    def counting(*args):
        pairs = real(*args).distinct()
        seen.append(pairs.count())
        return pairs

    monkeypatch.setattr(order_minhash, "_rare_pairs", counting)
    got = {x["doc_id"]: x["class_id"] for x in order_minhash.classed(df).collect()}
    assert got == {i: i - 1 if i % 100 == 1 else i for i in range(3000)}
    assert sum(seen) < 3000


def test_bit_filter_loses_nothing(spark):
    from bazaarlake.llm.common import bit_filter, maybe_in

    df = spark.range(20_000).selectExpr("id", "xxhash64(id) AS h")
    some = df.where("id % 50 = 0")
    kept = maybe_in(df, "h", bit_filter(some, "h"))
    assert some.join(kept, "id", "left_anti").count() == 0 and kept.count() < 600
    assert kept.columns == df.columns and maybe_in(df, "h", bit_filter(some.limit(0), "h")).count() == 0


def test_classes_that_are_found_already_take_no_further_step(spark, monkeypatch):
    writes = []

    def counted(df, purpose):
        writes.append(purpose)
        return written(df, purpose)

    written = order_minhash.written
    monkeypatch.setattr(order_minhash, "written", counted)
    of = lambda links: {r["node"]: r["label"] for r in order_minhash.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert of([(1, 5), (1, 9), (7, 3), (1, 5)]) == {1: 1, 5: 1, 9: 1, 3: 3, 7: 3}
    assert len(writes) == 1  # stars as they come
    assert of([]) == {}
    chain = [(n, n + 1) for n in range(40)] + [(101, 100), (102, 101), (100, 102)] + [(200, 202), (201, 202)]
    assert of(chain) == {n: 0 for n in range(41)} | {n: 100 for n in (100, 101, 102)} | {n: 200 for n in (200, 201, 202)}


def test_counts_of_shingles_keep_their_order_in_a_byte(spark):
    often = {1: 1, 2: 2, 3: 3, 4: 5, 5: 40, 6: 4000}
    rows = [(0, 0, [slot] * n) for slot, n in often.items()] + [(0, 0, [2 * order_minhash.COUNT_SLOTS + 7]), (0, 0, [])]
    found = order_minhash._rarity(spark.createDataFrame(rows, "node long, label long, own array<long>"))
    assert found.dtype == np.uint8 and len(found) == order_minhash.COUNT_SLOTS
    assert found[1] == found[7] == found[8] == 0
    assert all(found[k] < found[k + 1] for k in range(1, 6))
