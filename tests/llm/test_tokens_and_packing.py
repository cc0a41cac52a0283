"""Sharding, byte-level BPE, packing: against the libraries, and laws that every result obeys."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from bazaarlake.llm import byte_bpe, packing, sharding
from bazaarlake.llm.queries import QUERIES, RANK_FILE, WORD_TOKENIZER, vocabulary

from .conftest import EDGE_TEXTS, SF

ALPHABET = "aab bcde  EÉé中́😀\n\t'sl09~§. \x1c"


def strange_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 120))) for _ in range(n)] + ["a" * 3000, "ab" * 999, " " * 500 + "x", "", "  ", "~ a ~ b"]


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(vocabulary(RANK_FILE))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_are_those_of_the_library(reference):
    codec = byte_bpe.ByteBpe(byte_bpe.read_ranks(vocabulary(RANK_FILE)), public_tokenizers.PATTERN)
    texts = strange_texts(600, 1)
    for text, ids in zip(texts, codec.encode(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_texts_with_blank_lines_and_odd_spaces(reference):
    codec = byte_bpe.ByteBpe(byte_bpe.read_ranks(vocabulary(RANK_FILE)), public_tokenizers.PATTERN)
    r = random.Random(9)
    spaces = [" ", " ", " ", "\n", "\n\n", "  ", " \n", "\t ", "\u00a0", "\u2003 ", "\x85", "\x1c ", "\u3000"]
    words = ["a", "it's", "12", "Éa,", "中文", "...", "'ll", "x😀", "don't!"]
    texts = ["".join(r.choice(words) + r.choice(spaces) for _ in range(r.randint(0, 25))) + r.choice(["", "end", " "]) for _ in range(800)]
    codes = codec.encode(pa.array([*texts, None]))
    assert codes[-1] == b""
    for text, ids, back in zip(texts, codes, codec.decode_many(codes)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text)
        assert back == text.encode()
    assert codec.encode(pa.array([], pa.string())) == [] and codec.decode_many([]) == []


def test_segment_tree_breaks_ties_to_the_left():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257}
    codec = byte_bpe.ByteBpe(ranks, r".+")
    assert codec.merge([b"aaaaa"])[0].tolist() == [256, 257]


def test_documents_encode_and_decode(spark, edge, none, reference):
    ranks = vocabulary(RANK_FILE)
    encoded = byte_bpe.encode_documents(edge, ranks, public_tokenizers.PATTERN)
    rows = byte_bpe.decode_documents(encoded, ranks, public_tokenizers.PATTERN).collect()
    assert sorted(r["decoded"].decode() for r in rows) == sorted([t or "" for t in EDGE_TEXTS] + [EDGE_TEXTS[-1]])
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == reference.encode_ordinary(r["decoded"].decode())
    assert byte_bpe.encode_documents(none, ranks, public_tokenizers.PATTERN).count() == 0


def test_word_ids_are_those_of_the_library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORD_TOKENIZER))
    texts = strange_texts(600, 2) + ["<|endoftext|> x", "a <|endoftext|> b", "a<|endoftext|>b <|startoftext|>\n<|endoftext|><|endoftext|> ~", "<|endoftext", "<| endoftext |>"]
    for text, ids in zip(texts, packing.WordTokenizer(vocabulary(WORD_TOKENIZER).decode()).ids(pa.array(texts))):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def packed_rows(df, definition, **options):
    rows = [r.asDict() for r in packing.pack(df, definition, **options).collect()]
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= options.get("capacity", packing.CAPACITY)
    return rows, len(by_sequence)


def test_packing_is_gapless_whole_and_tight(spark, given):
    definition = vocabulary(WORD_TOKENIZER).decode()
    rows, used = packed_rows(given, definition)
    tokenizer = Tokenizer.from_str(definition)
    for doc_id, text in given.select("doc_id", "text").limit(40).collect():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 2048))
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(ids[i:i + 2048].tobytes()) for i in range(0, len(ids), 2048)]
    assert used <= -(-sum(r["length"] for r in rows) // 2048) * 1.02 + 1


def test_packing_groups_cases_and_nothing(spark, edge, none):
    definition = vocabulary(WORD_TOKENIZER).decode()
    rows, _ = packed_rows(edge, definition, capacity=64, group_rows=50)
    assert sum(r["piece"] == 0 for r in rows) == len(EDGE_TEXTS) + 1
    assert sum(r["doc_id"] is None for r in rows) == 1
    assert packing.pack(none, definition).count() == 0


def test_sum_of_squares_follows_its_rule():
    """Against a search over all choices, in the same order."""
    r = random.Random(5)
    lengths = [r.randint(1, 12) for _ in range(400)]
    sequence, offset = packing.sum_of_squares(np.array(lengths), 16)
    gaps, count = {}, [0] * 17
    for length, s, o in zip(lengths, sequence.tolist(), offset.tolist()):
        def after(gap):
            c = count.copy()
            c[gap] -= 1
            if gap > length:
                c[gap - length] += 1
            return sum(x * x for x in c[1:])
        fitting = [g for g in range(length, 17) if count[g] > 0]
        gap = gaps.get(s, 16)
        assert o == 16 - gap
        if fitting:
            assert after(gap) == min(map(after, fitting))
            count[gap] -= 1
        else:
            assert s not in gaps
        gaps[s] = gap - length
        count[gaps[s]] += 1
        count[0] = 0


def test_shards_are_contiguous_balanced_and_numbered(spark, given):
    rows = QUERIES["op5_contiguous_shards"](spark, SF).toPandas().sort_values("doc_id")
    texts = dict(given.select("doc_id", "text").collect())
    assert (rows["size"] == [len((texts[i] or "").encode()) + 8 for i in rows.doc_id]).all()
    assert (rows["text_crc32"] == [zlib.crc32((texts[i] or "").encode()) for i in rows.doc_id]).all()
    assert rows["shard"].is_monotonic_increasing
    for _, own in rows.groupby("shard"):
        assert own["slot"].tolist() == list(range(len(own)))
        assert abs(own["size"].sum() - rows["size"].sum() / 24) <= rows["size"].max()


def test_shards_of_odd_rows(spark, edge, none):
    rows = sharding.shard_contiguous(edge, 3).collect()
    assert len(rows) == len(EDGE_TEXTS) + 1 and {r["shard"] for r in rows} <= {0, 1, 2}
    assert sorted(r["size"] for r in rows)[:2] == [8, 8] and sum(r["doc_id"] is None for r in rows) == 1
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    one_id = spark.createDataFrame([(7, "same")] * 50, "doc_id long, text string")
    assert sorted(r["shard"] for r in sharding.shard_contiguous(one_id, 5).collect()) == sorted(list(range(5)) * 10)
    assert sharding.shard_contiguous(none, 3).count() == 0


def test_a_tokenizer_encodes_and_keeps_bounded_numbers_of_chunks():
    made = packing.WordTokenizer(vocabulary(WORD_TOKENIZER).decode())
    whole, sizes = made.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, add_special_tokens):
            sizes.append(len(texts))
            return whole.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    made.tokenizer = Counting()
    chunks = [f"w{i}" for i in range(400_000)]
    found = [made.chunks.of(chunks[i:i + 50_000]) for i in range(0, len(chunks), 50_000)]
    assert max(sizes) <= 128  # encodings of many more would be held at once
    assert len(made.chunks.known) <= 350_000 + 50_000
    assert b"".join(found[0][:500]) == np.asarray(whole.encode(" ".join(chunks[:500]), add_special_tokens=False).ids, "<u4").tobytes()
