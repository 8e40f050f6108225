"""Packing: ids against whole-text encoding, plans against their invariants and lower bounds."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from opsloom.llm import packing
from opsloom.llm.queries import queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_whole_text_encoding(tokenizer):
    rng = random.Random(4)
    parts = [*"abÀÉÿ÷×ßΣςéé́ 　\x1c\x85'’1<|> \n\t한각-_.,!🙂", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "Word", "ÉTÉ", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["", "'", "a", " a"]
    for i in range(0, len(texts), 500):
        some = texts[i : i + 500]
        flat, counts = packing.token_ids([t.encode() for t in some], PATH)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        assert counts.tolist() == [len(w) for w in want]
        assert flat.tolist() == [i for w in want for i in w]


def test_ids_of_regular_words(tokenizer):
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
        both = [word, word.translate(str.maketrans("ab", "ba")), word + "'"]
        flat, counts = packing.token_ids([t.encode() for t in both], PATH)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in both]
        assert counts.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


def bound(counts, capacity):
    lengths = np.arange(capacity + 1)
    big = counts[lengths * 2 > capacity].sum()
    return max(int(big), -(-int((counts * lengths).sum()) // capacity))


def lengths_of(kind, rng, n, capacity):
    if kind == "even":
        return rng.integers(1, capacity + 1, n)
    if kind == "small":
        return rng.integers(1, capacity // 10, n)
    if kind == "large":
        return rng.integers(capacity // 3, capacity + 1, n)
    if kind == "few":
        return rng.choice([capacity // 3 + 1, capacity // 2 + 1, capacity // 6, capacity], n)
    return np.minimum(rng.lognormal(5, 1.2, n).astype(int) + 1, capacity)


@pytest.mark.parametrize("kind", ["even", "small", "large", "few", "skewed"])
@pytest.mark.parametrize("n", [1, 5, 300, 10_000])
def test_plan(kind, n):
    capacity = 2048
    lengths = np.sort(lengths_of(kind, np.random.default_rng(n), n, capacity))
    counts = np.bincount(lengths, minlength=capacity + 1)
    rows, used = packing.plan(counts, capacity)
    assert rows[:, 1].sum() == n and rows[0, 0] == 0 and (rows[1:, 0] == np.cumsum(rows[:, 1])[:-1]).all()
    sequence = np.concatenate([np.arange(s, s + k) for _, k, s, _ in rows])
    offset = np.repeat(rows[:, 3], rows[:, 1])
    order = np.lexsort([offset, sequence])
    ends = offset[order] + lengths[order]
    new = np.append(True, np.diff(sequence[order]) > 0)
    assert (offset[order][new] == 0).all() and (offset[order][1:][~new[1:]] == ends[:-1][~new[1:]]).all()
    assert ends.max() <= capacity and len(set(sequence.tolist())) == used
    # Best-fit decreasing, document by document, for comparison.
    if n <= 300:
        free = []
        for length in lengths[::-1]:
            fits = [i for i, f in enumerate(free) if f >= length]
            if fits:
                free[min(fits, key=lambda i: free[i])] -= length
            else:
                free.append(capacity - length)
        assert used <= len(free) + 1
    elif kind != "few":
        assert used <= 1.03 * bound(counts, capacity)


def check(rows, out, tokenizer):
    by_doc = defaultdict(list)
    for doc, text in rows:
        by_doc[doc].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    want = sorted(
        (doc, k, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes()))
        for doc, lists in by_doc.items()
        for ids in lists
        for k, at in enumerate(range(0, len(ids), 2048))
    )
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    by_sequence = defaultdict(list)
    for r in out:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_sequence), -(-sum(w[3] for w in want) // 2048)


def test_documents(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, "a " * 2047), (4, "a " * 2048), (5, "b " * 9000), (5, "b " * 9000), (6, "été <|endoftext|>")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, position string").repartition(3)
    used, least = check(rows, packing.pack(docs).collect(), tokenizer)
    assert used <= least + 1
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check(rows, queries()["op8_packing"](spark, sf).collect(), tokenizer)
    assert used <= 1.1 * least
