"""Substring removal against a dictionary of all windows."""

import hashlib
import random
import re
from collections import Counter

from opsloom.llm import substrings
from opsloom.llm.queries import queries


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    rows = df.select("doc_id", "_n_words", "_n_removed", "_kept_sha256").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_random_texts_with_shared_passages(spark):
    rng = random.Random(1)
    passages = [[rng.choice("abcdefghij") + str(rng.randrange(9)) for _ in range(n)] for n in (30, 34, 35, 36, 50, 90)]
    rows = []
    for doc in range(150):
        words = []
        for _ in range(rng.randrange(6)):
            words += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(40))]
            if rng.random() < 0.7:
                p = rng.choice(passages)
                cut = rng.randrange(6)
                words += p[cut : len(p) - rng.randrange(3)]
        rows.append((doc, rng.choice([" ", "\n", " \t"]).join(words)))
    rows += [(500, rows[3][1]), (501, rows[3][1] + " "), (502, None), (503, ""), (3, rows[3][1]), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(substrings.remove_repeats(docs)) == brute(rows, 35)
    assert got(substrings.remove_repeats(docs, window=40)) == brute(rows, 40)


def test_repeats_within_one_text_and_long_texts(spark):
    period = " ".join(f"w{i}" for i in range(20))
    rows = [(1, " ".join([period] * 9)), (2, "x " * 20_000), (3, "é " * 35), (4, "é " * 36)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(substrings.remove_repeats(docs)) == brute(rows, 35)


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert substrings.without_repeats(docs).count() == 0
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"a\nb {line}", "x", 9, 1), (2, f"{line} c", None, 9, None), (3, "as\nit  was", "y", 10, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 string, n_chars long, starts int")
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars, r.k1, r.starts) for r in out.collect()} == {
        1: ("a b", 3, "x", 1), 2: ("c", 1, None, None), 3: ("as\nit  was", 10, "y", 2),
    }


def thue_morse(letters):
    word = "a"
    while len(word) < letters:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_regular_words_and_windows_are_told_apart(spark):
    """Texts that share every hash which is a polynomial modulo a power of two."""
    rows = []
    for n in range(8, 13):
        one, two = thue_morse(1 << n)
        before, after = " ".join(f"p{i}" for i in range(17)), " ".join(f"q{i}" for i in range(17))
        rows += [(2 * n, f"{before}{n} {one} {after}"), (2 * n + 1, f"{before}{n} {two} {after}")]
    one, two = thue_morse(4096)
    rows += [(100, " ".join(one)), (101, " ".join(two))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = got(substrings.remove_repeats(docs))
    assert out == brute(rows, 35)
    assert all(removed == 0 for doc, _, removed, _ in out if doc < 100)


def test_clashing_columns(spark):
    line = " ".join(f"w{i}" for i in range(36))
    rows = [(1, line, "a", "b", 1, 2, 3, "x"), (2, line + " c", "a", "b", 1, 2, 3, "x")]
    names = "doc_id long, text string, _text string, _kept string, _k1 int, _starts int, _n_removed int, c0 string"
    docs = spark.createDataFrame(rows, names)
    assert got(substrings.remove_repeats(docs)) == brute([(r[0], r[1]) for r in rows], 35)
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(1, "", *rows[0][2:]), (2, "c", *rows[1][2:])]


def test_marks_are_a_difference_cover():
    marks = substrings.MARKS
    assert {(a - b) % substrings.PERIOD for a in marks for b in marks} == set(range(substrings.PERIOD))


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = queries()["op7_substrings"](spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, 35)
