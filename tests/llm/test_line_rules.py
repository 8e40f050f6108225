"""Line rules against a plain count in Python."""

import random
import re
from collections import Counter

from opsloom.llm import rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed,
    )


def test_counts(spark):
    rng = random.Random(1)
    rows = [None, "", " \n\t", "a", "é ü\x0bb\x1cc", "x " * 20_000, "a b c d e " * 3, "a\n\na\n a\n#a <b>"]
    for _ in range(200):
        rows.append("".join(rng.choice(["a ", "b ", "c\n", "d\t", "# ", "é.", "\n"]) for _ in range(rng.randrange(90))))
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(rows)], "doc_id long, text string, _h string")
    got = {r.doc_id: tuple(r)[1:7] for r in rules.line_rules(docs, keep=("doc_id",)).collect()}
    assert got == {i: plain(t) for i, t in enumerate(rows)}


def test_lines(spark):
    prose = "This is a sentence of a dozen words that ends as it should.\n"
    cases = {
        "prose": (prose * 1 + "Another line with enough words comes here, and it stays.", True),
        "menu": ("Home\nAbout us\nContact\nNews\nThe shop\nImprint\nMore\nHelp\nJobs", False),
        "symbols": ("Thnd*** iner### ther%%% ththsh$$$ ountin&&& ntnd*** that*** a%%% erat### shble### x$$$", False),
        "shout": ("OF!! THAT!! ERE!! THE!! AND!! ONE!! TWO!! SIX!! TEN!! ALL!! END!!", False),
        "table": ("one | two | three | four\nfive | six | seven | eight\nnine | ten | eleven | twelve", False),
        "phrase": ("We use cookies, see our privacy policy and the terms of use before you go on reading here.", False),
        "mixed": (prose + "Home\nAbout us\n" + "A second sentence that has enough words of its own to stay here.", True),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "doc_id string, text string")
    out = {r.doc_id: r for r in rules.line_rules(docs, keep=("doc_id",)).collect()}
    assert {k: out[k].kept for k in cases} == {k: v for k, (_, v) in cases.items()}
    assert "Home" not in out["mixed"].clean_text and out["mixed"].clean_text.startswith("This is")
    assert rules.line_rules(docs.limit(0), keep=("doc_id",)).count() == 0


def test_lines_count_words_whatever_stands_between(spark):
    line = " ".join(f"word{i}" for i in range(19)) + " ends."
    texts = {"blanks": line, "tabs": line.replace(" ", "\t"), "wide": line.replace(" ", " \t  "), "mixed": line.replace(" ", "\x0b")}
    docs = spark.createDataFrame([(k, "\n".join([t] * 1 + [t[::-1]] * 1)) for k, t in texts.items()], "doc_id string, text string")
    out = {r.doc_id: (r.kept, r.lost) for r in rules.line_rules(docs, keep=("doc_id",)).collect()}
    assert set(out.values()) == {(True, 0.0)}
    long = "\u6f22" * 200  # a line of a script that writes neither blanks nor stops
    docs = spark.createDataFrame([(1, long + "\n" + "a b c d e f g h i j k l. "), (2, "\u6f22\n" + long)], "doc_id long, text string")
    assert [r.lost for r in rules.line_rules(docs, keep=("doc_id",)).orderBy("doc_id").collect()] == [0.0, 1 - 200 / 201]


def test_keeps_labelled_clean_documents(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    out = rules.line_rules(docs, keep=("doc_id",)).join(labels, "doc_id")
    assert out.where("quality = 1 AND NOT base_failed AND NOT kept").count() == 0
    assert out.where("quality = 0 AND kept").count() <= 0.05 * out.where("quality = 0").count()
