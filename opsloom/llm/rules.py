"""Quality rules: lines are cleaned first, then texts that lose too much are rejected. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.functions.barrier import computed_once
from opsloom.llm.common import ready, text_or_empty, WORD

BLANKS = " \t\n\x0b\f\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
SYMBOL_SHARE = 0.1  # of a line's characters
MARK_SHARE = 0.5  # doubled marks per word
BOILERPLATE_WORDS = 40  # longer lines with such a phrase stay
LINK_WORDS, LINK_CHARS = 3, 60  # a line of so few words and characters without a stop is navigation
MOST_LOST = 0.5  # of a text's characters
ENDINGS = ".!?:;…\"')”»。！？"

# Lower-case phrases of lines that are not content, in English, German, French and Spanish.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "powered by",
    "privacy policy",
    "read more",
    "sign in",
    "sign up",
    "skip to content",
    "subscribe to",
    "terms of service",
    "terms of use",
    "use of cookies",
    "uses cookies",
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "hier klicken",
    "weiterlesen",
    "cliquez ici",
    "lire la suite",
    "mentions légales",
    "tous droits réservés",
    "aviso legal",
    "haga clic",
    "leer más",
    "todos los derechos reservados",
)


def count_of(text: Column, chars: str) -> Column:
    """How often any of the characters occurs."""
    return F.length(text) - F.length(reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text))


def has_phrase(text: Column) -> Column:
    return reduce(lambda found, words: found | F.contains(text, F.lit(words)), BOILERPLATE, F.lit(False))


def line_fails(line: Column, suspect: Column) -> Column:
    """Whether a line with words breaks a rule on punctuation, navigation or boilerplate.

    `suspect` tells whether its text has a symbol, a doubled mark or a phrase at all; the rules on
    these are skipped for the lines of other texts.
    """
    n_words = F.regexp_count(line, F.lit(WORD))
    chars = F.length(F.translate(line, BLANKS, ""))
    doubled = F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("!")))
    unlike_text = (
        (count_of(line, SYMBOLS) > SYMBOL_SHARE * chars)
        | (doubled > MARK_SHARE * n_words)
        | (has_phrase(F.lower(line)) & (n_words <= BOILERPLATE_WORDS))
    )
    open_end = ~F.contains(F.lit(ENDINGS), F.right(F.rtrim(line, F.lit(BLANKS)), F.lit(1)))
    link = open_end & (n_words <= LINK_WORDS) & (chars <= LINK_CHARS)
    return F.when(suspect, unlike_text).otherwise(F.lit(False)) | link | F.contains(line, F.lit(" » "))


def repeated_words(hashes: str) -> tuple[Column, Column]:
    """The window hashes of a column of word hashes, and, from a column `_windows` of them, the words
    that repeated windows cover."""
    last = F.size(hashes) - WINDOW
    parts = lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(WINDOW)])
    windows = F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), parts)
    )
    return windows, F.col("_windows")


def line_rules(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep` of each row with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lost (share of characters) and clean_text (the lines that stay).

    One pass without any shuffle. Null texts are empty; such texts fail for having few words; rows
    are judged one by one, so repeated rows and an empty table need no rule; other columns clash with nothing.
    """
    ready(docs.sparkSession)
    named = docs.select(*[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)], text_or_empty(text_col).alias("_t"))
    carried = [f"_keep_{i}" for i in range(len(keep))]
    words = F.array_remove(F.split("_t", SPLIT), "")
    lines = F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")
    first = named.select(
        *carried, "_t", words.alias("_words"), lines.alias("_lines"), count_of(F.col("_t"), SYMBOLS).alias("n_symbols")
    )
    first = computed_once(first, ["_words", "_lines", "n_symbols"])
    suspect = (F.col("n_symbols") > 0) | F.contains("_t", F.lit("!!")) | has_phrase(F.lower("_t"))
    first = first.select(
        *carried, "_lines", "n_symbols", suspect.alias("_suspect"),
        F.length(F.array_join("_words", "")).alias("word_chars"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    first = computed_once(first, ["_h", "_suspect"])
    windows, _ = repeated_words("_h")
    second = first.select(
        *carried, "_lines", "n_symbols", "word_chars", F.size("_h").alias("_n"), windows.alias("_windows"),
        F.filter("_lines", lambda x: ~line_fails(x, F.col("_suspect"))).alias("_good"),
    )
    second = computed_once(second, ["_windows", "_good"])
    # Few texts repeat a window; only those sort theirs.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    other = [*carried, "_lines", "n_symbols", "word_chars", "_n", "_good"]
    third = second.select(
        *other, F.when(repeats, placed).otherwise(F.lit(None)).alias("_sorted")
    )
    third = computed_once(third, ["_sorted"])

    def twin(x: Column, i: Column) -> Column:
        h = lambda k: F.get(F.col("_sorted"), k)["h"]
        return F.coalesce(h(i - 1) == x["h"], F.lit(False)) | F.coalesce(h(i + 1) == x["h"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("_sorted", twin), lambda x: x["i"]))
    fourth = third.select(*other, starts.alias("_starts"))
    fourth = computed_once(fourth, ["_starts"])
    # Each repeated window covers five words, less what the next one covers again.
    step = F.transform(
        "_starts", lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_starts"), i + 1) - s, F.lit(WINDOW)))
    )
    covered = F.coalesce(F.aggregate(step, F.lit(0), lambda a, b: a + b), F.lit(0))
    out = fourth.select(
        *carried,
        F.col("_n").cast("long").alias("n_words"),
        F.col("word_chars").cast("long"),
        F.col("n_symbols").cast("long"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.array_join("_good", "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    stays = F.length(F.array_join(F.split("clean_text", SPLIT), ""))
    lost = F.when(F.col("word_chars") > 0, 1 - stays / F.col("word_chars")).otherwise(0.0)
    return out.withColumn("base_failed", failed).withColumn("lost", lost).select(
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("lost") <= MOST_LOST)).alias("kept"), "lost", "clean_text",
    )


def _sql() -> str:
    """The query over whole documents, line by line, for another engine."""
    symbols = "length({0}) - length(regexp_replace({0}, '[#*$%&|<>]', '', 'g'))"
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    endings = ENDINGS.replace("'", "''")
    blank = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM texts
), placed AS (
  SELECT r, unnest(range(len(w))) AS i, w FROM words
), windows AS (
  SELECT r, i, array_to_string(w[i + 1:i + {WINDOW}], ' ') AS five FROM placed WHERE i + {WINDOW} <= len(w)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, CAST(sum(least({WINDOW}, coalesce(after - i, {WINDOW}))) AS BIGINT) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after FROM again) GROUP BY r
), lines AS (
  SELECT r, line FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), sized AS (
  SELECT r, line, trim(line, {blank}) AS trimmed,
    len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n,
    length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
  FROM lines
), judged AS (
  SELECT r, line, chars,
    ({symbols.format('line')} > {SYMBOL_SHARE} * chars
      OR length(line) - length(replace(line, '!!', '!')) > {MARK_SHARE} * n
      OR (({phrases}) AND n <= {BOILERPLATE_WORDS})
      OR (NOT contains('{endings}', right(trimmed, 1)) AND n <= {LINK_WORDS} AND chars <= {LINK_CHARS})
      OR contains(line, ' » ')) AS fails
  FROM sized
), by_line AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN fails THEN 0 ELSE chars END) AS stay
  FROM judged GROUP BY r
), counted AS (
  SELECT words.r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST({symbols.format('t')} AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(stay, 0) AS stay
  FROM words LEFT JOIN by_line USING (r) LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AS base_failed,
  (NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
    AND CASE WHEN word_chars > 0 THEN 1 - CAST(stay AS DOUBLE) / word_chars ELSE 0 END <= {MOST_LOST}) AS kept
FROM counted
"""


SQL = _sql()
