"""Line-first quality cleaning, with DataFrame functions only.

Each line of a text is judged on its own: punctuation (symbols or shouting
instead of sentences, fragments without an end mark), navigation (separators
between a few words) and boilerplate (licence, cookie, log-in phrases in short
lines). Failing lines go, and a document that loses more than `MAX_LOST`
percent of its word characters goes with them. Blank lines stay as they are.

All work is within a row, so nothing is shuffled. Repeated three-word windows
are found by sorting (window hash, position) packed in one long per window;
windows with equal hashes are compared word by word, and a text where two
different windows collide takes an exact path.

Nulls and edge cases: null text counts as empty, fails the base rule (under 50
words) and is not kept; identical rows give identical results; an empty table
gives an empty result; input columns whose names clash with the result's are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import or_empty, quoted, table, without, words

# Limits of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50          # percent of words in repeated windows
MAX_LOST = 40            # percent of word characters in failing lines
SYMBOLS_PER_100 = 30     # symbols, or doubled exclamation marks, per 100 words of a line
NAV_MARKS = "|»›•·"
FRAGMENT_WORDS = 3
BOILERPLATE_WORDS = 30
END_MARK = r"[.!?…:;,)\]\"'”’»。！？]$"
BOILERPLATE = (r"(?i)(all rights reserved|released under the|licensed under|copyright|cookie|privacy policy"
               r"|terms of (use|service)|subscribe|sign up|sign in|log in|click here|read more|enable javascript"
               r"|share this|back to top)")
BLANK = r"^[\x20\x09-\x0D]*$"

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
          "n_lines", "n_failed_lines", "lost_chars", "clean_text")


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long")


def line_fails(line: Column) -> Column:
    """True if a line breaks a rule; blank lines break none."""
    tidy = F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))
    n = F.size(F.split(tidy, " "))
    shouts = (F.length(line) - F.length(F.regexp_replace(line, "!!", ""))) / 2
    symbols = _count_of(line, SYMBOLS)
    marks = _count_of(line, NAV_MARKS)
    return ~line.rlike(BLANK) & (
        (symbols * 100 > n * SYMBOLS_PER_100) | (shouts * 100 > n * SYMBOLS_PER_100)
        | ((n <= FRAGMENT_WORDS) & ~tidy.rlike(END_MARK))
        | ((marks >= 3) & (n < marks * 4))
        | ((n < BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words from the word array `__w`."""
    df = df.withColumn("__n", F.size("__w")).withColumn("__k", F.length(F.bin(F.col("__n").cast("long"))))
    w = F.col("__w")
    triple = lambda i: (F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    df = df.withColumn("__p", F.when(F.col("__n") < 4, F.array().cast("array<bigint>")).otherwise(F.sort_array(F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("__n") - 3, F.lit(0))),
        lambda i: F.call_function("shiftleft", F.xxhash64(*triple(i)), F.col("__k")).bitwiseOR(i.cast("long"))))))
    p, k = F.col("__p"), F.col("__k")
    high = lambda x: F.call_function("shiftrightunsigned", x, k)
    low = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1)
    df = df.withColumn("__c", F.filter(p, lambda x, j: F.coalesce(high(x) == high(F.get(p, j - 1)), F.lit(False))
                                       | F.coalesce(high(x) == high(F.get(p, j + 1)), F.lit(False))))
    c = F.col("__c")

    def differ(x: Column, y: Column) -> Column:
        a, b = low(x).cast("int"), low(y).cast("int")
        return (F.get(w, a) != F.get(w, b)) | (F.get(w, a + 1) != F.get(w, b + 1)) | (F.get(w, a + 2) != F.get(w, b + 2))

    collides = F.when(F.size(c) < 2, F.lit(False)).otherwise(F.exists(
        F.sequence(F.lit(1), F.greatest(F.size(c) - 1, F.lit(1))),
        lambda j: (high(F.get(c, j)) == high(F.get(c, j - 1))) & differ(F.get(c, j), F.get(c, j - 1))))
    exact = F.filter(c, lambda x: F.exists(c, lambda y: (x != y) & (high(x) == high(y)) & ~differ(x, y)))
    df = df.withColumn("__c", F.when(F.col("__n") < 4, c).when(collides, exact).otherwise(c))
    at = F.sort_array(F.transform("__c", lambda x: low(x)))
    covered = F.aggregate(at, F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("sum")),
                          lambda acc, x: F.struct(x.alias("last"), (acc["sum"] + F.least(F.lit(3).cast("long"), x - acc["last"])).alias("sum")),
                          lambda acc: acc["sum"])
    return df.withColumn("n_repeat_words", covered).drop("__p", "__c", "__k", "__n")


def judge(docs: DataFrame, text: str = "text", max_lost: int = MAX_LOST) -> DataFrame:
    """`docs` with the base counts, the verdict and the cleaned text."""
    rest = without(docs, RESULT)
    df = docs.select(*rest, or_empty(quoted(text)).alias("__t"))
    df = df.withColumn("__w", words(F.col("__t")))
    lines = F.transform(F.split("__t", "\n"), lambda x: F.struct(x.alias("line"), line_fails(x).alias("fails")))
    df = df.withColumn("__lines", lines)
    full = F.filter("__lines", lambda x: ~x["line"].rlike(BLANK))
    df = df.withColumn("__full", F.transform(full, lambda x: x["line"]))
    df = _repeat_words(df)
    df = df.withColumn("n_words", F.size("__w").cast("long")) \
        .withColumn("word_chars", word_chars(F.col("__t"))) \
        .withColumn("n_symbols", _count_of(F.col("__t"), SYMBOLS).cast("long")) \
        .withColumn("n_dup_lines", (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long")) \
        .withColumn("n_lines", F.size("__full").cast("long")) \
        .withColumn("__bad", F.filter("__lines", lambda x: x["fails"]))
    lost = word_chars(F.array_join(F.transform("__bad", lambda x: x["line"]), " "))
    df = df.withColumn("n_failed_lines", F.size("__bad").cast("long")).withColumn("lost_chars", lost)
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT)
    df = df.withColumn("base_failed", base)
    df = df.withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * max_lost))
    df = df.withColumn("clean_text", F.array_join(F.transform(
        F.filter("__lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n"))
    return df.select(*rest, *RESULT)


def op6_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    return judge(table(spark, data_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_failed_lines", "lost_chars")


_SQL_FAILS = f"""(NOT regexp_matches(l, '{BLANK}') AND (
   (length(l) - length(translate(l, '{SYMBOLS}', ''))) * 100 > n * {SYMBOLS_PER_100}
   OR (length(l) - length(replace(l, '!!', ''))) / 2 * 100 > n * {SYMBOLS_PER_100}
   OR (n <= {FRAGMENT_WORDS} AND NOT regexp_matches(tidy, '{END_MARK.replace("'", "''")}'))
   OR ((length(l) - length(translate(l, '{NAV_MARKS}', ''))) >= 3 AND n < (length(l) - length(translate(l, '{NAV_MARKS}', ''))) * 4)
   OR (n < {BOILERPLATE_WORDS} AND regexp_matches(l, '{BOILERPLATE}'))))"""

OP6_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, generate_subscripts(ws, 1) AS i, unnest(ws) AS a
  FROM (SELECT rid, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d)
), g AS (
  SELECT rid, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)
), r AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g WHERE c IS NOT NULL) WHERE n > 1
), q AS (
  SELECT rid, count(DISTINCT i + o) AS n_repeat FROM r, (VALUES (0), (1), (2)) v(o) GROUP BY rid
), nw AS (
  SELECT rid, count(*) AS n_words, sum(length(a)) AS chars FROM w GROUP BY rid
), l0 AS (
  SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d
), l1 AS (
  SELECT rid, l, trim(regexp_replace(l, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS tidy FROM l0
), l2 AS (
  SELECT *, len(string_split(tidy, ' ')) AS n FROM l1
), l3 AS (
  SELECT rid, l, NOT regexp_matches(l, '{BLANK}') AS filled, {_SQL_FAILS} AS fails FROM l2
), ln AS (
  SELECT rid, count(*) FILTER (filled) AS n_lines, count(*) FILTER (filled) - count(DISTINCT l) FILTER (filled) AS n_dup,
         count(*) FILTER (fails) AS n_failed,
         coalesce(sum(length(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g'))) FILTER (fails), 0) AS lost
  FROM l3 GROUP BY rid
), o AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols, n_dup::BIGINT AS n_dup_lines,
         coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines,
         n_failed::BIGINT AS n_failed_lines, lost::BIGINT AS lost_chars
  FROM d LEFT JOIN nw USING (rid) LEFT JOIN q USING (rid) JOIN ln USING (rid)
), b AS (
  SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words) AS base_failed FROM o
)
SELECT *, (NOT base_failed AND lost_chars * 100 <= word_chars * {MAX_LOST}) AS kept FROM b
"""
