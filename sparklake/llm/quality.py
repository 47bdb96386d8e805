"""Line-first quality rules, in DataFrame functions only.

Each line is judged by itself: a line fails as unpunctuated (short and without a sentence mark at
its end), as navigation (a list of links) or as boilerplate (a phrase that pages repeat). Failing
lines go, and a document is rejected if it loses too much of its text that way, or if the base
counts already fail it. All of it is one pass over the rows without a shuffle.

Cases: a null or empty text has zero counts and fails the base rule (fewer than 50 words); lines
without a word neither fail nor count as duplicates; repeated rows are judged alike; columns
beside id and text are left out of the counts and pass through ``clean`` whatever their names.
Windows of three words are compared by 64-bit hashes within a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[^#*$%&|<>]+"
MIN_WORDS = 50
MAX_LOST = 0.5  # share of the characters in words that failing lines may hold
SHORT_LINE = 6  # a line of at least so many words needs no mark at its end

# fixed values: what a sentence ends with, what links are listed with, what pages repeat
ENDS = r"[.!?:;,…。！？]['\"”’»)\]]*\s*$"
LINKS = r"(^|\s)[|»›•·→](\s.*\s[|»›•·→]){2}(\s|$)"
MENU = (
    r"(?i)^\s*(home|menu|login|log in|sign in|sign up|register|search|share|next|previous|back|top|"
    r"contact|about|help|faq|sitemap|read more|skip to content)(\s+(home|menu|login|search|share|next|"
    r"previous|back|top|contact|about|help|faq|sitemap))*\s*$"
)
BOILERPLATE = (
    r"(?i)all rights reserved|terms of (use|service)|privacy policy|use of cookies|cookie policy|"
    r"accept cookies|enable javascript|javascript is disabled|lorem ipsum|subscribe to our|click here to|powered by"
)


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks one of the rules."""
    short = F.size(F.split(F.regexp_replace(line, f"^{SPACE}+|{SPACE}+$", ""), f"{SPACE}+")) < SHORT_LINE
    unpunctuated = short & ~line.rlike(ENDS)
    return line.rlike(WORD) & (unpunctuated | line.rlike(LINKS) | line.rlike(MENU) | line.rlike(BOILERPLATE))


def _chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, f"{SPACE}+", "")).cast("bigint")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as the struct ``row``, with the base counts and what the line rules leave."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), whole.alias("text"))
    df = df.select(
        "row",
        "text",
        F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "").alias("words"),
        F.split("text", "\n").alias("lines"),
    )
    df = df.select(
        "row",
        "text",
        "words",
        F.filter("lines", lambda x: x.rlike(WORD)).alias("worded"),
        F.filter("lines", lambda x: ~line_fails(x)).alias("stay"),
        F.when(
            F.size("words") >= 3,
            F.transform(
                F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
                lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    # only texts that repeat a window are sorted to find which
    df = df.withColumn(
        "sorted",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    at = F.transform(
        F.filter(
            "sorted",
            lambda x, k: (F.get("sorted", k - 1)["h"] == x["h"]) | (F.get("sorted", k + 1)["h"] == x["h"]),
        ),
        lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2),
    )
    return df.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.char_length(F.regexp_replace("text", SYMBOL, "")).cast("bigint").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.array_distinct(F.flatten(at))).cast("bigint").alias("n_repeat_words"),
        _chars(F.array_join("stay", "\n")).alias("chars_left"),
        F.array_join("stay", "\n").alias("cleaned"),
    )


def judged(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    enough = F.col("chars_left") >= (1 - max_lost) * F.col("word_chars")
    df = measured(docs, text).withColumn("base_failed", failed)
    return df.withColumn("kept", ~F.col("base_failed") & enough)


def clean(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that are kept, with their failing lines removed."""
    kept = judged(docs, text, max_lost).where("kept")
    return kept.select(*[F.col("cleaned").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op3(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return judged(docs.select("doc_id", "text")).select("row.doc_id", *COLUMNS)


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


_BLANK, _END = f"^{SPACE}+|{SPACE}+$", _sql(ENDS)
ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS w,
    string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
c AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1)
  GROUP BY doc_id),
l AS (
  SELECT doc_id, line, regexp_matches(line, '{WORD}') AS worded,
    len(regexp_split_to_array(regexp_replace(line, '{_BLANK}', '', 'g'), '{SPACE}+')) < {SHORT_LINE}
      AND NOT regexp_matches(line, '{_END}')
      OR regexp_matches(line, '{_sql(LINKS)}') OR regexp_matches(line, '{_sql(MENU)}')
      OR regexp_matches(line, '{_sql(BOILERPLATE)}') AS bad
  FROM (SELECT doc_id, unnest(lines) AS line FROM d)),
k AS (
  SELECT doc_id,
    count(*) FILTER (worded) - count(DISTINCT line) FILTER (worded) AS dup,
    coalesce(sum(length(regexp_replace(line, '{SPACE}+', '', 'g'))) FILTER (NOT (worded AND bad)), 0) AS left_chars
  FROM l GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '{SYMBOL}', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, left_chars
  FROM d LEFT JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND left_chars >= {1 - MAX_LOST} * word_chars AS kept
FROM b
"""
