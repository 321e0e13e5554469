"""Quality rules: a table of thresholds, compiled into one projection of ratios."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filter_audit import words_of

SYMBOLS = "#*$%&|<>"
_MARKS = ".,;:!?\"'()"

#: Frequent short words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "with", "as", "at", "by", "from", "this", "be", "it", "are", "on", "was",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "auch", "ist", "ein", "eine", "nicht", "auf", "dem", "im",
    "le", "la", "les", "des", "et", "un", "une", "du", "en", "que", "est", "pour", "par", "pas", "sur", "au", "de",
    "el", "los", "las", "y", "con", "por", "su", "se", "del", "al", "es", "lo", "para",
)


class Rule(NamedTuple):
    """``part`` is at least and at most so many per cent of ``whole``; both are names of metrics."""

    name: str
    part: str
    whole: str
    least: int | None
    most: int | None


#: The thresholds, in per cent. A rule holds where ``whole`` is 0 and ``least`` and ``most`` are met by 0.
RULES = (
    Rule("word_length", "word_chars", "n_words", 300, 1000),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("words_with_letters", "n_letter_words", "n_words", 80, None),
    Rule("stop_words", "n_stop_words", "n_words", 5, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 40),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
)

#: What every text must keep, whatever the table says: fixed values of the contract.
LEAST_WORDS, MOST_REPEATED = 50, 50


def _repeated(rows: str, name: str) -> Column:
    """The places of those elements of a sorted array of structs that have a neighbour of the same value."""
    same = lambda x, j: F.coalesce(x[name] == F.get(rows, j)[name], F.lit(False))
    return F.transform(F.filter(rows, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])


def metrics(docs: DataFrame, stop_words: Sequence[str] = STOP_WORDS, text: str = "text") -> DataFrame:
    """``doc`` (all columns of the document) and the metrics of its whole text, all of them whole numbers.

    Windows of three words that occur twice are found by sorting their hashes; those with equal hashes are sorted by their words, which decide.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select("doc", "t", words_of(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    follow = lambda i, k: F.get(F.col("w"), i + k)
    windows = F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(0)))
    hashed = F.transform(windows, lambda x, i: F.struct(F.xxhash64(x, follow(i, 1), follow(i, 2)).alias("h"), i.alias("i")))
    rows = rows.withColumn("hashed", F.sort_array(hashed))
    spelt = lambda i: F.struct(F.concat_ws(" ", follow(i, 0), follow(i, 1), follow(i, 2)).alias("g"), i.alias("i"))
    rows = rows.withColumn("spelt", F.sort_array(F.transform(_repeated("hashed", "h"), spelt))).drop("hashed")
    rows = rows.withColumn("again", F.sort_array(_repeated("spelt", "g"))).drop("spelt")
    # A window adds the words up to the next such window, three at most.
    new = F.transform("again", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("again", j + 1) - i, F.lit(3))))
    bare = F.split(F.lower(F.translate("t", _MARKS, "")), r"[\x20\x09-\x0D]+")
    count = lambda column, holds: F.size(F.filter(column, holds)).cast("long")
    without = lambda symbols: F.char_length(F.translate("t", symbols, ""))
    return rows.select(
        "doc", F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        without(" \t\n\x0b\f\r").cast("long").alias("word_chars"), (F.char_length("t") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(new, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"),
        F.regexp_count("t", F.lit(r"\p{L}[^\x20\x09-\x0D]*+")).cast("long").alias("n_letter_words"), count(bare, lambda w: w.isin(*stop_words)).alias("n_stop_words"),
        count("lines", lambda line: F.rtrim(line).endswith("...") | F.rtrim(line).endswith("…")).alias("n_ellipsis_lines"),
        count("lines", lambda line: F.ltrim(line).rlike(r"\A[-*•]")).alias("n_bullet_lines"),
    )


def broken(rule: Rule) -> Column:
    """Whether metrics break a rule; whole numbers, so nothing is rounded."""
    part, whole = 100 * F.col(rule.part), F.col(rule.whole)
    bounds = [part < rule.least * whole] * (rule.least is not None) + [part > rule.most * whole] * (rule.most is not None)
    return bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, stop_words: Sequence[str] = STOP_WORDS, text: str = "text") -> DataFrame:
    """Metrics, ``base_failed``, ``broken`` (the names of the rules that a text breaks, in their order) and ``kept`` of each document.

    The rules become one projection without user functions. A null or blank text has no words: it fails the base, and all metrics but
    ``n_symbols`` are 0. Rows are independent, so repeated rows and ties need nothing special; an empty table gives no rows. Texts in
    languages without ``stop_words`` break that rule.
    """
    rows = metrics(docs, stop_words, text)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    names = F.array_compact(F.array(*(F.when(broken(rule), F.lit(rule.name)) for rule in rules))) if rules else F.array().cast("array<string>")
    fine = ~failed
    for rule in rules:
        fine = fine & ~broken(rule)
    return rows.select("*", failed.alias("base_failed"), names.alias("broken"), fine.alias("kept"))


def _sql_rule(rule: Rule) -> str:
    bounds = [f"100 * {rule.part} < {rule.least} * {rule.whole}"] * (rule.least is not None) + [f"100 * {rule.part} > {rule.most} * {rule.whole}"] * (rule.most is not None)
    return " OR ".join(bounds)


ORACLE = rf"""
WITH w AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), o AS (
    SELECT r, unnest(words) AS x, generate_subscripts(words, 1) AS i FROM w
), g AS (
    SELECT r, i, x AS a, lead(x) OVER n AS b, lead(x, 2) OVER n AS c FROM o WINDOW n AS (PARTITION BY r ORDER BY i)
), n AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM g WHERE c IS NOT NULL
), c AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM n, (VALUES (0), (1), (2)) AS k(k) WHERE n > 1 GROUP BY r
), m AS (
    SELECT doc_id, len(words) AS n_words, len(lines) AS n_lines, length(array_to_string(words, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
        len(list_filter(regexp_extract_all(lower(regexp_replace(t, '[.,;:!?"''()]', '', 'g')), '[^\x20\x09-\x0D]+'), lambda x: x IN {STOP_WORDS})) AS n_stop_words,
        len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…) *$'))) AS n_ellipsis_lines,
        len(list_filter(lines, lambda l: regexp_matches(l, '^ *[-*•]'))) AS n_bullet_lines
    FROM w LEFT JOIN c USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
    NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words OR {" OR ".join(map(_sql_rule, RULES))}) AS kept
FROM m
"""
