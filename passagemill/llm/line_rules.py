"""Line-first cleaning with DataFrame functions only.

Each line is held against punctuation, navigation and boilerplate rules; failing lines are taken out, and a document that
loses too much text by it is rejected. Base measures of the whole text (words, symbols, repeated lines and windows) reject
first. Everything is a projection of one row: no shuffle, no Python, no window; memory follows the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_KEPT_PERCENT = 50
#: A line with more decoration than this share of its words fails the punctuation rule.
MAX_MARKS_PER_WORD = 0.5
#: A line with this many separators, and this share of its words, fails the navigation rule.
NAV_SEPARATORS = 2
NAV_SHARE = 0.2
WORD_BREAK = r"[\x20\x09-\x0D]+"
TERMINAL = r"[.!?:;…。！？][\"'”’»)\]]*\z"
# Fixed value: phrases of lines that belong to a site, not to its text.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "enable javascript", "licensed under", "log in to", "powered by",
    "privacy policy", "sign up for", "subscribe to our", "terms of service", "terms of use", "use of cookies",
)


def words(text: Column) -> Column:
    """Runs of characters other than blank and U+0009 to U+000D; null: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def _count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, characters, ""))


def judge_line(line: Column) -> Column:
    """A struct of the line and whether each rule fails it. The line is stripped and not empty."""
    n_words = F.size(F.split(line, WORD_BREAK))
    marks, separators = _count_of(line, r"[#*$%&<>!^~_=]"), _count_of(line, "[|»›·•]")
    low = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | F.contains(low, F.lit(phrase))
    return F.struct(
        line.alias("line"),
        (~line.rlike(TERMINAL) | (marks > MAX_MARKS_PER_WORD * n_words)).alias("punctuation"),
        ((separators >= NAV_SEPARATORS) & (separators >= NAV_SHARE * n_words)).alias("navigation"),
        boilerplate.alias("boilerplate"),
    )


def with_repeat_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words: how many words of ``words`` lie in a 3-word window that occurs twice or more, the first included.

    A window's hash and position share one long, so equal windows are neighbours after one sort of longs; neighbours are
    then compared word by word.
    """
    at = lambda array, i: F.get(array, i)
    low = lambda x: x.bitwiseAND(F.expr("shiftleft(1L, bits) - 1L")).cast("int")
    windows = F.when(F.size("words") >= 3, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(F.array().cast("array<int>"))
    hashed = lambda i: F.xxhash64(*(at(F.col("words"), i + k) for k in range(3)))
    keyed = docs.withColumn("bits", F.length(F.bin(F.size("words").cast("long"))).cast("int")).withColumn(
        "keys", F.transform(windows, lambda i: F.call_function("shiftleft", hashed(i), F.col("bits")).bitwiseOR(i.cast("long")))
    )
    keyed = keyed.withColumn("keys", F.sort_array("keys"))
    head = lambda i: F.call_function("shiftright", at(F.col("keys"), i), F.col("bits"))

    def same(i: Column) -> Column:
        p, q = low(at(F.col("keys"), i)), low(at(F.col("keys"), i - 1))
        equal = head(i) == head(i - 1)
        for k in range(3):
            equal = equal & (at(F.col("words"), p + k) == at(F.col("words"), q + k))
        return equal

    later = F.when(F.size("keys") >= 2, F.sequence(F.lit(1), F.size("keys") - 1)).otherwise(F.array().cast("array<int>"))
    found = keyed.withColumn("pairs", F.filter(later, same))
    starts = F.flatten(F.transform("pairs", lambda i: F.array(low(at(F.col("keys"), i)), low(at(F.col("keys"), i - 1)))))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2))))
    return found.withColumn("n_repeat_words", F.size(covered).cast("long")).drop("bits", "keys", "pairs")


def clean_documents(docs: DataFrame) -> DataFrame:
    """Measures, verdict and cleaned text for each row of ``docs`` (doc_id, text, whatever else there is).

    doc_id; n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; base_failed; lines failing each rule:
    n_punctuation_lines, n_navigation_lines, n_boilerplate_lines; text_chars and kept_chars of the stripped lines before and
    after; kept; cleaned_text. Null and empty texts have no words and fail the base rules. Repeated rows stay repeated, rows
    without doc_id are judged like any other. Empty input: no rows.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    split = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    own = docs.select("doc_id", text).select("doc_id", "text", words(F.col("text")).alias("words"), split.alias("lines"))
    own = with_repeat_words(own)
    strip = lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r"))
    own = own.withColumn("judged", F.transform(F.transform("lines", strip), judge_line))
    failing = lambda rule: F.size(F.filter("judged", lambda x: x[rule])).cast("long").alias(f"n_{rule}_lines")
    good = F.filter("judged", lambda x: ~(x["punctuation"] | x["navigation"] | x["boilerplate"]))
    own = own.withColumn("cleaned_text", F.array_join(F.transform(good, lambda x: x["line"]), "\n"))
    measured = own.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count_of(F.col("text"), "[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        *(failing(rule) for rule in ("punctuation", "navigation", "boilerplate")),
        F.char_length(F.array_join(F.transform("judged", lambda x: x["line"]), "\n")).cast("long").alias("text_chars"),
        F.char_length("cleaned_text").cast("long").alias("kept_chars"),
        "cleaned_text",
    )
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    enough = 100 * F.col("kept_chars") >= MIN_KEPT_PERCENT * F.col("text_chars")
    return measured.withColumn("base_failed", base).withColumn("kept", ~base & enough)
