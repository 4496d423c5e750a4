"""Text-cleaning column functions.

Everything here is a Catalyst expression except the markup parser, which is an Arrow UDF that
only ever receives rows that hold markup (see ``functions/markup.py``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from passagemill.functions.markup import UNKNOWN_MARK, has_markup, strip_markup
from passagemill.functions.patterns import WS, WS_RANGES, WS_SET, java_pattern

WS_CHARS = "".join(chr(c) for lo, hi in WS_RANGES for c in range(lo, hi + 1))

# The cleanup rules, applied in this order. The last pattern is the short form of
# "lazily up to the first run of semicolons"; the apostrophe rule changes nothing.
RULES: tuple[tuple[str, str], ...] = (
    (r" \?", "?"),
    (r" !", "!"),
    (r" \.", "."),
    (r" ,", ","),
    (r" ;", ";"),
    (r" :", ":"),
    (r" --", ""),
    (r" \.\. \.", "..."),
    (r" n't", "n't"),
    (r" &", "&"),
    (r"\(\s+", "("),
    (r"\s+\)", ")"),
    (r"'\s+", "'"),
    (r"\s+'", "'"),
    (r"'", "'"),
    (r"&;", ""),
    (r"\*\*[^\s;]*;+", ""),
)


def strip_ws(c: Column) -> Column:
    """Remove Unicode whitespace at both ends.

    Trimming a set of characters on the right makes Spark walk the whole text, so text whose last byte
    is printable ASCII is spared that.
    """
    left = F.ltrim(c, F.lit(WS_CHARS))
    last_byte = F.substring(left.cast("binary"), -1, 1)
    visible = last_byte.between(F.lit(b"\x21"), F.lit(b"\x7e"))
    return F.when(visible, left).otherwise(F.rtrim(left, F.lit(WS_CHARS)))


def collapse_ws(c: Column) -> Column:
    """Turn each run of Unicode whitespace into one space.

    The pattern leaves out runs that already are one space, so ordinary prose has few matches and
    text without any is returned as it is.
    """
    return F.regexp_replace(c, f"{WS}(?:(?<! )|(?={WS})){WS}*+", " ")


def mask_redactions(c: Column, mask: str = UNKNOWN_MARK) -> Column:
    """Replace each run of ``@`` marks, with the blanks after them, by one marker."""
    return F.regexp_replace(c, f"@[@{WS_SET}]*+", mask)


def _literal(pattern: str) -> str | None:
    """The text a pattern stands for when it is a plain literal, else None."""
    if re.search(r"[\\^$.|?*+()\[\]{}]", re.sub(r"\\[.?]", "", pattern)):
        return None
    return pattern.replace("\\", "")


def apply_rules(c: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Apply (pattern, replacement) rules one after the other.

    Patterns have Python's syntax and meaning (see ``java_pattern``); replacements are taken as they are. Literal patterns
    become ``replace`` (a byte search), the others ``regexp_replace``. The built-in list takes a shorter way to the same result.
    """
    if rules is RULES:
        return _apply_builtin_rules(c)
    for pattern, replacement in rules:
        text = _literal(pattern)
        if text is None:
            c = F.regexp_replace(c, java_pattern(pattern), re.sub(r"([\\$])", r"\\\1", replacement))
        elif text != replacement:
            c = F.replace(c, F.lit(text), F.lit(replacement))
    return c


def _only_with(c: Column, chars: Sequence[str], change: Callable[[Column], Column]) -> Column:
    """``change`` the text only if it has one of ``chars``: a byte search is far cheaper than a regex.

    The one-element array gives ``c`` a name, so that it is computed once and not once per use.
    """
    def guarded(text: Column) -> Column:
        present = reduce(Column.__or__, [F.contains(text, F.lit(char)) for char in chars])
        return F.when(present, change(text)).otherwise(text)

    return F.get(F.transform(F.array(c), guarded), F.lit(0))


def _apply_builtin_rules(c: Column) -> Column:
    """RULES in fewer passes over the text.

    The first six each delete the one space in front of a different character, so none can make or
    break a match of another and one look-ahead does all six. The four bracket and quote rules
    delete whole whitespace runs next to a character that stays, which is one pass as well; the
    look-behind keeps it linear on long runs.
    """
    c = F.regexp_replace(c, " (?=[?!.,;:])", "")
    c = F.replace(c, F.lit(" --"), F.lit(""))
    c = F.replace(c, F.lit(" .. ."), F.lit("..."))
    c = F.replace(c, F.lit(" n't"), F.lit("n't"))
    c = F.replace(c, F.lit(" &"), F.lit("&"))
    brackets = f"([('])(?:{WS})++|{WS}(?<!{WS}{WS}){WS}*+(?=[)'])"
    c = _only_with(c, ("(", ")", "'"), lambda text: F.regexp_replace(text, brackets, "$1"))
    c = F.replace(c, F.lit("&;"), F.lit(""))
    return _only_with(c, ("**",), lambda text: F.regexp_replace(text, rf"\*\*[^{WS_SET};]*+;++", ""))


def strip_inline_markup(c: Column, mode: str = "parser") -> Column:
    """Strip, mask redactions and drop markup; whitespace is collapsed only if markup changed the text.

    The redaction marker itself looks like a tag, so it goes away together with the real tags and
    survives only where nothing else is left. Rows without markup need no parser for that.
    """
    text = strip_ws(c)
    unmarked = mask_redactions(text, "")
    plain = F.when(~F.contains(text, F.lit("@")), text).otherwise(
        F.when(unmarked == "", F.lit(UNKNOWN_MARK)).otherwise(strip_ws(collapse_ws(unmarked)))
    )
    masked = F.when(has_markup(text), mask_redactions(text))
    parsed = strip_markup(masked, mode)
    kept = F.when((parsed != "") & (parsed != masked), strip_ws(collapse_ws(parsed))).otherwise(masked)
    return F.when(has_markup(text), kept).otherwise(plain)


def clean_text(c: Column, mode: str = "parser", rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The full cleaner: strip, redaction marks, markup, rule chain, collapse, strip."""
    text = strip_inline_markup(c.cast("string"), mode)
    return strip_ws(collapse_ws(apply_rules(text, rules)))
