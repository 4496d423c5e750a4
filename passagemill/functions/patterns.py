"""Python's regular expressions for Java's engine.

The two spell most things alike but mean different characters by ``\\s \\w \\d . $ \\b``, and read ``[`` and ``&&`` inside sets
differently. A pattern is read by Python's own parser, and each part is written with explicit Unicode sets. What Java cannot
do alike (flags, conditional groups) is refused.
"""

from __future__ import annotations

from re import _constants as op  # the parser behind re.compile; its names are op codes
from re import _parser

# The characters that count as whitespace. Java's own "\s" knows six of them and Spark's trim only U+0020.
WS_RANGES = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
WS_SET = "".join(f"\\u{lo:04x}-\\u{hi:04x}" for lo, hi in WS_RANGES)
# The intersection lets Java reject printable ASCII with one range test instead of ten.
WS = rf"[[\x00-\x20\x7f-￿]&&[{WS_SET}]]"

_WORD = r"[\p{L}\p{N}_]"
# Java looks back by whole characters beyond U+FFFF only if the look-behind's text has one, here none times.
_BACK = "\U00010000{0}"
# No match begins between the two halves of such a character.
_WHOLE = r"(?![\x{dc00}-\x{dfff}])"
_CATEGORIES = {
    op.CATEGORY_SPACE: f"[{WS_SET}]", op.CATEGORY_NOT_SPACE: f"[^{WS_SET}]",
    op.CATEGORY_DIGIT: r"\p{Nd}", op.CATEGORY_NOT_DIGIT: r"\P{Nd}",
    op.CATEGORY_WORD: _WORD, op.CATEGORY_NOT_WORD: r"[^\p{L}\p{N}_]",
}
_PLACES = {
    op.AT_BEGINNING: r"\A", op.AT_BEGINNING_STRING: r"\A", op.AT_END: r"(?=\n?\z)", op.AT_END_STRING: r"\z",
    op.AT_BOUNDARY: f"(?:(?<={_BACK}{_WORD})(?!{_WORD})|(?<!{_BACK}{_WORD})(?={_WORD}))",
    op.AT_NON_BOUNDARY: rf"(?!\A\z)(?:(?<={_BACK}{_WORD})(?={_WORD})|(?<!{_BACK}{_WORD})(?!{_WORD}))",
}
_REPEATS = {op.MAX_REPEAT: "", op.MIN_REPEAT: "?", op.POSSESSIVE_REPEAT: "+"}
_ATOMS = (op.LITERAL, op.NOT_LITERAL, op.IN, op.ANY)


def _char(code: int) -> str:
    return chr(code) if code < 128 and chr(code).isalnum() else f"\\x{{{code:x}}}"


def _set(items: list) -> str:
    if items == [(op.CATEGORY, op.CATEGORY_SPACE)]:
        return WS
    negated = "^" if items[0][0] is op.NEGATE else ""
    parts = []
    for kind, value in items[len(negated):]:
        if kind is op.LITERAL:
            parts.append(_char(value))
        elif kind is op.RANGE:
            parts.append(f"{_char(value[0])}-{_char(value[1])}")
        else:
            parts.append(_CATEGORIES[value])
    return f"[{negated}{''.join(parts)}]"


def _part(kind, value) -> str:
    if kind is op.LITERAL:
        return _char(value)
    if kind is op.NOT_LITERAL:
        return f"[^{_char(value)}]"
    if kind is op.ANY:
        return r"[^\n]"
    if kind is op.IN:
        return _set(value)
    if kind is op.AT:
        return _PLACES[value]
    if kind is op.BRANCH:
        return "(?:" + "|".join(_sequence(branch) for branch in value[1]) + ")"
    if kind is op.SUBPATTERN and not value[1] and not value[2]:
        return f"({'?:' if value[0] is None else ''}{_sequence(value[3])})"
    if kind in _REPEATS:
        low, high, repeated = value
        body = _sequence(repeated)
        if len(repeated) > 1 or repeated[0][0] not in _ATOMS:
            body = f"(?:{body})"
        return f"{body}{{{low},{'' if high is op.MAXREPEAT else high}}}{_REPEATS[kind]}"
    if kind is op.ATOMIC_GROUP:
        return f"(?>{_sequence(value)})"
    if kind in (op.ASSERT, op.ASSERT_NOT):
        direction, inner = value
        opening = "(?=" if kind is op.ASSERT else "(?!"
        if direction < 0:
            opening = f"(?<{opening[2:]}{_BACK}"
        return f"{opening}{_sequence(inner)})"
    if kind is op.GROUPREF:
        return f"(?:\\{value})"
    if kind is op.FAILURE:
        return "(?!)"
    raise ValueError(f"{str(kind).lower()} has no counterpart in Spark's regular expressions")


def _sequence(parts) -> str:
    return "".join(_part(kind, value) for kind, value in parts)


def java_pattern(pattern: str) -> str:
    """``pattern``, in Python's syntax, as a pattern that means the same to Spark's ``regexp`` functions.

    Raises ``re.error`` for what is no pattern, ``ValueError`` for flags and conditional groups. Letters and digits newer than
    the Unicode version of the Java runtime are unknown to ``\\w`` and ``\\d``.
    """
    tree = _parser.parse(pattern)
    if tree.state.flags != op.SRE_FLAG_UNICODE:
        raise ValueError(f"flags are not supported in a rule: {pattern!r}")
    plain = len(tree) > 0 and tree[0][0] is op.LITERAL
    return _sequence(tree) if plain else _WHOLE + _sequence(tree)
