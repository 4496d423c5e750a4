"""Markup to text: an HTML parser for the rows that need one, and a regex mode.

``mode='parser'`` (the default) follows the event stream of the standard library's HTML parser and
keeps the text outside comments, declarations, processing instructions and the containers below.
``mode='native'`` stays inside Catalyst and agrees on well-formed markup; it does not know about
``>`` inside attribute values or about containers left open.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser
from zlib import crc32

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The parser travels inside the UDF, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN_MARK = "<unk>"

# Elements whose text is not shown, and elements that never have content.
HIDDEN_CONTAINERS = ("rp", "rt", "script", "style", "template")
VOID_ELEMENTS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)

# Name -> character for every named reference, without the closing semicolon.
NAMED_REFERENCES = {name.rstrip(";"): value for name, value in html5.items()}


def has_markup(c: Column) -> Column:
    """True when the text can change under the parser: a ``<``, or an ``&`` that opens a reference."""
    return F.contains(c, F.lit("<")) | (F.contains(c, F.lit("&")) & F.rlike(c, F.lit("&[a-zA-Z#]")))


def numeric_reference(name: str) -> str:
    """Character for the body of a numeric reference (``233``, ``xe9``).

    Numbers below 256 are read as Windows-1252, as browsers do; impossible ones become U+FFFD.
    """
    number = int(name[1:].lstrip("xX"), 16) if name[:1] in "xX" else int(name)
    if number < 256:
        try:
            return bytes([number]).decode("windows-1252")
        except UnicodeDecodeError:
            return chr(number)
    if number > 0x10FFFF or 0xD800 <= number <= 0xDFFF:
        return "�"
    return chr(number)


class _VisibleText(HTMLParser):
    """Collects the visible text; open elements are kept so that a hidden container ends with its parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.parts: list[str] = []
        self.open: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag not in VOID_ELEMENTS:
            self.open.append(tag)
            self.hidden += tag in HIDDEN_CONTAINERS

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if tag in self.open:
            while True:
                closed = self.open.pop()
                self.hidden -= closed in HIDDEN_CONTAINERS
                if closed == tag:
                    break

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)

    def handle_charref(self, name):
        self.handle_data(numeric_reference(name))

    def handle_entityref(self, name):
        self.handle_data(NAMED_REFERENCES.get(name, "&" + name))

    def unknown_decl(self, data):
        if data[:6].upper() == "CDATA[":
            self.handle_data(data[6:])


def visible_text(markup: str) -> str:
    """Text of one piece of markup; text that the parser refuses is returned as it is."""
    parser = _VisibleText()
    try:
        parser.feed(markup)
        parser.close()
    except Exception:
        return markup
    return "".join(parser.parts)


#: Bytes of text, about, that are Python strings at once: a batch stays in Arrow and is parsed and handed on piece by piece.
PIECE_BYTES = 2 << 20


@F.arrow_udf(StringType())
def _parse_markup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The visible text of each text, nulls as they are, in pieces of about ``PIECE_BYTES`` of input."""
    for texts in batches:
        rows = max(1, len(texts) * PIECE_BYTES // max(1, texts.nbytes))
        for at in range(0, len(texts), rows):
            piece = texts.slice(at, rows).to_pylist()
            yield pa.array([None if t is None else visible_text(t) for t in piece], texts.type)


_REFERENCE = "&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[a-zA-Z][-.a-zA-Z0-9]*;?"
# Comments, hidden containers, declarations and instructions, tags.
_HIDDEN = "|".join(rf"(?i:<{name}\b[^>]*>.*?</{name}\s*>)" for name in HIDDEN_CONTAINERS)
_MARKUP = rf"<!--.*?-->|{_HIDDEN}|<[!?][^>]*>|</?[a-zA-Z][^>]*>"
_WINDOWS_1252 = {
    str(n): bytes([n]).decode("windows-1252") for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
}


_BUCKETS = 4096


def _lookup(table: dict[str, str], key: Column) -> Column:
    """Value for ``key``, null if there is none, in a time that does not depend on the size of the table.

    The table is one literal, folded once: an array of maps of a few names each, as Spark searches a map from its first key on.
    """
    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for name, value in table.items():
        buckets[crc32(name.encode()) % _BUCKETS][name] = value
    bucket = (F.crc32(key.cast("binary")) % _BUCKETS).cast("int")
    return F.try_element_at(F.get(F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>"), bucket), key)


def _decode_reference(ref: Column) -> Column:
    body = F.regexp_replace(ref, "^&#?|;$", "")
    digits = F.regexp_replace(body, "^[xX]0*|^0+(?=.)", "")
    number = F.when(
        F.rlike(ref, F.lit("^&#[xX]")),
        F.when(F.length(digits) > 6, F.lit(0x110000)).otherwise(F.conv(digits, 16, 10).cast("long")),
    ).otherwise(F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(digits.cast("long")))
    number = F.coalesce(number, F.lit(0))
    valid = (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(0xFFFD)), 8, "0")), "utf-32")
    numeric = F.coalesce(_lookup(_WINDOWS_1252, number.cast("string")), char)
    named = F.coalesce(
        _lookup(NAMED_REFERENCES, body),
        F.concat(F.lit("&"), body),
    )
    return F.when(F.startswith(ref, F.lit("&#")), numeric).otherwise(named)


def _rewrite_matches(c: Column, pattern: str, rewrite) -> Column:
    """Split around the matches of ``pattern``, rewrite each match and put the text together again."""
    pattern = f"(?s)((?=[<&])(?:{pattern}))"
    rewritten = F.transform(F.regexp_extract_all(c, F.lit(pattern)), rewrite)
    pieces = F.zip_with(F.split(c, pattern, -1), rewritten, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.array_join(pieces, "")


def html_unescape(c: Column) -> Column:
    """Decode character references without leaving Catalyst."""
    return F.when(F.contains(c, F.lit("&")), _rewrite_matches(c, _REFERENCE, _decode_reference)).otherwise(c)


def _drop_tag_or_decode(match: Column) -> Column:
    return F.when(F.startswith(match, F.lit("<")), F.lit("")).otherwise(_decode_reference(match))


def strip_markup(c: Column, mode: str = "parser") -> Column:
    """Visible text of ``c``."""
    if mode == "parser":
        return _parse_markup(c)
    if mode == "native":
        # Tags and references in one scan: a reference ends where a tag begins, and text that a
        # reference decodes to is never read as a tag.
        return _rewrite_matches(c, f"{_MARKUP}|{_REFERENCE}", _drop_tag_or_decode)
    raise ValueError(f"mode must be 'parser' or 'native', not {mode!r}")
