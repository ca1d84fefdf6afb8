"""Markup handling as column expressions (no Python in the row path)."""

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.functions import text as X

# All named references of HTML 5, from the standard library's table.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
# Numbers 128 to 159 mean the characters that Windows has there.
WINDOWS = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}
# Elements whose content never counts as text.
SILENT_TAGS = ["script", "style", "noscript", "template"]
TAG = r"<[/!?A-Za-z][^>]*>"
INLINE_TAG = (r"(?i)</?(?:a|abbr|b|big|cite|code|em|font|i|ins|mark|q|s|small|span|strong|sub|sup|time|u)"
              r"(?:\s[^>]*)?/?>")


def _code_point(name: Column) -> Column:
    digits = F.when(name.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substring(name, 3, 8), 16, 10)) \
              .when(name.rlike("^#[0-9]{1,7}$"), F.substring(name, 2, 8))
    n = digits.cast("int")
    ok = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    return F.when(n.between(128, 159), F.try_element_at(X.literal_map(WINDOWS), n.cast("string"))).otherwise(
        F.when(ok, F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")))


def decode_entities(c: Column) -> Column:
    """Character references to characters; unknown names stay. Ampersands are put back
    last, so that one pass never decodes its own output."""
    table = X.literal_map(ENTITIES)
    ampersand = ["amp", "#38", "#x26", "#X26"]

    def put(acc, n):
        ref = F.concat(F.lit("&"), n, F.lit(";"))
        return F.replace(acc, ref, F.coalesce(F.try_element_at(table, n), _code_point(n), ref))

    def decode(text):
        names = F.array_distinct(F.regexp_extract_all(text, F.lit("&(#?[0-9A-Za-z]+);"), F.lit(1)))
        ordered = F.sort_array(F.transform(names, lambda n: F.struct(n.isin(ampersand).alias("late"), n.alias("n"))))
        return F.aggregate(ordered, text, lambda acc, x: put(acc, x["n"]))

    # most texts have no reference at all, so they skip the fold
    return X.bind(c, lambda text: F.when(F.instr(text, "&") > 0, decode(text)).otherwise(text))


def drop_comments(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<!--.*?-->", "")


def drop_elements(c: Column, tags) -> Column:
    """Remove whole elements of the given (non-nesting) tag names, in one pass."""
    return F.regexp_replace(c, rf"(?is)<({'|'.join(tags)})(?:\s[^>]*)?>.*?</\1\s*>", "")


def drop_silent(c: Column) -> Column:
    """Remove comments and elements whose content is never text, in one pass."""
    return F.regexp_replace(
        c, rf"(?is)<(?:!--.*?--|({'|'.join(SILENT_TAGS)})(?:\s[^>]*)?>.*?</\1\s*)>", "")


def drop_class(c: Column, tag: str, part: str) -> Column:
    """Remove flat ``tag`` elements whose class attribute contains ``part``."""
    return F.regexp_replace(
        c, rf'(?is)<{tag}\s[^>]*class="[^"]*{part}[^"]*"[^>]*>.*?</{tag}\s*>', "")


def markup_to_text(c: Column) -> Column:
    """Text of a markup fragment, one blank in place of each tag."""
    return decode_entities(F.regexp_replace(drop_silent(c), TAG, " "))


def inline_text(c: Column) -> Column:
    """Text as a reader sees it: inline tags vanish, other tags separate words. For markup
    without comments and scripts."""
    return X.collapse(decode_entities(F.regexp_replace(F.regexp_replace(c, INLINE_TAG, ""), TAG, " ")))


def element_text(c: Column) -> Column:
    return inline_text(drop_silent(c))


def first_element(c: Column, tag: str) -> Column:
    """Inner markup of the first ``tag`` element; null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1), F.lit(""))


def first_with_class(c: Column, tag: str, part: str) -> Column:
    """Inner markup of the first flat ``tag`` element whose class contains ``part``."""
    pattern = rf'(?is)<{tag}\s[^>]*class="[^"]*{part}[^"]*"[^>]*>(.*?)</{tag}\s*>'
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def attribute(c: Column, tag: str, marker: str, name: str) -> Column:
    """Attribute ``name`` of the first ``tag`` whose start tag holds ``marker``."""
    start = F.regexp_extract(c, rf"(?is)(<{tag}\s[^>]*{marker}[^>]*>)", 1)
    value = F.regexp_extract(start, rf'(?is)\s{name}\s*=\s*"([^"]*)"', 1)
    return F.when(value != "", value)


def block_texts(c: Column, tag: str = "p") -> Column:
    """Texts of all ``tag`` blocks in order; a start tag closes an open block of its kind.
    Comments and scripts must be gone already."""
    pieces = F.split(c, rf"(?i)<{tag}(?:\s[^>]*)?>")
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(pieces, lambda p: inline_text(
        F.regexp_replace(p, rf"(?is)</{tag}\s*>.*", "")))
