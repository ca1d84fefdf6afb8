"""Text cleaning as column expressions."""

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.schema import STRIP_EXEMPT_TOKENS

# Every character Unicode calls white space, as a class both regex engines read alike.
SPACE = (r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    + "".join(chr(c) for c in range(0x2000, 0x200b))
    + "    　"
)
# The same characters as the engine's own class, which it tests much faster.
RUN = r"(?U)[\s\x1c-\x1f]"
TAG = r"<[^>]+>"
WORD = r"[\p{L}\p{M}\p{N}_]"

# Fixed values of the strict cleaner.
STRICT_KEEP = (r"[^\p{L}\p{N}_\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
               r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}.,;:!?\-()" + "\"'/¿¡]")
_STRICT_FAST = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f.,;:!?\-()" + "\"'/¿¡]"
# Longest cell of a spreadsheet export, and what marks a cut one.
CELL_LIMIT = 30000
CELL_SUFFIX = "... [truncado]"


def literal_map(table) -> Column:
    """Constant map of texts: one literal, which the optimizer folds."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def bind(c, fn) -> Column:
    """``fn(c)`` with ``c`` computed once per row, however often ``fn`` uses it.

    Without it an expensive ``c`` is repeated inside the generated code for every use."""
    return F.element_at(F.transform(F.array(c), fn), 1)


def once(**columns) -> Column:
    """The given columns behind a generator, for use in ``select``.

    Filters are pushed below ordinary projections and then repeat the expressions they
    test; they are not pushed below a generator, so costly columns are computed once."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))


def strip(c) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def is_blank(c) -> Column:
    return strip(c) == ""


def collapse(c) -> Column:
    return strip(F.regexp_replace(c, RUN + "+", " "))


def clean_block(c) -> Column:
    """Blanks and tabs to one blank, three or more line ends to two, ends trimmed."""
    c = F.regexp_replace(c, r"[ \t]+", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def clean_line(c) -> Column:
    """One line: any white space to one blank; null becomes empty."""
    return F.coalesce(collapse(c), F.lit(""))


def has_markup(c) -> Column:
    return c.rlike(TAG)


def strip_markup(c) -> Column:
    """Tags out, runs of white space to one blank; null-like texts stay as they are."""
    cleaned = strip(F.regexp_replace(F.regexp_replace(c, TAG, " "), RUN + "{2,}", " "))
    keep = c.isNull() | (c == "") | strip(c).isin(STRIP_EXEMPT_TOKENS)
    return F.when(keep, c).otherwise(cleaned)


def spreadsheet_cell(c, limit=CELL_LIMIT) -> Column:
    """A text cut to what a spreadsheet cell holds; only for such exports."""
    return F.regexp_replace(c, rf"(?s)^(.{{{limit}}}).+$", "$1" + CELL_SUFFIX)


def clean_strict(c) -> Column:
    """Single spreadsheet-safe line, whole: markup, rare symbols, double quotes and pipes gone."""
    from pressmill.functions.html import markup_to_text

    text = F.when(c.contains("<") & c.contains(">"), markup_to_text(c)).otherwise(c)
    text = F.regexp_replace(text, _STRICT_FAST, "")
    text = F.regexp_replace(text, r"\?{2,}" + SPACE + "*", " ")
    # curly quotes and pipes went with the rare symbols; line ends go with the white space
    text = F.replace(text, F.lit('"'), F.lit("'"))
    return F.coalesce(collapse(text), F.lit(""))


def section_slug(c, drop_plus=False) -> Column:
    c = F.lower(collapse(c))
    if drop_plus:
        c = F.regexp_replace(c, r"^\+ *", "")
    c = F.translate(c, "áéíóú", "aeiou")
    return F.btrim(F.regexp_replace(c, SPACE + "+", "-"), F.lit("-"))


def title_case(c) -> Column:
    """Capital after every non-letter, as in headings built from slugs."""
    parts = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    words = F.transform(parts, lambda w: F.concat(
        F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))))
    return F.array_join(words, "")


def drop_list_number(c) -> Column:
    return F.regexp_replace(c, r"^\d+\." + SPACE + "*", "")


def soft_null(c, tokens) -> Column:
    """Null when the text is one of the given null spellings."""
    return F.when(~c.isin(list(tokens)), c)
