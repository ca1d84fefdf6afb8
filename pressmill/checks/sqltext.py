"""Small builders for the oracle SQL (plain SQL, RE2 patterns)."""

from pressmill.functions.text import SPACE, SPACE_CHARS, STRICT_KEEP

DATE_FMT = "%Y-%m-%d %H:%M:%S"


def q(text):
    return "'" + text.replace("'", "''") + "'"


def sub(x, pattern, to):
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def strip(x):
    return f"trim({x}, {q(SPACE_CHARS)})"


def collapse(x):
    return strip(sub(x, SPACE + "+", " "))


def no_tags(x):
    return f"replace(replace({x}, '&quot;', '\"'), '&amp;', '&')"


def entities(x):
    for name, char in [("quot", '"'), ("copy", "©"), ("middot", "·"), ("#233", "é"), ("eacute", "é"), ("amp", "&")]:
        x = f"replace({x}, '&{name};', {q(char)})"
    return x


def markup_text(x):
    x = sub(x, r"(?s)<!--.*?-->", "")
    for tag in ("script", "style"):
        x = sub(x, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", "")
    return entities(sub(x, r"<[/!?A-Za-z][^>]*>", " "))


def element_text(x):
    return collapse(markup_text(x))


def clean_strict(x):
    t = f"case when contains({x}, '<') and contains({x}, '>') then {markup_text(x)} else {x} end"
    t = sub(sub(t, STRICT_KEEP, ""), r"\?{2,}" + SPACE + "*", " ")
    t = collapse(f"translate({t}, concat(chr(13), chr(10), chr(9), '\"“”|'), '   ''''''-')")
    return t


def grp(x, pattern, i=1):
    return f"nullif(regexp_extract({x}, {q(pattern)}, {i}), '')"


def ts(y, m, d, hh="0", mm="0", ss="0"):
    return (f"try_strptime(concat(lpad({y}, 4, '0'), '-', {m}, '-', {d}, ' ', {hh}, ':', {mm}, ':', {ss}), "
            f"'{DATE_FMT}')")


def show(x):
    return f"strftime({x}, '{DATE_FMT}')"
