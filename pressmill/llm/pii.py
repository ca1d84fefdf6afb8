"""Surrogates for personal data: detected entities get keyed replacements of the same type and form.

A surrogate depends on a secret key, the kind, the normal form of the entity and an attempt number, and
nothing else, so one entity has one surrogate in every text (written in each place's own layout), and a
task can compute it alone. All distinct entities of the table are then checked together: where two
share a surrogate, or one equals a real entity, all but the first move to the next attempt until
nothing collides; late attempts leave the form's length, so there is always room. Only these exceptions are joined to the texts that hold them.

Digits become digits and letters letters of the same case and script (numbers written in digits of another
script are the same entity); a card number stays valid or invalid
(Luhn), an address keeps its octets in range, a phone its country code, an e-mail its last label, a
name its script and the gender its title tells. Names are matched word by word, so "Mrs Ada Byron" and "Mrs Byron"
stay one family; where a text names someone with a title, later or earlier mentions of the full or the family
name in that text are replaced too. A given name that stands alone is not.
"""

import hashlib
import hmac
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.llm.common import keep

# Titles, by the gender that they tell.
_MALE = "Mr Mister Herr Sr Señor Monsieur Dn Don Sir Lord".split()
_FEMALE = "Mrs Ms Miss Frau Sra Señora Srta Mme Madame Mlle Doña Lady Dra Profesora".split()
_EITHER = "Dr Doctor Prof Professor Profesor Docteur Professeur Doktor".split()
_NAME = r"[^\W\d_]+(?:['’-](?!s\b)[^\W\d_]+)*"  # of "Byron's" it is Byron
_ND = [c for c in map(chr, range(0x20000)) if c.isdecimal()]


def _any(digits):
    """A pattern of these digits in every script."""
    return "[" + "".join(c for c in _ND if str(unicodedata.decimal(c)) in digits) + "]"


_OCTET = rf"(?:{_any('2')}{_any('5')}{_any('012345')}|{_any('2')}{_any('01234')}\d|{_any('1')}?\d?\d)"
PATTERNS = {  # in order of precedence where matches overlap
    "email": r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)+",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9]|[a-fA-F]+[0-9])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d)",
    "card": r"(?<![\d+-])\d(?:[ -]?\d){12,18}(?!\d|-\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"
             # national numbers: a trunk zero and nine digits at least in groups with one separator
             rf"|(?<![\w+.]){_any('0')}(?=(?:[ .]?\d){{8,10}}(?![ .]?\d))(?:\d{{1,4}}(?: \d{{2,4}}){{2,4}}|\d{{1,4}}(?:\.\d{{2,4}}){{2,4}})(?![ .]?\d)",
    "name": rf"(?<!\w)(?:{'|'.join(_MALE + _FEMALE + _EITHER)})\.? (?=[^\W\d_a-z])({_NAME}(?: (?=[^\W\d_a-z]){_NAME}){{0,2}})",
}
_FINDERS = {k: re.compile(p) for k, p in PATTERNS.items()}
_DIGIT = re.compile(r"\d")
WIDER = 16  # a surrogate grows with every so many attempts, so that room is found in the end
_TITLES = [t + end for t in _MALE + _FEMALE + _EITHER for end in (" ", ". ")]


def _kinds(text):
    """The kinds that a cheap look does not rule out; all but names and e-mails hold a digit."""
    kinds = list(PATTERNS)[1:-1] if _DIGIT.search(text) else []
    return ["email"] * ("@" in text) + kinds + ["name"] * any(t in text for t in _TITLES)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(d) for d in digits])):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def find(text):
    """(start, end, kind, entity) of every entity, disjoint and in order; entity is its normal form."""
    taken, out = [], []  # taken stays sorted, and matches of a kind come in order: both are walked once
    for kind in _kinds(text):
        fresh, at = [], 0
        for m in _FINDERS[kind].finditer(text):
            a, b = m.span(m.lastindex or 0)
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if at < len(taken) and taken[at][0] < b:
                continue
            value = m.group(m.lastindex or 0)
            if kind == "name":
                title = m.group(0).split(" ")[0].rstrip(".")
                gender = "name_f" if title in _FEMALE else "name_m" if title in _MALE else "name_u"
                parts = [(a + w.start(), a + w.end(), gender, w.group(0)) for w in re.finditer(_NAME, value)]
                parts[-1] = (*parts[-1][:2], "family", parts[-1][3])
                out += parts
            else:
                out.append((a, b, kind, normal(kind, value)))
            fresh.append((a, b))
        taken = sorted(taken + fresh)
    return sorted(out + _mentions(text, out, taken))


def _mentions(text, found, taken):
    """Further whole-word mentions of the full and family names among ``found``, without a title."""
    names, given = {}, ()
    for _, _, kind, word in sorted(x for x in found if x[2] in (*_GIVEN, "family")):
        given += ((kind, word),)
        if kind == "family":
            names.setdefault(tuple(w for _, w in given), given)
            names.setdefault((word,), given[-1:])
            given = ()
    if not names:
        return []
    words, out = list(re.finditer(_NAME, text)), []
    starts, at, i = sorted(taken), 0, 0
    while i < len(words):
        while at < len(starts) and starts[at][1] <= words[i].start():
            at += 1
        for n in (3, 2, 1):
            run = words[i:i + n]
            if len(run) < n or (parts := names.get(tuple(w.group(0) for w in run))) is None:
                continue
            a, b = run[0].start(), run[-1].end()
            whole = not re.match(r"\w", text[a - 1:a]) and not re.match(r"\w", text[b:b + 1])
            apart = all(text[x.end():y.start()].isspace() for x, y in zip(run, run[1:]))
            if whole and apart and not (at < len(starts) and starts[at][0] < b):
                out += [(w.start(), w.end(), *part) for w, part in zip(run, parts)]
                i += n - 1
                break
        i += 1
    return out


def normal(kind, value):
    if kind == "email":
        return value.lower()
    if kind in ("card", "ssn", "phone"):
        return ("+" if value[0] == "+" else "") + _plain(re.sub(r"\D", "", value))
    return _plain(value.replace(" ", "")) if kind in ("iban", "ip") else value


def _plain(value):
    return "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in value)


def _digit(like, n):
    """The digit ``n`` in the script of the digit ``like``."""
    return chr(ord(like) - unicodedata.decimal(like) + int(n))


class _Stream:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key, *what):
        self.key, self.what, self.pool, self.block = key, "\x00".join(map(str, what)).encode(), 0, 0
        self.left = 0

    def below(self, n):
        if self.left < n * 2 ** 20:
            digest = hmac.new(self.key, b"%d|" % self.block + self.what, hashlib.sha256).digest()
            self.pool, self.left, self.block = int.from_bytes(digest, "big"), 2 ** 256, self.block + 1
        self.pool, value = divmod(self.pool, n)
        self.left //= n
        return value


_VOWELS, _CONSONANTS = "aeiou", "bcdfglmnprstv"
_GIVEN = ("name_f", "name_m", "name_u")
# Letters of invented names by script, and how a woman's, a man's, anyone's and a family name ends.
_SCRIPTS = {
    "LATIN": (_CONSONANTS, _VOWELS, {"name_f": "a", "name_m": "on", "name_u": "e", "family": "or"}),
    "CYRILLIC": ("бвгдзклмнпрст", "аеиоу", {"name_f": "а", "name_m": "ан", "name_u": "и", "family": "ов"}),
    "GREEK": ("βγδκλμνπρστ", "αειου", {"name_f": "α", "name_m": "ος", "name_u": "ι", "family": "ης"}),
}


def _script(word):
    """The script of a word's letters; None if they are of several."""
    found = {unicodedata.name(c, "?").split(" ")[0] for c in word if c.isalpha()}
    return found.pop() if len(found) == 1 else None


def _letter(ch, draw):
    """A letter of the same case and, outside Latin, from the letters around it of the same script."""
    if ch.isascii():
        same = _VOWELS if ch.lower() in _VOWELS else "bcdfghjklmnpqrstvwxyz"
        new = same[draw.below(len(same))]
        return new.upper() if ch.isupper() else new
    script = unicodedata.name(ch, "?").split(" ")[0]
    base = ord(ch) & ~31
    near = [c for c in map(chr, range(base, base + 32))
            if c.isalpha() and unicodedata.category(c) == unicodedata.category(ch) and unicodedata.name(c, "").split(" ")[0] == script]
    return near[draw.below(len(near))] if near else ch


def _syllables(n, draw):
    return "".join(_CONSONANTS[draw.below(len(_CONSONANTS))] + _VOWELS[draw.below(5)] for _ in range(n))


def _alike(value, draw, keep_first=0):
    """The same layout with other digits and letters; the first ``keep_first`` characters stay."""
    return value[:keep_first] + "".join(
        _digit(c, draw.below(10)) if c.isdecimal() else _letter(c, draw) if c.isalpha() else c for c in value[keep_first:])


def surrogate(key, kind, entity, attempt=0):
    """The replacement of an entity, in its normal form. From attempt WIDER on it is longer than the form."""
    more = attempt // WIDER
    draw = _Stream(key, kind if kind not in _GIVEN else "name", entity, attempt)
    if kind == "email":
        local, _, domain = entity.partition("@")
        labels = domain.split(".")
        other = _Stream(key, "domain", domain, attempt)
        return _alike(local, draw) + _syllables(more, draw) + "@" + ".".join([*(_alike(x, other) for x in labels[:-1]), labels[-1]])
    if kind == "secret":
        letters = "0123456789ABCDEF" if entity.upper() == entity else "0123456789abcdef"
        return "".join(letters[draw.below(16)] for _ in entity + "0" * more)
    if kind == "ip":
        if attempt > 3:  # any address; short octets alone are few
            return ".".join(str(draw.below(256)) for _ in range(4 + more))
        low = {1: 1, 2: 10, 3: 100}
        high = {1: 9, 2: 99, 3: 254}
        return ".".join(str(low[n] + draw.below(high[n] - low[n] + 1)) for n in map(len, entity.split(".")))
    if kind == "card":
        digits = _alike(entity[:-1] + "0" * more, draw)
        last = next(d for d in "0123456789" if luhn(digits + d))
        return digits + (last if luhn(entity) else str((int(last) + 1 + draw.below(9)) % 10))
    if kind == "phone":
        return _alike(entity + "0" * more, draw, 2 if entity[0] == "+" else 0)
    if kind == "iban":
        return _alike(entity + "0" * more, draw, 2)
    if kind in (*_GIVEN, "family") and (script := _script(entity)) in _SCRIPTS:
        consonants, vowels, ends = _SCRIPTS[script]
        parts = [consonants[draw.below(len(consonants))] + vowels[draw.below(len(vowels))] for _ in range(max(2, len(entity) // 2) + attempt // 8)]
        name = "".join(parts)[:-1] + ends[kind]
        return name.upper() if entity.isupper() and len(entity) > 1 else name.capitalize()
    return _alike(entity + "0" * more, draw) if kind == "ssn" else _alike(entity, draw) + _syllables(more, draw)


def write(value, kind, new):
    """``new`` in the layout of the place: its separators and script, for numbers that have them, and its case."""
    if kind in ("card", "ssn", "phone", "iban"):
        fresh = iter(new.lstrip("+"))
        out = "".join(_like(c, next(fresh, "")) if c.isalnum() else c for c in value)
        return out + "".join(_like(value[-1], c) for c in fresh)
    if kind == "ip" and not value.isascii():
        like = next(c for c in value if c.isdecimal() and not c.isascii())
        return "".join(_like(like, c) for c in new)
    if kind == "email" and value != value.lower() and len(value) == len(new):
        return "".join(n.upper() if v.isupper() else n for v, n in zip(value, new))
    return new


def _like(c, new):
    return _digit(c, new) if c.isdecimal() and new.isdecimal() else new


def replace(text, key, exceptions=None):
    """(text with surrogates, entities replaced); ``exceptions`` maps kind and entity to attempts."""
    out, at, n = [], 0, 0
    for a, b, kind, entity in find(text):
        new = surrogate(key, kind, entity, (exceptions or {}).get((kind, entity), 0))
        out += [text[at:a], write(text[a:b], kind, new)]
        at, n = b, n + 1
    return "".join([*out, text[at:]]), n


def entities(docs, text="text"):
    """(text_hash, kind, entity): the distinct entities of every text."""
    def run(batches):
        for batch in batches:
            rows = [(h, k, e) for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t for k, e in {x[2:] for x in find(t)}]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))],
                                             ["text_hash", "kind", "entity"])

    value = F.col(text).cast("string")
    return docs.select(F.xxhash64(value), value).mapInArrow(run, "text_hash long, kind string, entity string")


def collisions(found, key):
    """(kind, entity, attempt) of the entities whose first surrogate collides, with the attempt that does not."""
    def named(batches):
        for batch in batches:
            new = [surrogate(key, k, e, a) for k, e, a in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], ["kind", "entity", "attempt", "new"])

    real = keep(found.select("kind", "entity").distinct())
    now = keep(real.withColumn("attempt", F.lit(0)).mapInArrow(named, "kind string, entity string, attempt int, new string"))
    while True:
        first = now.groupBy("new").agg(F.min(F.struct("kind", "entity")).alias("first"), F.count("*").alias("n")).where("n > 1")
        again = now.join(first, "new").where(F.struct("kind", "entity") != F.col("first")).select("kind", "entity")
        taken = now.join(real.select(F.col("entity").alias("new")).distinct(), "new", "left_semi").select("kind", "entity")
        moved = keep(again.unionAll(taken).distinct())
        if moved.isEmpty():
            return now.where("attempt > 0").select("kind", "entity", "attempt")
        bad = moved.withColumn("bad", F.lit(True))
        step = now.join(bad, ["kind", "entity"], "left").select("kind", "entity", (F.col("attempt") + F.coalesce(F.col("bad").cast("int"), F.lit(0))).alias("attempt"))
        now = keep(step.mapInArrow(named, "kind string, entity string, attempt int, new string"))


def pseudonymised(docs, key, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc_id, n_entities, text with every detected entity replaced.

    ``key`` is the secret (bytes). Null texts stay null; texts without entities stay as they are. A one-word
    name after a title counts as a family name.
    """
    found = keep(entities(docs, text))
    odd = keep(collisions(found, key))
    value = F.col(text).cast("string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), value.alias("text"), F.xxhash64(value).alias("text_hash"))
    if odd.isEmpty():
        rows = rows.select("doc_id", "text", F.expr("cast(null as array<struct<kind:string,entity:string,attempt:int>>)").alias("odd"))
    else:
        own = keep(found.join(odd, ["kind", "entity"]).groupBy("text_hash").agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("odd")))
        rows = rows.join(own, "text_hash", "left").select("doc_id", "text", "odd")

    def run(batches):
        for batch in batches:
            out = []
            for t, odd in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out.append((None, 0) if t is None else replace(t, key, {(x["kind"], x["entity"]): x["attempt"] for x in odd or []}))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n in out], pa.int64()), pa.array([t for t, _ in out], pa.string())],
                                             ["doc_id", "n_entities", "text"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_entities long, text string")
