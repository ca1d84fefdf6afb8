"""Exact substring dedup over sparse enhanced suffix arrays.

Removed is every byte covered by a LENGTH-byte string that also starts elsewhere. Suffixes are indexed at
anchors only: of the GRAM-byte grams in every LENGTH-byte window, the one with the smallest hash
(the last of equals). Equal strings choose the same anchor, so whatever repeats meets at an anchor with
equal grams, and grams that occur once end there.

An occurrence is an anchor with its context: the bytes before it and from it on that a LENGTH-byte
string around it can reach. Equal contexts are one row with a count. Where a gram has several
contexts, they are sorted by what follows (an enhanced suffix array: order and common prefix
lengths), and a stack scan yields the interval tree of common prefixes: each interval is a group of
contexts that agree on so many bytes to the right, all of them, not only neighbours. Within an interval
the same is asked of the left: contexts that agree on enough bytes before the anchor form a repeat;
groups whose left extensions all agree are left to the interval that is longer. For each context
this gives how far repeats reach to either side.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from pressmill.llm.common import keep, text_bytes

LENGTH, GRAM = 200, 32
BEFORE = LENGTH - GRAM  # bytes before an anchor that a string around it can reach
GROUP = 4096  # contexts of one gram that a task compares; larger groups are split by longer keys
STEP = 1 << 22  # bytes hashed at a time
_M = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _grams(raw):
    """Hash of the GRAM bytes from each position, by doubling; GRAM is a power of two."""
    h, width, k = raw.astype(np.uint64) + np.uint64(1), 1, 0
    while width < GRAM:
        h = h[:-width] * _M[k] + h[width:]
        width, k = 2 * width, k + 1
    h ^= h >> np.uint64(32)
    h *= _M[0]
    return h ^ (h >> np.uint64(29))


def anchors(raw, length=LENGTH):
    """Positions of the anchors of a byte array, and the hashes of their grams."""
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, hashes, reach = [], [], length - GRAM + 1
    for at in range(0, len(raw) - length + 1, STEP):
        h = _grams(raw[at:at + STEP + length - 1])
        # Hash above, position below and reversed, so that the smallest value is the last smallest hash.
        bits = np.uint64(int(len(h)).bit_length())
        low = (h >> bits << bits) | np.arange(len(h) - 1, -1, -1, dtype=np.uint64)
        done, width = low, 1
        while 2 * width <= reach:
            done = np.minimum(done[:-width], done[width:])
            width *= 2
        least = np.minimum(done[: len(low) - reach + 1], done[reach - width:]) if reach > width else done
        where = len(h) - 1 - (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        where = where[np.r_[True, where[1:] != where[:-1]]]
        places.append(where + at)
        hashes.append(h[where])
    places, hashes = np.concatenate(places), np.concatenate(hashes)
    first = np.r_[True, places[1:] != places[:-1]]
    return places[first], hashes[first]


def context(text, at, length=LENGTH):
    return text[max(0, at - (length - GRAM)):at], text[at:at + length]


def _anchor_rows(length):
    """(text_id, text) to (text_id, at, g, c): gram hash, context hash (with its length to the left)."""
    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, ats, gs, cs = [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                at, g = anchors(np.frombuffer(text, np.uint8), length)
                ids += [key] * len(at)
                ats.append(at)
                gs.append(g)
                cs += [digest(text[max(0, a - (length - GRAM)):a + length], min(a, length - GRAM)) for a in at.tolist()]
            at, g = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ats, gs))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(at.astype(np.int64)), pa.array(g.astype(np.uint64).view(np.int64)),
                                              pa.array(np.array(cs, np.uint64).view(np.int64))], ["text_id", "at", "g", "c"])

    return run


def _common(a, b):
    """Length of the common prefix of two byte strings."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def intervals(lcp):
    """The interval tree of common prefixes by a stack scan: (value, first, last) of every group of sorted
    suffixes that agree on ``value`` bytes and on no more, inner groups before outer ones."""
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        now, first = (lcp[i] if i < len(lcp) else -1), i - 1
        while stack and stack[-1][0] > now:
            value, first = stack.pop()
            if i - 1 > first:
                yield value, first, i - 1
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def reaches(contexts, length=LENGTH):
    """For each distinct (left, right) context, how far repeats reach to the left and the right of the anchor.

    Two contexts repeat if they agree on l bytes before and r bytes after with l + r >= ``length``. Inside an
    interval of value r, the members are ordered by their reversed left sides; neighbours that agree
    on length - r bytes or more belong to one repeat, and each takes its longest agreement. If all
    agree alike the interval is not left-diverse, and its members share one reach.
    """
    n = len(contexts)
    by_right = sorted(range(n), key=lambda i: contexts[i][1])
    lcp = [0] + [_common(contexts[a][1], contexts[b][1]) for a, b in zip(by_right, by_right[1:])]
    lefts = [c[0][::-1] for c in contexts]
    by_left = sorted(range(n), key=lefts.__getitem__)
    lcs = [0] + [_common(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:])]
    rank = [0] * n
    for k, i in enumerate(by_left):
        rank[i] = k
    left, right = [0] * n, [0] * n
    for value, first, last in intervals(lcp):
        need = length - value
        if need > length - GRAM:
            continue
        group = sorted(rank[i] for i in by_right[first:last + 1])
        agree = [min(lcs[a + 1:b + 1]) for a, b in zip(group, group[1:])]
        if min(agree) == max(agree):
            best = [agree[0]] * len(group)
        else:
            best = list(map(max, [-1, *agree], [*agree, -1]))
        for r, most in zip(group, best):
            if most >= need:  # with need 0 the right side alone repeats
                i = by_left[r]
                left[i], right[i] = max(left[i], most), max(right[i], value)
    return list(zip(left, right))


def _context_rows(length):
    """(text, places) to (g, c, before, after)."""
    def run(batches):
        for batch in batches:
            g, c, before, after = [], [], [], []
            for text, places in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                for p in places:
                    x, y = context(text, p["at"], length)
                    g.append(p["g"])
                    c.append(p["c"])
                    before.append(x)
                    after.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(c, pa.int64()), pa.array(before, pa.binary()),
                                              pa.array(after, pa.binary())], ["g", "c", "before", "after"])

    return run


def _reach_rows(length):
    """Streams contexts sorted by gram; each gram's contexts, at most GROUP, are compared together."""
    def solve(rows):
        found = [(g, c, x, y) for (g, c, *_), (x, y) in zip(rows, reaches([r[2:] for r in rows], length)) if x + y]
        names = (("g", pa.int64()), ("c", pa.int64()), ("left", pa.int32()), ("right", pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, (_, t) in enumerate(names)], [n for n, _ in names])

    def run(batches):
        rows = []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if rows and rows[0][0] != row[0]:
                    yield solve(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield solve(rows)

    return run


def _string_rows(length):
    """Every string of a context around its anchor, as (g, c, o, s): bytes before the anchor, hash."""
    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for g, c, before, after in zip(*(batch.column(k).to_pylist() for k in range(4))):
                whole, n = before + after, len(before)
                o = [k for k in range(n + 1) if k + len(after) >= length]
                s = np.array([digest(whole[n - k:n - k + length]) for k in o], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(o), pa.int64()), pa.array([c] * len(o), pa.int64()), pa.array(o, pa.int32()),
                                                  pa.array(s.view(np.int64))], ["g", "c", "o", "s"])

    return run


def _long_groups(contexts, length):
    """Reaches for grams with more contexts than a task takes: each string around the anchor is a row, and
    strings are counted, so rows grow with the contexts and no group meets."""
    rows = contexts.mapInArrow(_string_rows(length), "g long, c long, o int, s long")
    twice = keep(rows.groupBy("g", "o", "s").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a <> b").select("g", "o", "s"))
    return rows.join(twice, ["g", "o", "s"]).groupBy("g", "c").agg(F.max("o").alias("left"), (F.lit(length) - F.min("o")).alias("right"))


def repeats(docs, length=LENGTH, text="text"):
    """(text_id, places): for every distinct text with repeats, structs (at, left, right) whose ranges
    [at - left, at + right), cut to the text, are the bytes covered. text_id: 128 bits of SHA-256."""
    read = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).select(text_id("t").alias("text_id"), "t")
    found = keep(read.mapInArrow(_anchor_rows(length), "text_id binary, at long, g long, c long").withColumn("place", F.xxhash64("text_id", "at")))
    # Equal texts have equal places, so copies alone do not make a gram or a context repeated here.
    # What is counted is written before it is joined back: adaptive execution can then split hot keys.
    shared = keep(found.groupBy("g").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a <> b").select("g"))
    found = keep(found.join(shared, "g"))
    contexts = keep(found.groupBy("g", "c").agg(F.min("place").alias("place"), F.max("place").alias("b"), F.min(F.struct("text_id", "at")).alias("at")))
    grams = keep(contexts.groupBy("g").agg(F.count("*").alias("n")).where("n > 1"))
    wanted = keep(contexts.join(grams, "g").groupBy("at.text_id").agg(F.collect_list(F.struct("at.at", "g", "c")).alias("places")))
    # One row of each text is enough; copies are told apart by nothing but their place in the table.
    texts = read.join(wanted, "text_id")
    parts = keep(texts.select("t", "places").mapInArrow(_context_rows(length), "g long, c long, before binary, after binary").dropDuplicates(["g", "c"]))
    sized = parts.join(grams, "g")
    few = sized.where(F.col("n") <= GROUP).select("g", "c", "before", "after").repartition("g").sortWithinPartitions("g")
    reached = few.mapInArrow(_reach_rows(length), "g long, c long, left int, right int")
    many = sized.where(F.col("n") > GROUP).select("g", "c", "before", "after")
    if not grams.where(F.col("n") > GROUP).isEmpty():
        reached = reached.unionAll(_long_groups(many, length))
    same = contexts.where("place <> b").select("g", "c", F.lit(length - GRAM).alias("left"), F.lit(length).alias("right"))
    reached = keep(reached.unionAll(same).groupBy("g", "c").agg(F.max("left").alias("left"), F.max("right").alias("right")))
    covered = found.join(reached, ["g", "c"])
    return covered.groupBy("text_id").agg(F.collect_set(F.struct("at", "left", "right")).alias("places"))


def text_id(name):
    return F.unhex(F.substring(F.sha2(F.col(name), 256), 1, 32))


def spans(places, size):
    """Disjoint, sorted (start, end) of the covered bytes."""
    out = []
    for a, b in sorted((max(0, p["at"] - p["left"]), min(size, p["at"] + p["right"])) for p in places):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def cut(text, places, copies, length=LENGTH):
    """(kept bytes, spans) of one text; a text that another row repeats goes whole from ``length`` bytes on."""
    gone = [[0, len(text)]] if copies > 1 and len(text) >= length else spans(places or [], len(text))
    kept, at = [], 0
    for a, b in gone:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), gone


def _with_places(docs, length, doc_id, text):
    found = repeats(docs, length, text)
    read = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).withColumn("text_id", text_id("t"))
    copies = read.groupBy("text_id").agg(F.count("*").alias("copies"))
    extra = keep(copies.where("copies > 1").join(found, "text_id", "full").select("text_id", F.coalesce("copies", F.lit(1)).alias("copies"), "places"))
    return read.join(extra, "text_id", "left").select("doc_id", "t", F.coalesce("copies", F.lit(1)).cast("int").alias("copies"), "places")


def without_repeats(docs, length=LENGTH, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc_id, n_bytes, kept (bytes left), n_removed, n_spans, starts, ends.

    Every byte covered by a ``length``-byte string that also starts elsewhere goes, overlaps and the same
    document included. Null texts are empty. Repeated rows are copies of each other. Texts shorter than
    ``length`` stay whole.
    """
    def run(batches):
        for batch in batches:
            out = [(*cut(t, p, c, length), len(t)) for t, c, p in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for *_, n in out], pa.int64()), pa.array([k for k, *_ in out], pa.binary()),
                 pa.array([n - len(k) for k, _, n in out], pa.int64()), pa.array([len(s) for _, s, _ in out], pa.int64()),
                 pa.array([[a for a, _ in s] for _, s, _ in out], pa.list_(pa.int64())),
                 pa.array([[b for _, b in s] for _, s, _ in out], pa.list_(pa.int64()))],
                ["doc_id", "n_bytes", "kept", "n_removed", "n_spans", "starts", "ends"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return _with_places(docs, length, doc_id, text).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, kept binary, n_removed long, n_spans long, starts array<long>, ends array<long>")
