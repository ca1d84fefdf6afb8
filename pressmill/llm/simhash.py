"""SimHash near-duplicates with pigeonring filtering.

Sixty-four bits lie on a ring of four segments. If two fingerprints differ in at most three bits,
some segment starts a chain whose first l segments differ in at most floor(3 l / 4) bits for every
l: none in the first, one in the first two, two in the first three. A pair therefore shares
one of 64 keys (start, second segment with one bit masked); only pairs of a key meet, and the
chain's third step is tested before the full distance.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from pressmill.llm.common import free, keep, text_bytes
from pressmill.llm.components import components

SEGMENTS, WIDTH, DISTANCE = 4, 16, 3
GROUP = 32_768  # fingerprints of one key that a task compares; larger groups go through hubs
CHUNK = 1 << 16


def fingerprint(text, shingle=3):
    """The 64-bit fingerprint of UTF-8 bytes: bit set if set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[: len(words) - k + 1], end[k - 1:]
    total, ones, digest = len(first), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        spans = zip(first[at:at + CHUNK].tolist(), last[at:at + CHUNK].tolist())
        h = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, min(CHUNK, total - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs, shingle=3, doc_id="doc_id", text="text"):
    """(doc_id, fp) per row of ``docs``; fp is the fingerprint as a signed long, 0 without words."""
    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(run, f"doc_id {kind}, fp long")


def _keys(fp):
    """The 64 keys of a fingerprint: (start, masked bit) above the chain's first two segments."""
    out = []
    for i in range(SEGMENTS):
        turned = fp if i == 0 else F.shiftrightunsigned(fp, 16 * i).bitwiseOR(F.shiftleft(fp, 64 - 16 * i))
        for j in range(WIDTH):
            mask = 0xFFFFFFFF & ~(1 << (WIDTH + j))
            out.append(turned.bitwiseAND(F.lit(mask)) + F.lit((i * WIDTH + j) << 32))
    return F.explode(F.array(*out))


def _close(x, start):
    """Which differences x pass the chain from segment ``start`` and then the full distance."""
    turn = np.uint64(WIDTH) * start.astype(np.uint64)
    ring = (x >> turn) | (x << ((np.uint64(64) - turn) & np.uint64(63)))
    ok = np.ones(len(x), bool)
    for length in range(2, SEGMENTS + 1):
        part = ring & np.uint64((1 << (WIDTH * length)) - 1)
        ok &= np.bitwise_count(part) <= DISTANCE * length // SEGMENTS
    return ok


def _spread(fp, start):
    """Links that connect what is connected within one key's group: each fingerprint taken is
    compared with those not reached so far, so dense groups cost far less than all pairs."""
    left, links = fp, []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = _close(left ^ x, np.full(len(left), start))
            if near.any():
                found = left[near]
                links.append((np.full(len(found), x), found))
                todo.extend(found)
                left = left[~near]
    return links


def _groups(key, fp):
    """Links within complete groups of sorted keys."""
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[at, len(key)])
    start = (key >> 32) // WIDTH
    links = []
    for a, n in zip(at[size > 8].tolist(), size[size > 8].tolist()):
        links += _spread(fp[a:a + n], start[a])
    small = np.repeat(size, size) <= 8
    for d in range(1, 8):
        i = np.flatnonzero(small[:-d] & (key[d:] == key[:-d])) if len(key) > d else []
        if not len(i):
            break
        i = i[_close(fp[i] ^ fp[i + d], start[i])]
        links.append((fp[i], fp[i + d]))
    return links


def _linked(batches):
    """Streams sorted (key, fp) rows to links (u, v); of a group over GROUP to its members (u, null)."""
    key, fp, hot = np.array([], np.int64), np.array([], np.uint64), None

    def rows(links):
        u = np.concatenate([x for x, _ in links]) if links else fp[:0]
        v = np.concatenate([y for _, y in links]) if links else fp[:0]
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def members(x):
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.nulls(len(x), pa.int64())], ["u", "v"])

    for batch in batches:
        k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if hot is not None:
            n = int(np.searchsorted(k, hot, "right"))
            if n:
                yield members(f[:n])
            k, f, hot = k[n:], f[n:], hot if n == len(k) else None
            if not len(k):
                continue
        key, fp = np.r_[key, k], np.r_[fp, f]
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield rows(_groups(key[:cut], fp[:cut]))
        key, fp = key[cut:], fp[cut:]
        if len(key) > GROUP:
            hot = key[-1]
            yield members(fp)
            key, fp = key[:0], fp[:0]
    if len(key):
        yield rows(_groups(key, fp))


def _hubs(members):
    """Links among the members of oversized groups, in rows proportional to their number. A hub is
    any word within one bit of a member; whoever lies within two bits of it is within three of
    that member. Each hub links its visitors to the smallest such member."""
    one = [0] + [1 << i for i in range(64)]
    two = [a | b for i, a in enumerate(one[1:], 1) for b in one[1:i]]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    near, far = ([signed(m) for m in x] for x in (one, two))
    visits = members.select("u", F.explode(F.array(*map(F.lit, near))).alias("m")).select(
        F.col("u").bitwiseXOR(F.col("m")).alias("hub"), "u", F.lit(True).alias("close"))
    visits = visits.unionAll(members.select("u", F.explode(F.expr(f"array({','.join(f'{m}L' for m in far if m != -1 << 63)})")).alias("m")).select(
        F.col("u").bitwiseXOR(F.col("m")).alias("hub"), "u", F.lit(False)))
    heads = visits.where("close").groupBy("hub").agg(F.min("u").alias("v"))
    return visits.join(heads, "hub").where("u <> v").select("u", "v").distinct()


def links(prints):
    """Links (u, v) that connect every two distinct fingerprints of ``prints.fp`` at three or fewer bits."""
    pairs = prints.select("fp").distinct().select(_keys(F.col("fp")).alias("key"), "fp")
    rows = keep(pairs.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_linked, "u long, v long").distinct())
    found, hot = rows.where("v is not null"), rows.where("v is null").select("u")
    return found if hot.isEmpty() else found.unionAll(_hubs(hot))


def near_duplicates(docs, shingle=3, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at three or fewer differing bits; component_id is the smallest doc_id that can
    be reached. Null, empty and blank texts have fingerprint zero and link like any other. Exact
    copies are one fingerprint throughout, so only distinct fingerprints are compared. Repeated
    rows come out as often as they went in; a null doc_id never names a group unless all are null.
    """
    prints = keep(fingerprints(docs, shingle, doc_id, text))
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(prints)).select(F.col("node").alias("fp"), "root")
    named = keep(firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    lows = keep(named.groupBy("root").agg(F.min("first").alias("component_id")))
    classes = named.join(lows, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs, shingle=3, doc_id="doc_id", text="text"):
    """``docs`` without the documents that are not the first (smallest doc_id) of their group.
    Rows without a doc_id stay; of repeated rows with one doc_id all stay or all go."""
    mark, = free(docs, "_later")
    later = near_duplicates(docs, shingle, doc_id, text).where("doc_id > component_id")
    later = later.select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(later, docs[doc_id] == later[mark], "left_anti")
