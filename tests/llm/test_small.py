"""Operators against brute force on small tables: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pressmill.llm import decontaminate, linededup, mixing, pii, quality, simhash, suffixdedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, text_hash int, g string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    draw = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(draw.integers(40)) for i in draw.integers(len(WORDS), size=n))


def lines(seed, n):
    return "\n".join(prose(seed * 1000 + i, 14) for i in range(n))


PASSAGE = lines(77, 4)
TEXTS = [
    None, "", "  \n\t ", "word", "two words", prose(1, 60), prose(1, 60), prose(1, 59) + " changed", prose(2, 5000),
    PASSAGE, lines(3, 3) + "\n" + PASSAGE, PASSAGE + "\n" + lines(4, 3), "\n".join(["same line again, long enough to matter, twice as long as that"] * 6),
    "ÄÖ ñ 漢字 🙂 " * 30, "a" * 900, "a" * 900 + "b", prose(5, 300) + " " + prose(6, 120), prose(7, 100) + " " + prose(6, 120), "x\n\n\n\ny", "# $ % & * " * 20,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "abc"[i % 3] if i % 7 else None, len(t or ""), 1, "r", 2, "g") for i, t in enumerate(TEXTS)]
    rows.append(rows[5])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(prints):
    """{id: smallest id within reach} for [(id, fingerprint)]."""
    root = {i: i for i, _ in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(prints):
        for j, b in prints[:k]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i in root}


def test_simhash(docs, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    prints = [(i, plain_fingerprint(t)) for i, t in enumerate(TEXTS)]
    want = components_of(prints)
    for r in got:
        assert (r["fingerprint"], r["component_id"]) == (f"{dict(prints)[r['doc_id']]:016x}", want[r["doc_id"]])
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in want if want[i] == i}


@pytest.mark.parametrize("group", [1, simhash.GROUP])
def test_links_of_near_fingerprints(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)  # 1: every group goes through hubs
    draw = np.random.default_rng(1)
    base = [int(x) for x in draw.integers(1 << 63, size=6)]
    values = [0, (1 << 64) - 1, *base]
    for b in base:
        for n in (1, 2, 3, 3, 4, 5):
            x = b
            for bit in draw.choice(64, n, replace=False):
                x ^= 1 << int(bit)
            values.append(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in dict.fromkeys(values)]
    prints = spark.createDataFrame([(s,) for s in signed], "fp long")
    from pressmill.llm.components import components

    root = {r["node"]: r["root"] for r in components(simhash.links(prints)).collect()}
    want = components_of([(s, s & ((1 << 64) - 1)) for s in signed])
    groups = lambda m: sorted(sorted(k for k in signed if m.get(k, k) == r) for r in {m.get(k, k) for k in signed})
    assert groups(root) == groups(want)


def test_pigeonring_misses_nothing():
    draw = np.random.default_rng(2)
    a = draw.integers(1 << 63, size=3000).astype(np.uint64)
    flips = np.zeros(3000, np.uint64)
    for _ in range(3):
        flips |= np.uint64(1) << draw.integers(64, size=3000).astype(np.uint64)
    passes = np.any([simhash._close(flips, np.full(3000, s)) for s in range(4)], axis=0)
    assert passes.all() and len(a) == 3000


def plain_mix(rows):
    """{source: target} by resharing until no target is above its limit."""
    size = Counter()
    for s, n in rows:
        size[s] += n
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(size.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * size[s]]
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
            open_.remove(s)
    return target


def test_mixing(spark, docs, none):
    got = mixing.mixture(docs).collect()
    sizes = {i: len((t or "").encode().split()) for i, t in enumerate(TEXTS)}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    target = plain_mix([(source[r["doc_id"]], sizes[r["doc_id"]]) for r in got])
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] <= 3 * r["size"]
        assert math.isclose(r["target"], target[source[r["doc_id"]]], rel_tol=1e-9, abs_tol=1e-9)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixture(docs.repartition(5)).collect()))
    assert mixing.mixture(none).count() == 0
    clash = docs.withColumnRenamed("g", "Copies")
    assert mixing.mix(clash).columns == [*clash.columns, "copies_"]
    many = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 50 as int)) as text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source")
    name = F.expr("if(doc_id % 3 = 0, 'hot', concat('s', doc_id % 7))")
    sums = mixing.mixture(many).groupBy(name.alias("name"), "target").agg(F.sum("taken").alias("t")).collect()
    assert len(sums) == 8 and all(abs(r["t"] - r["target"]) <= 50 for r in sums)


def test_mixing_comes_nearest(spark):
    """The document in which a budget ends is taken where that is nearer than what can be filled in behind it."""
    def taken(sizes, weights, cap=3):
        rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        out = {}
        for r in mixing.mixture(docs, weights, cap).collect():
            s = sizes[r["doc_id"]][0]
            out[s] = (r["target"], out.get(s, (0, 0))[1] + r["taken"])
        return out

    whole = taken([("a", 1000), ("b", 500), ("b", 500)], (15, 1))  # a: 1,875 of 1,000 in one document
    assert whole["a"] == (1875.0, 2000) and abs(whole["b"][1] - 125) <= 125
    draw = np.random.default_rng(4)
    for seed in range(6):
        sizes = [("ab"[i % 2], int(n)) for i, n in enumerate(draw.choice([1, 2, 30, 400, 3000], size=30, p=[.1, .2, .3, .3, .1]))]
        for target, t in taken(sizes, (3, 2)).values():
            assert abs(t - target) <= max(n for _, n in sizes) / 2  # the boundary document or nothing is that near


ITEM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("room", [0, decontaminate.BROADCAST_BYTES])
def test_decontamination(spark, docs, none, monkeypatch, room):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", room)  # 0: nothing is broadcast by hint
    head = lambda seed, n, k: " ".join(prose(seed, n).split()[:k])
    items = [(1, head(6, 120, 40)), (2, "Two, WORDS!"), (3, None), (4, "!!"), (5, head(1, 60, 20)), (6, head(6, 120, 40)), (7, "漢字")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = ITEM.findall((t or "").encode().lower())
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    got = decontaminate.contamination(docs, bench).collect()
    assert len(got) == docs.count()
    for r in got:
        w, hit, found = ITEM.findall((TEXTS[r["doc_id"]] or "").encode().lower()), set(), set()
        for g, ids in windows.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found |= ids
        assert (r["n_words"], r["n_hit"], r["items"], r["hit_words"]) == (len(w), len(hit), sorted(found), sorted(hit))
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in got if not r["contaminated"]}
    cut = by_id(decontaminate.remove_spans(docs, bench))
    assert cut[0]["text"] is None and cut[4]["text"] == "" and cut[8]["text"] == TEXTS[8]
    assert cut[16]["text"].startswith(prose(5, 300)) and len(cut[16]["text"]) < len(TEXTS[16])
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_large_benchmarks_shuffle_no_texts(spark, monkeypatch):
    """Without a broadcast the probes that meet the grams are four numbers a row, whatever the length of the text."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    docs = spark.createDataFrame([(i, prose(i, 2000)) for i in range(20)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, prose(i, 40)) for i in range(100, 140)], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = decontaminate.contamination(docs, bench)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = plan.index("Join LeftSemi")
    probes = plan[at:].splitlines()[1]
    assert "row#" in probes and " t#" not in probes and "doc_id#" not in probes


def test_big_benchmarks_join_without_broadcast(docs, spark, monkeypatch):
    bench = spark.createDataFrame([(1, prose(6, 120))], "item_id long, text string")
    want = sorted(map(str, decontaminate.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert sorted(map(str, decontaminate.contamination(docs, bench).collect())) == want


def plain_lines(texts, weight=linededup.WEIGHT, least=linededup.LEAST):
    seen, out = set(), {}
    for i, t in texts:
        if t is None:
            continue
        parts, windows, gone = t.split("\n"), set(), set()
        for k in range(len(parts)):
            for step in (1, -1):
                total, j = 0, k
                while 0 <= j < len(parts):
                    total += max(len(parts[j]), least)
                    if total >= weight:
                        windows.add((min(j, k), max(j, k)))
                        break
                    j += step
        for a, b in sorted(windows):
            key = tuple(parts[a:b + 1])
            if key in seen:
                gone.update(range(a, b + 1))
            seen.add(key)
        out[i] = "\n".join(x for k, x in enumerate(parts) if k not in gone)
    return out


def test_lines(docs, none):
    want = plain_lines(enumerate(TEXTS))
    kept = linededup.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    got = by_id(kept)
    assert {i: r["text"] for i, r in got.items() if r["text"] is not None} == want
    assert all(r["n_chars"] == len(r["text"] or "") for r in got.values())
    report = by_id(linededup.line_report(docs))
    assert all(report[i]["kept_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in want.items())
    assert PASSAGE not in got[10]["text"] and want[9] == PASSAGE
    assert linededup.line_report(none).count() == 0


def plain_repeats(texts, length):
    """{place: (kept, spans)}; texts are UTF-8 bytes."""
    count = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        spans = []
        for p in range(len(t) - length + 1):
            if count[t[p:p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + t[at:a], b
        out.append((kept + t[at:], spans))
    return out


@pytest.mark.parametrize("group", [1, suffixdedup.GROUP])
def test_suffixes(spark, docs, none, monkeypatch, group):
    monkeypatch.setattr(suffixdedup, "GROUP", group)
    rows = docs.select("doc_id", "text").collect()
    want = plain_repeats([(r["text"] or "").encode() for r in rows], 200)
    got = suffixdedup.without_repeats(docs).collect()
    assert len(got) == len(rows)
    want = {r["doc_id"]: w for r, w in zip(rows, want)}
    for r in got:
        kept, spans = want[r["doc_id"]]
        assert (bytes(r["kept"]), [list(x) for x in zip(r["starts"], r["ends"])]) == (kept, spans)
    assert suffixdedup.without_repeats(none).count() == 0


def test_reaches_against_all_pairs():
    draw = np.random.default_rng(3)
    for _ in range(60):
        whole = [bytes(draw.integers(97, 99, size=90).astype(np.uint8)) for _ in range(4)]
        cases = []
        for _ in range(12):
            t = bytearray(whole[draw.integers(4)])
            for k in draw.integers(90, size=draw.integers(3)):
                t[k] = 120
            cases.append((bytes(t[: 40]), bytes(t[40:])))
        cases = list(dict.fromkeys(cases))
        agree = lambda x, y: next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        for (left, right), (x, y) in zip(suffixdedup.reaches(cases, 50 + 0), cases):
            pairs = [(agree(x[::-1], a[::-1]), agree(y, b)) for a, b in cases if (a, b) != (x, y)]
            pairs = [(a, b) for a, b in pairs if a + b >= 50 and 50 - b <= 50 - suffixdedup.GRAM]
            assert (left, right) == ((max(a for a, _ in pairs), max(b for _, b in pairs)) if pairs else (0, 0))


def test_quality(docs, none, spark):
    rows = quality.verdict(quality.ledger(docs))
    got = by_id(rows)
    assert len(rows.collect()) == docs.count()
    assert got[0]["n_words"] == 0 and got[0]["base_failed"] and not got[0]["kept"]
    assert got[13]["word_chars"] == 30 * 6 and got[19]["n_symbols"] == 100 and got[12]["n_dup_lines"] == 5
    for i, t in enumerate(TEXTS):
        w = (t or "").encode().split()
        grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {k + d for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for d in range(3)}
        assert (got[i]["n_words"], got[i]["n_repeat_words"]) == (len(w), len(hit))
    cases = {(r["policy"], r["rule"]): r for r in quality.ablations(rows).collect()}
    for (policy, rule), r in cases.items():
        m, bit = quality.mask(quality.POLICIES[policy]), quality.mask([rule])
        bits = [x["failed"] for x in rows.collect()]
        assert (r["failed"], r["rejected"], r["alone"]) == (sum(b & bit > 0 for b in bits), sum(b & m > 0 for b in bits), sum(b & m == bit for b in bits))
    assert quality.ablations(quality.ledger(none)).count() == 0


def test_surrogates(spark, none):
    key = b"key"
    text = "Mrs Ada Byron, ada@example.com, +1 (017) 555-7713, 97.51.17.173, 4111 1111 1111 1111; Mrs Byron, ADA@example.com, 4111-1111-1111-1111"
    rows = [(1, text), (2, None), (3, ""), (4, "nothing here"), (5, text)]
    got = by_id(pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), key))
    new = got[1]["text"]
    assert got[1]["n_entities"] == 9 and got[5]["text"] == new
    assert (got[2]["text"], got[3]["text"], got[4]["text"]) == (None, "", "nothing here")
    old, fresh = pii.find(text), pii.find(new)
    assert [x[2] for x in old] == [x[2] for x in fresh]
    assert not {x[3] for x in old} & {x[3] for x in fresh}
    same = {}
    assert all(same.setdefault(a[2:], b[2:]) == b[2:] for a, b in zip(old, fresh))  # coreference
    assert len(set(same.values())) == len(same)  # distinctness
    assert pii.luhn(next(x[3] for x in fresh if x[2] == "card")) and fresh[0][3].endswith("a")
    assert pii.pseudonymised(none, key).count() == 0


def test_colliding_surrogates_move_on(spark, monkeypatch):
    monkeypatch.setattr(pii, "surrogate", lambda key, kind, e, attempt=0: f"{(len(e) + attempt) % 7}")
    found = spark.createDataFrame([(1, "card", x) for x in ("a", "b", "cc", "dd", "4")], "text_hash long, kind string, entity string")
    odd = {r["entity"]: r["attempt"] for r in pii.collisions(found, b"").collect()}
    final = [f"{(len(e) + odd.get(e, 0)) % 7}" for e in ("a", "b", "cc", "dd", "4")]
    assert len(set(final)) == 5 and "4" not in final


def test_crc_matches_python(spark):
    from pressmill.llm.common import crc_mod

    got = spark.range(50).select("id", crc_mod(F.col("id"), 10).alias("m")).collect()
    assert all(r["m"] == zlib.crc32(str(r["id"]).encode()) % 10 for r in got)
