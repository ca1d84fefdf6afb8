"""Alignment of two tokenizers against tokens of whole texts and all pairs of overlapping tokens."""

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import pytest

from pressmill.llm import alignment

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, chunk int, place int, pair string, planes string, docs int, links int"
TEXTS = [None, "", " ", "word", "two  words", "a\n\nb\tc \n d", "▁ mark", "x ▁", "<s> hi </s>", "<|endoftext|> and <|endoftext|>", "<0x41> <unk>",
         "ﬁ ½ Ａ 漢字 🙂 e\u0301", "\x00 \x1c x \x85 y\u00a0z \u3000 q", " leading and trailing ", "don't we'll   spaces", "one two one two one two " * 40,
         "the same words again", "the same words again", "x" * 3000, "漢字" * 500, "0123456789 " * 30, "a b c d e f g"]


@pytest.fixture(scope="module")
def aligner():
    with open(alignment._default("byte_bpe_50k.json"), encoding="utf-8") as f, open(alignment._default("piece_bpe_32k.model"), "rb") as g:
        return alignment.Aligner(f.read(), g.read())


def plain(aligner, texts):
    """Contract rows, from the tokens of whole texts."""
    alphabet = {c: b for c, b in alignment._byte_alphabet().items()}
    held, made = defaultdict(set), []
    for n, text in enumerate(texts):
        row = None
        if text:
            a = aligner.a.encode(" " + text, add_special_tokens=False).ids
            b = aligner.b.encode(text)
            x = [bytes(alphabet[c] for c in aligner.a.id_to_token(i)) for i in a]
            y = [bytes([int(aligner.b.id_to_piece(i)[3:5], 16)]) if aligner.b.is_byte(i) else aligner.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(x) == b"".join(y) == (" " + text).encode():
                ends = lambda z: np.cumsum([len(t) for t in z]).tolist()
                ex, ey = ends(x), ends(y)
                links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if max(ex[i] - len(x[i]), ey[j] - len(y[j])) < min(ex[i], ey[j])]
                common, groups, p, q = sorted(set(ex) & set(ey)), [], 0, 0
                for e in common:
                    i, j = ex.index(e) + 1, ey.index(e) + 1
                    groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
                    p, q = i, j
                row = len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()
                for pair in links:
                    held[pair].add(n)
        made.append(row)
    best = Counter()
    for (a, _), docs in held.items():
        best[a] = max(best[a], len(docs))
    out = []
    for row in made:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, digest = row
            counts = [len(held[p]) for p in links]
            out.append((n_a, n_b, n_groups, len(links), sum(c == best[p[0]] for c, p in zip(counts, links)), sum(counts), digest))
    return out, held


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("chunk", [3, 4096])
def test_alignment(spark, aligner, monkeypatch, chunk):
    if chunk == 3:
        monkeypatch.setattr(alignment, "POSTINGS", 20)  # chunks end early
    texts = TEXTS + [TEXTS[4]]
    rows = [(i, t, 1, 2, "p", "q", 3, 4) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], 1, 2, "p", "q", 3, 4)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want, held = plain(aligner, texts)
    got = sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in alignment.aligned(docs).collect())
    assert got == sorted((i, *w) for i, w in zip([*range(len(TEXTS)), 4], want))
    counts = {(r["a"], r["b"]): r for r in alignment.pair_counts(alignment.encoded(docs).where("pair is not null")).collect()}
    assert {p: r["docs"] for p, r in counts.items()} == {p: len(d) for p, d in held.items()}
    assert sum(r["links"] for r in counts.values()) == sum(w[3] for w in want)


def test_empty_table(spark):
    assert alignment.aligned(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
def test_real_texts(spark, aligner):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 6000 or text is null")
    rows = docs.select("doc_id", "text").collect()
    want, _ = plain(aligner, [r["text"] for r in rows])
    got = sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in alignment.aligned(docs).collect())
    assert got == sorted((r["doc_id"], *w) for r, w in zip(rows, want))


def test_bitmaps():
    draw = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, alignment.CHUNK):
        a, b = (np.sort(draw.choice(alignment.CHUNK, n, replace=False)) for _ in range(2))
        x, y = alignment.pack(a), alignment.pack(b)
        assert alignment.unpack(x).tolist() == a.tolist() and alignment.popcount(x) == n and len(x) <= alignment.DENSE
        assert alignment.unpack(alignment.union([x, y])).tolist() == sorted({*a.tolist(), *b.tolist()})
    pair, place, times = np.array([5, 5, 9]), np.array([1, 3, 1]), np.array([1, 6, 2])
    rebuilt = Counter()
    for key, bitmaps in alignment.planes(pair, place, times):
        for k, bitmap in enumerate(bitmaps):
            for p in alignment.unpack(bitmap).tolist():
                rebuilt[key, p] += 1 << k
    assert rebuilt == {(5, 1): 1, (5, 3): 6, (9, 1): 2}


def test_stretches_give_the_tokens_of_whole_texts(aligner, monkeypatch):
    monkeypatch.setattr(alignment, "STRETCH", 3)
    for text in TEXTS:
        if text:
            parts = list(aligner.stretches(text))
            assert " ".join(parts) == text
            assert [i for p in parts for i in aligner.b.encode(p)] == aligner.b.encode(text)
            a = [i for p in parts for i in aligner.first(" " + p)]
            assert a == aligner.a.encode(" " + text, add_special_tokens=False).ids


def test_long_text_in_stretches(aligner, monkeypatch):
    text = " ".join(str(i) for i in range(500))
    whole = aligner.text(text)
    monkeypatch.setattr(alignment, "STRETCH", 50)
    again = aligner.text(text)
    assert whole[:4] == again[:4] and whole[4].tolist() == again[4].tolist()


def test_both_libraries_give_the_same_ids(aligner):
    assert aligner.fast
    draw, steady = np.random.default_rng(3), [chr(c) for c in range(0x20000) if alignment._STEADY.fullmatch(chr(c))]
    for n in range(400):
        text = "".join(draw.choice(steady, 40)) + "'s 'll  \n\n \t1a " + "".join(draw.choice(list("ab1 \n\t.'é漢"), 40))
        assert aligner.fast.encode_ordinary(text) == aligner.a.encode(text, add_special_tokens=False).ids
