"""Toxicity, token counts, language-model scores and the pipeline against brute force and held-out rows."""

import math
import os
from collections import Counter

import numpy as np
import pytest
from test_small import ITEM, components_of, plain_fingerprint, plain_lines, plain_mix, prose

from pressmill.llm import lm, tokencount, toxicity
from pressmill.llm.lattice import Lattice
from pressmill.llm.vocabulary import MARK, default_path, load

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return load()


def test_nearest_is_exact():
    draw = np.random.default_rng(4)
    terms = [f"bad{i}" for i in range(12)]
    text = lambda: " ".join([*(terms[i] for i in draw.integers(12, size=draw.integers(1, 5))), *["ok"] * int(draw.integers(9))])
    examples = [text() for _ in range(400)]
    index = toxicity.Index(toxicity.Terms(terms), draw.random(12) + 1, examples, [int(x) for x in draw.integers(2, size=400)], list(range(400)))
    dense = np.zeros((400, 13), np.float32)
    for i, t in enumerate(examples):
        at, weight = index.vector(t)
        dense[i, at] = weight
    for _ in range(40):
        t = text()
        at, weight = index.vector(t)
        full = dense[:, at] @ weight
        score, place = index.nearest(at, weight, 10)
        assert np.allclose(score, np.sort(full)[::-1][:10], atol=1e-5)
        assert np.allclose(full[index.number[place]], score, atol=1e-5)


def test_toxicity(spark):
    draw = np.random.default_rng(5)
    rows, marks = [], []
    for i in range(900):
        bad = i % 9 == 0
        words = prose(i, 60).split()
        for k in draw.integers(60, size=3 if bad else 0):
            words[k] = "grumpel" + "abcdef"[int(draw.integers(6))]
        rows.append((i, " ".join(words), "x"))
        marks.append((i, 1, int(bad)))
    rows += [(901, None, "x"), (902, "", "x"), (903, "GRUMPELZZ " + prose(1, 40), "x"), rows[1]]
    marks += [(901, 1, 1), (5, 1, None), (7777, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    index = toxicity.fit(docs, labels, train=lambda c: ~toxicity.held_out(c))
    got = {r["doc_id"]: r for r in toxicity.scored(docs, index).collect()}
    assert all((got[i]["score"] >= 0.7) == (i % 9 == 0) for i in range(900))
    assert got[903]["score"] >= 0.7 and got[901]["score"] == got[902]["score"] < 0.1
    assert got[0]["evidence"] and all(i % 9 == 0 for i in got[0]["evidence"])
    left = toxicity.drop_toxic(docs, index)
    assert left.columns == docs.columns and left.count() == docs.count() - 101
    empty = docs.limit(0)
    assert toxicity.scored(empty, toxicity.fit(empty, labels)).count() == 0
    bare = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.scored(docs, bare).collect()} == {0.0}


def test_counts_against_plain_search(vocabulary):
    count, known = tokencount.Counter(vocabulary), dict(zip(vocabulary.pieces, vocabulary.scores))

    def best(text):
        n = len(text)
        path = [(0.0, 0)] + [(-math.inf, 0)] * n
        for e in range(1, n + 1):
            for s in range(max(0, e - 16), e):
                x, size = known.get(text[s:e]), 1
                if x is None and e - s == 1:
                    x, size = vocabulary.unknown, len(text[s:e].encode())
                if x is not None and path[s][0] + x > path[e][0]:
                    path[e] = (path[s][0] + x, path[s][1] + size)
        return path[n][1], path[n][0]

    for w in ["the", "theain", "éreauux", "漢字🙂", "a  b", "ab\n\ncd", "   ", "tionthe.x", "\t x", "Ünï " * 20]:
        assert count.text(w) == best(MARK + w.replace(" ", MARK))
    assert count.text("") == count.text(None) == (0, 0.0)


def test_counts_against_the_tokenizer(vocabulary):
    """The library's own unigram search over the same file: its model type is set from 2 (BPE) to 1."""
    import sentencepiece

    raw = open(default_path(), "rb").read()
    at = raw.rindex(b"\x12\x06tok_v0\x18\x02") + 9
    model = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x01" + raw[at + 1:])
    count, score = tokencount.Counter(vocabulary), dict(zip(vocabulary.pieces, vocabulary.scores))
    for w in set(prose(9, 300).split()) | {"thentblere", "erheti", "theain", "stionandth"}:
        first = model.nbest_encode_as_pieces(w, 2)[0]
        tokens, total = count.text(w)
        assert total == sum(score[p] for p in first) and tokens == len(first)


def test_counted(spark, vocabulary):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "the the", 1), (3, "the the", 1), (4, "漢 " * 5000, 1)], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r["n_tokens"] for r in tokencount.counted(docs, vocabulary).collect()}
    assert got[1] == got[2] == 0 and got[3] == 4 and tokencount.counted(docs, vocabulary).count() == 5
    assert tokencount.with_counts(docs, vocabulary).columns == ["doc_id", "text", "n_tokens", "n_tokens_"]
    assert tokencount.counted(docs.limit(0), vocabulary).count() == 0


def test_lattice(vocabulary):
    lattice = Lattice(vocabulary)
    words = ["the", "thntblere", "a", "ñ漢🙂", "x" * 400, "tionthe."]
    weight = dict(zip(lattice.pieces, lattice.logp))
    for w, got in zip(words, lattice.logprob(words)):
        t = MARK + w
        a = [0.0] + [-math.inf] * len(t)
        for e in range(1, len(t) + 1):
            for s in range(max(0, e - 16), e):
                x = weight.get(t[s:e])
                if x is None and e - s == 1:
                    x = lattice.unknown - len(t[s:e].encode()) * math.log(256)
                if x is not None:
                    a[e] = np.logaddexp(a[e], a[s] + x)
        assert math.isclose(got, a[-1] + lattice.stop, rel_tol=1e-9)
    used = lattice.expected(words[:2], [2.0, 3.0])
    assert used[-1] == 5 and math.isclose(used[:-1][lattice.first].sum(), 5)
    better = Lattice(vocabulary, lattice.expected(words, np.ones(len(words))) * 1e5)
    assert better.logprob(words).sum() > lattice.logprob(words).sum()
    assert lattice.logprob([]).size == 0


@pytest.mark.parametrize("head", [0, 10, lm.HEAD])
def test_scores(spark, vocabulary, head):
    rows = [(i, prose(i % 40, 30) + (" Unseen%d" % i if i % 5 == 0 else ""), "ab"[i % 2]) for i in range(120)]
    rows += [(200, None, None), (201, "", "a"), (202, "THE \x0b the", "b"), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lm.scores(docs, lm.held_out, vocabulary=vocabulary, head=head).collect()
    assert len(got) == len(rows)
    import zlib

    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows}
    words = {r[0]: [*(r[1] or "").encode().lower().split(), None] for r in rows}
    c = Counter(w for r in rows if not held[r[0]] for w in words[r[0]])
    n, v = sum(c.values()), len(c)
    for r in got:
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words[r["doc_id"]])
        want = (held[r["doc_id"]], len(words[r["doc_id"]]), sum(c[w] > 0 for w in words[r["doc_id"]]), n)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    # The score is the classes' sum, each from its own counts, the corpus and the lattice.
    table, model = lm.train(docs, lm.held_out, vocabulary=vocabulary)
    known = {r["word"].encode(): np.array(r["score"]) for r in table.collect()}
    end = model.end()[1]
    for r in got[:20]:
        whole = end + sum((known[w] for w in words[r["doc_id"]][:-1]), np.zeros(len(end)))
        each = model.prior + whole[:-1]
        assert math.isclose(r["score"], np.log10((10.0 ** (each - each.max())).sum()) + each.max(), rel_tol=1e-7)
        assert math.isclose(r["lattice_score"], whole[-1], rel_tol=1e-7)
    # by the lattices alone a word is the mean of the classes' marginals, whatever its counts
    some = list(known)[:5]
    low = np.stack([x.logprob([w.decode() for w in some]) for x in model.lattices], axis=1) + math.log(1 - lm.END)
    for w, x in zip(some, low):
        assert math.isclose(known[w][-1], math.log10(np.exp(x).mean()), rel_tol=1e-9)
    assert lm.scores(docs.limit(0), lm.held_out, vocabulary=vocabulary).count() == 0


def test_long_words(vocabulary, monkeypatch):
    """Words of one piece of text without any blank: edge by edge, as many words at once, and in time linear in length."""
    import time

    from pressmill.llm import lattice as module

    draw, lattice = np.random.default_rng(1), Lattice(vocabulary)
    words = ["".join(draw.choice(list("abcde é漢+/7"), n)) for n in (3000, 2500, 2049, 2048, 40, 1)]
    alone, uses = lattice.logprob(words), lattice.expected(words, np.arange(1, 7))
    monkeypatch.setattr(module, "ALONE", 1 << 30)
    assert np.allclose(alone, lattice.logprob(words), rtol=1e-10) and np.allclose(uses, lattice.expected(words, np.arange(1, 7)), rtol=1e-6, atol=1e-6)
    monkeypatch.undo()
    start = time.process_time()
    assert np.isfinite(lattice.logprob(["".join(draw.choice(list("abcdefghijklmnop0123456789+/"), 1_000_000))])[0])
    assert time.process_time() - start < 60


def test_shares_of_known_words_stay_below_one(spark, vocabulary):
    docs = spark.createDataFrame([(i, prose(i, 50), "ab"[i % 2]) for i in range(60)], "doc_id long, text string, lang string")
    table, model = lm.train(docs, lm.held_out, vocabulary=vocabulary)
    mass = sum(10.0 ** np.array(r["score"]) for r in table.collect()) + 10.0 ** model.end()[1]
    assert (mass < 1 + 1e-9).all() and (mass[:2] > 0.3).all()  # the last one: by the lattices alone


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
def test_pipeline(spark):
    import corpus_pipeline

    seen, docs = {}, spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = corpus_pipeline.keep(stage(spark, docs, SMALL))
        seen[name] = (before, {r["doc_id"]: r for r in docs.collect()})
        assert docs.columns == (columns if name != "mixing" else [*columns, "copies"])
    before, after = seen["toxicity"]
    documents, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    index = toxicity.fit(documents, labels, train=lambda c: ~toxicity.held_out(c))
    assert set(after) == {r["doc_id"] for r in toxicity.scored(documents, index).where("score < 0.7").collect()}
    before, after = seen["line_dedup"]
    assert plain_lines(sorted(before.items())) == {i: r["text"] for i, r in after.items()}
    before, after = seen["near_dedup"]
    root = components_of([(i, plain_fingerprint(t)) for i, t in before.items()])
    assert set(after) == {i for i in root if root[i] == i}
    before, after = seen["decontamination"]
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = ITEM.findall((r["text"] or "").encode().lower())
        windows |= {tuple(w[k:k + 13]) for k in range(max(1, len(w) - 12))}
    for i, t in before.items():
        w = ITEM.findall((t or "").encode().lower())
        hit = {k + d for k in range(len(w)) for n in {len(x) for x in windows} if tuple(w[k:k + n]) in windows for d in range(n)}
        assert (i in after) == (not (hit and 20 * len(hit) >= len(w)))
    before, after = seen["mixing"]
    sources = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    size = {i: len((t or "").encode().split()) for i, t in before.items()}
    target, taken = plain_mix([(sources[i], n) for i, n in size.items()]), Counter()
    for i, r in after.items():
        taken[sources[i]] += r["copies"] * size[i]
    longest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= longest for s in target)
    assert corpus_pipeline.run(spark, SMALL).count() == len(after)
