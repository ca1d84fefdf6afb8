"""Toxicity by the nearest labelled examples.

Terms are weighed by TF-IDF; a text is compared by exact cosine with labelled examples held in an
inverted index cut into blocks. Each block stores the largest weight of each term, so the sum of
those maxima bounds every cosine in the block; blocks whose bound can't reach the k-th best so far are
skipped, which changes no result. The K best (ties by example number) vote with their cosine,
and the vote is calibrated on the examples themselves, each left out of its own vote.

Fitting reads at most TRAINING labelled rows, so their ids can be broadcast and no text moves.
Terms are words and word beginnings that are clearly likelier in toxic training texts than in others, a
ratio that does not depend on how many of the texts are toxic; document frequencies are counted over all texts. The examples are at most EXAMPLES distinct training
texts that hold such a term, half of each label where there are enough; they travel to the tasks.
"""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.llm.common import crc_mod, keep

TERMS = 2048  # terms kept, most significant first
EXAMPLES = 8192
TRAINING = 40_000  # labelled rows that are learnt from at most, by hash of their id
K = 32
BLOCK = 64
LEAST_CHI2, LIKELIER = 30.0, 4.0  # a term's chi-square, and how many times likelier it must be in a toxic text than in another
PRIOR = 0.5  # weight of the base rate beside the neighbours' cosines
STEMS = range(3, 9)  # characters of the word beginnings that are terms
REST = ""  # the term of all other words, which tells one insult in a long text from many in a short one
_WORD = re.compile(r"\w+")


def words(text):
    return _WORD.findall(text.lower())


def candidates(text, memo):
    """Word beginnings, and whole words ending in "$": toxic words inflect. ``memo`` keeps those of a word."""
    found = set()
    for w in set(words(text)):
        own = memo.get(w)
        if own is None:
            own = memo[w] = (*(w[:n] for n in STEMS if n <= len(w)), w + "$")
        found.update(own)
    return found


class Terms:
    """The terms in use: none begins another, so a word holds one at most."""

    def __init__(self, terms):
        self.number = {t: i for i, t in enumerate(terms)}
        self.heads = {t.rstrip("$")[: STEMS[0]] for t in terms}
        self.anywhere = None

    def __getstate__(self):
        return {**self.__dict__, "anywhere": None}

    def holds(self, low):
        """Whether a lower-cased text holds the letters of any term anywhere: most texts do not."""
        if not self.number:
            return False
        if self.anywhere is None:
            import ahocorasick

            self.anywhere = ahocorasick.Automaton()
            for t in self.number:
                self.anywhere.add_word(t.rstrip("$"), True)
            self.anywhere.make_automaton()
        return next(self.anywhere.iter(low), None) is not None

    def find(self, word):
        """The term of a word, or -1."""
        return next((self.number[t] for t in (*(word[:n] for n in STEMS if n <= len(word)), word + "$") if t in self.number), -1)

    def count(self, text):
        """Occurrences by term number, and the number of other words (not counted where there is no term)."""
        counts, rest = Counter(), 0
        low = text.lower()
        if not self.holds(low):
            return counts, rest
        first = STEMS[0]
        for w in _WORD.findall(low):
            if w[:first] in self.heads and (i := self.find(w)) >= 0:
                counts[i] += 1
            else:
                rest += 1
        return counts, rest


def texts(column):
    return [x or "" for x in column.to_pylist()]


def _count_terms(batches):
    """Training texts with each term, toxic and in all, summed within the task."""
    toxic, every, t, n, memo = Counter(), Counter(), 0, 0, {}

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(list(every), pa.string()), pa.array([toxic[w] for w in every], pa.int64()),
                                           pa.array(list(every.values()), pa.int64())], ["term", "toxic", "n"])

    for batch in batches:
        for text, label in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
            if len(memo) > 50_000:
                memo.clear()
            found = candidates(text, memo)
            every.update(found)
            n += 1
            if label:
                toxic.update(found)
                t += 1
        if len(every) > 300_000:
            yield flush()
            toxic, every = Counter(), Counter()
    every[REST], toxic[REST] = n, t  # the texts themselves
    yield flush()


def _frequencies(terms):
    """Texts with each term, by number, and all texts under -1."""
    def run(batches):
        found, n = Counter(), 0
        for batch in batches:
            for text in texts(batch.column(0)):
                found.update(terms.count(text)[0].keys())
                n += 1
        found[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["term", "n"])

    return run


class Index:
    """The examples: unit TF-IDF vectors in blocks of BLOCK, with each block's term maxima."""

    def __init__(self, terms, idf, examples, labels, ids):
        self.terms, self.idf = terms, np.array([*idf, 1.0], np.float32)  # the rest is in all texts
        vectors = [self.vector(t) for t in examples]
        order = sorted((i for i, v in enumerate(vectors) if len(v[0])), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), i))
        self.blocks, width = [], len(idf) + 1
        self.best = np.zeros((width, -(-len(order) // BLOCK)), np.float32)
        self.labels = np.array([labels[i] for i in order], np.float64)
        self.number = np.array(order, np.int64)
        self.ids = [ids[i] for i in order]
        for b, at in enumerate(range(0, len(order), BLOCK)):
            postings = {}
            for slot, i in enumerate(order[at:at + BLOCK]):
                for term, weight in zip(*vectors[i]):
                    postings.setdefault(int(term), ([], []))
                    postings[int(term)][0].append(slot)
                    postings[int(term)][1].append(weight)
            self.blocks.append({t: (np.array(s, np.int32), np.array(w, np.float32)) for t, (s, w) in postings.items()})
            for t, (_, w) in postings.items():
                self.best[t, b] = max(w)
        self.base, self.curve = 0.0, ([0.0, 1.0], [0.0, 1.0])

    def vector(self, text):
        """(term numbers, weights) of a text; the weights have length one. Without a term there are none."""
        counts, rest = self.terms.count(text)
        if not counts:
            return np.zeros(0, np.int32), np.zeros(0, np.float32)
        if rest:
            counts[len(self.idf) - 1] = rest
        at = np.array(sorted(counts), np.int32)
        weight = np.array([1 + math.log(counts[t]) for t in at.tolist()], np.float32) * self.idf[at]
        return at, weight / np.sqrt((weight * weight).sum())

    def nearest(self, at, weight, k=K, without=-1):
        """(cosines, places) of the k nearest examples, best first; exact."""
        if not len(at) or not self.blocks:
            return np.zeros(0), np.zeros(0, np.int64)
        bound = weight @ self.best[at]
        score, place = np.zeros(0, np.float32), np.zeros(0, np.int64)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(score) >= k and bound[b] < score[-1] - 1e-6:
                break
            here = np.zeros(BLOCK, np.float32)
            for t, w in zip(at.tolist(), weight):
                if (posting := self.blocks[b].get(t)) is not None:
                    here[posting[0]] += w * posting[1]
            slot = np.flatnonzero(here > 0)
            slot = slot[b * BLOCK + slot != without]
            score, place = np.r_[score, here[slot]], np.r_[place, b * BLOCK + slot]
            first = np.lexsort((self.number[place], -score))[:k]
            score, place = score[first], place[first]
        return score, place

    def vote(self, score, place):
        """Share of toxic neighbours weighted by cosine; the base rate counts as PRIOR."""
        return float((score @ self.labels[place] + PRIOR * self.base) / (score.sum() + PRIOR))

    def calibrate(self, base, share):
        """Isotonic curve from left-out votes to observed shares (pool adjacent violators); ``share`` are the weights
        that undo the sampling by label."""
        self.base = base
        votes = []
        for b, block in enumerate(self.blocks):
            rows = {}
            for t, (slots, weights) in block.items():
                for s, w in zip(slots.tolist(), weights.tolist()):
                    rows.setdefault(s, []).append((t, w))
            for s, row in rows.items():
                row.sort()
                at, weight = np.array([t for t, _ in row], np.int32), np.array([w for _, w in row], np.float32)
                i = b * BLOCK + s
                votes.append((self.vote(*self.nearest(at, weight, without=i)), self.labels[i], share[int(self.labels[i])]))
        pools = []
        for v, y, w in sorted(votes):
            pools.append([v * w, y * w, w])
            while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        if pools:
            # A tenth of a text of each label in every pool keeps scores off zero and one.
            self.curve = ([v / w for v, _, w in pools], [(y + 0.1 * base) / (w + 0.1) for _, y, w in pools])

    def score(self, text):
        """(score, cosines, places). Without any known term the score is the share of toxic texts among such."""
        at, weight = self.vector(text)
        near, place = self.nearest(at, weight)
        if not len(near):
            return self.blank, near, place
        return float(np.interp(self.vote(near, place), *self.curve)), near, place


def fit(docs, labels, doc_id="doc_id", text="text", label="toxic", train=None, terms=TERMS, examples=EXAMPLES, training=TRAINING):
    """The Index learnt from the labelled rows of ``docs`` (those that pass the condition ``train``).

    Null labels and texts are no examples; of several labels of a document each counts. With no training
    rows, or only one label, there are no terms and every score is the base rate (0 without rows).
    """
    spark = docs.sparkSession
    marks = labels.where(F.col(label).isNotNull()).select(F.col(doc_id).alias("_id"), (F.col(label) != 0).cast("int").alias("_label"))
    marks = marks if train is None else marks.where(train(F.col("_id")))
    many = marks.count()
    if many > training:  # only hashes that can be among the first: the sort below stays small in every task
        share = min(1.0, 1.2 * training / many + 0.001)
        marks = marks.where(F.xxhash64("_id") <= min(int(share * 2 ** 64) - 2 ** 63, 2 ** 63 - 1))
    marks = marks.orderBy(F.xxhash64("_id"), "_id", "_label").limit(training)
    read = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    rows = read.where("_text is not null").join(F.broadcast(marks), "_id")
    rows = keep(rows.groupBy("_text", "_label").agg(F.min("_id").alias("_id")))
    counts = keep(rows.select("_text", "_label").mapInArrow(_count_terms, "term string, toxic long, n long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("n").alias("n")))
    total = counts.where(F.length("term") == 0).first()
    n, t = (total["n"], total["toxic"]) if total else (0, 0)
    best, idf = [], []
    if 0 < t < n:
        chi2 = F.expr(f"pow(toxic * {n}D - n * {t}D, 2) * {n}D / (n * ({n}D - n) * {t}D * {n - t}D)")
        likelier = F.expr(f"toxic * {n - t}D >= {LIKELIER}D * (n - toxic) * {t}D")
        strong = counts.where((F.length("term") > 0) & (F.col("n") < n)).withColumn("chi2", chi2).where(
            (F.col("chi2") >= LEAST_CHI2) & likelier)
        stems = set()
        for r in strong.orderBy(F.desc("chi2"), F.desc(F.length("term")), "term").limit(8 * terms).select("term").collect():
            stem = r["term"].rstrip("$")
            if len(best) < terms and not any(stem.startswith(s) or s.startswith(stem) for s in stems):
                stems.add(stem)
                best.append(r["term"])
        found = read.select("_text").mapInArrow(_frequencies(Terms(best)), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
        df = {r["term"]: r["n"] for r in found.collect()}  # at most ``terms`` + 1 rows
        idf = [math.log((1 + df.get(-1, 0)) / (1 + df.get(i, 0))) + 1 for i in range(len(best))]
    known, order = Terms(best), F.xxhash64("_text")

    def holds(batches):
        for batch in batches:
            has = pa.array([bool(known.count(x)[0]) for x in texts(batch.column(0))], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, has], ["_text", "_label", "_id", "has"])

    kind = docs.schema[doc_id].dataType.simpleString()
    marked = rows.mapInArrow(holds, f"_text string, _label int, _id {kind}, has boolean")
    sizes = {(r["has"], r["_label"]): r["n"] for r in marked.groupBy("has", "_label").agg(F.count("*").alias("n")).collect()}
    some = {y: sizes.get((True, y), 0) for y in (0, 1)}
    take = {y: min(some[y], max(examples // 2, examples - some[1 - y])) for y in (0, 1)}
    picked = [r for y in (0, 1) if take[y] for r in marked.where(f"has and _label = {y}").orderBy(order, "_text").limit(take[y]).collect()]
    index = Index(known, idf, [r["_text"] for r in picked], [r["_label"] for r in picked], [r["_id"] for r in picked])
    bare = {y: sizes.get((False, y), 0) for y in (0, 1)}
    base = t / n if n else 0.0
    index.calibrate(base, {y: some[y] / take[y] if take[y] else 1.0 for y in (0, 1)})
    index.blank = (bare[1] + base) / (bare[0] + bare[1] + 1)
    return spark.sparkContext.broadcast(index)


def scored(docs, index, doc_id="doc_id", text="text", evidence=3):
    """One row per row of ``docs``: doc_id, text_hash, score (0 to 1), evidence (ids of the nearest examples), cosines.
    Null and empty texts, like texts without any known term, get the share of toxic texts among such."""
    def run(batches):
        model = index.value
        for batch in batches:
            rows = [model.score(t) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.float64()),
                 pa.array([[model.ids[i] for i in r[2][:evidence]] for r in rows], pa.list_(batch.column(0).type)),
                 pa.array([r[1][:evidence].tolist() for r in rows], pa.list_(pa.float64()))],
                ["doc_id", "text_hash", "score", "evidence", "cosines"])

    kind = docs.schema[doc_id].dataType.simpleString()
    value = F.col(text).cast("string")
    return docs.select(doc_id, F.xxhash64(value), value).mapInArrow(
        run, f"doc_id {kind}, text_hash long, score double, evidence array<{kind}>, cosines array<double>")


def held_out(doc_id):
    return crc_mod(doc_id, 3) == 1


def drop_toxic(docs, index, threshold=0.7, doc_id="doc_id", text="text"):
    """``docs`` without the rows whose text scores ``threshold`` or more; one pass, rows stay as they are."""
    def run(batches):
        model = index.value
        for batch in batches:
            text_at = batch.schema.get_field_index(text)
            good = pa.array([model.score(t)[0] < threshold for t in texts(batch.column(text_at))], pa.bool_())
            yield batch.filter(good)

    return docs.mapInArrow(run, docs.schema)
