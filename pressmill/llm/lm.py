"""Language-model scores: word counts of the corpus over subword lattices.

A text is drawn from one of a few classes (its language, where the table knows it; scoring never
looks at it) and its probability is the sum over them. Within a class a token's probability is its
discounted count there plus the discounted mass times an equal mixture of its share in the whole
corpus and the class's lattice, which sums over all segmentations of the word into pieces. The lattice
learns from the class's distinct training words, which is what the discount takes from.

Counts are summed by word over all training texts. Words above a frequency that at most HEAD words
reach are looked up in the task (a bounded broadcast); only the rare rest is joined, and rare words
are no hot keys.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.llm.common import crc_mod, keep, text_bytes
from pressmill.llm.lattice import Lattice
from pressmill.llm.vocabulary import load

HEAD = 150_000
CLASSES = 6  # the most frequent values of the class column; all others are one more class
FLUSH = 300_000  # distinct words that a task sums before it passes them on
ROUNDS = 2  # expectation-maximisation passes over the distinct words
END = 1e-3  # share of the end in the lattice's part
LN10 = math.log(10)


def tokens(text):
    return text.lower().split()


def _count(batches):
    """(word, k, c): occurrences in training texts of class k; words of other texts come with 0."""
    seen = {}

    def rows():
        for k, counts in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array([k] * len(counts), pa.int32()),
                                              pa.array(list(counts.values()), pa.int64())], ["word", "k", "c"])
        seen.clear()

    for batch in batches:
        for text, k in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
            if k is None:
                known = seen.setdefault(0, Counter())
                for w in set(tokens(text)):
                    known.setdefault(w, 0)
            else:
                seen.setdefault(k, Counter()).update(tokens(text))
        if sum(map(len, seen.values())) > FLUSH:
            yield from rows()
    yield from rows()


class Model:
    """Everything that scores a token: totals of the corpus and of each class, and the lattices."""

    def __init__(self, total, distinct, ends, by_class):
        """by_class: (tokens, distinct, ends, words seen once, twice) of each class, ends counted as tokens."""
        self.total, self.distinct, self.ends = total, distinct, ends
        n, v, e, once, twice = (np.array(x, float) for x in zip(*by_class))
        self.n, self.class_ends = np.maximum(n, 1), e
        self.discount = np.where(once > 0, np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95), 0.5)
        self.left = np.where(n > 0, self.discount * v / self.n, 1.0)
        self.prior = np.log10((e + 0.5) / (e + 0.5).sum())
        self.lattices = []

    def base(self, c):
        return np.log10((np.asarray(c) + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def _mixed(self, seen, every, low):
        """log10 probabilities by token and class from counts and the lattices' natural logs."""
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(seen - self.discount, 0) / self.n)
            share = np.log(every / max(self.total, 1))[:, None]
            rest = np.logaddexp(share, low) + math.log(0.5) if self.total else low
            return np.logaddexp(own, np.log(self.left) + rest) / LN10

    def score(self, words, seen, every):
        """log10 probabilities of words, a column for each class, and one by the lattices alone (classes alike)."""
        low = np.stack([lattice.logprob(words) for lattice in self.lattices], axis=1) + math.log1p(-END)
        return np.c_[self._mixed(seen, every, low), self.alone(low)]

    @staticmethod
    def alone(low):
        return (np.logaddexp.reduce(low, axis=1) - math.log(low.shape[1])) / LN10

    def end(self):
        row = self._mixed(self.class_ends[None, :], np.array([float(self.ends)]), np.full((1, len(self.n)), math.log(END)))
        return float(self.base(self.ends)), np.r_[row[0], math.log(END) / LN10]


def _expected(shared, k):
    def run(batches):
        total = None
        for batch in batches:
            words = batch.column(0).to_pylist()
            if words:
                found = shared.value[k].expected(words, np.ones(len(words)))
                total = found if total is None else total + found
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at])], ["k", "piece", "n"])

    return run


def _scored(shared, classes):
    """(word, c, c0, c1, ...) to (word, c, base, score), score an array over the classes."""
    def run(batches):
        model = shared.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            if words:
                every = batch.column(1).to_numpy()
                seen = np.stack([batch.column(2 + k).to_numpy() for k in range(classes)], axis=1)
                score = model.score(words, seen, every)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.base(every)),
                                                  pa.array(score.tolist(), pa.list_(pa.float64()))], ["word", "c", "base", "score"])

    return run


def _classes(docs, held_out, doc_id, column, most):
    """The class of a row as a column expression, and the number of classes."""
    if column is None or column not in docs.columns:
        return F.lit(0), 1
    value = F.col(column).cast("string")
    top = docs.where(~held_out(F.col(doc_id)) & value.isNotNull()).groupBy(value.alias("v")).count().orderBy(F.desc("count"), "v").limit(most).collect()
    k = F.lit(len(top))
    for i, r in enumerate(top):
        k = F.when(value == r["v"], F.lit(i)).otherwise(k)
    return k, len(top) + 1


def train(docs, held_out, doc_id="doc_id", text="text", column="lang", vocabulary=None, rounds=ROUNDS):
    """(words, model): the table word, c, base, score of all words of ``docs``, and the model. Texts
    whose id passes ``held_out`` give no counts."""
    context = docs.sparkSession.sparkContext
    k, classes = _classes(docs, held_out, doc_id, column, CLASSES)
    kind = F.when(~held_out(F.col(doc_id)), k)
    read = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), kind.alias("k"))
    parts = [F.sum(F.when(F.col("k") == i, F.col("c")).otherwise(F.lit(0))).alias(f"c{i}") for i in range(classes)]
    counts = keep(read.mapInArrow(_count, "word string, k int, c long").groupBy("word").agg(F.sum("c").alias("c"), *parts))
    facts = [x for i in range(classes) for x in (
        F.coalesce(F.sum(f"c{i}"), F.lit(0)), F.count_if(F.col(f"c{i}") > 0), F.count_if(F.col(f"c{i}") == 1), F.count_if(F.col(f"c{i}") == 2))]
    t = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), *facts).first()
    ends = {r["k"]: r["count"] for r in read.select("k").where("k is not null").groupBy("k").count().collect()}
    of = lambda i: (t[2 + 4 * i] + ends.get(i, 0), t[3 + 4 * i] + (i in ends), ends.get(i, 0), t[4 + 4 * i], t[5 + 4 * i])
    texts = sum(ends.values())
    model = Model(t[0] + texts, t[1] + (texts > 0), texts, [of(i) for i in range(classes)])
    vocabulary = vocabulary or load()
    model.lattices = [Lattice(vocabulary)] * classes
    for _ in range(rounds):
        shared, uses = context.broadcast(model.lattices), None
        for i in range(classes):
            if of(i)[1]:
                found = counts.where(f"c{i} > 0").select("word").mapInArrow(_expected(shared, i), "k int, piece int, n double")
                uses = found if uses is None else uses.unionAll(found)
        got = np.zeros((classes, len(model.lattices[0].pieces) + 1))
        for r in uses.groupBy("k", "piece").agg(F.sum("n").alias("n")).collect() if uses is not None else []:  # pieces x classes at most
            got[r["k"], r["piece"]] = r["n"]
        model.lattices = [Lattice(vocabulary, x) for x in got]
    every = ["word", "c", *(f"c{i}" for i in range(classes))]
    return keep(counts.select(every).mapInArrow(_scored(context.broadcast(model), classes), "word string, c long, base double, score array<double>")), model


def _common(words, head):
    """The frequency that at most ``head`` words reach, from counts by size class."""
    sizes = words.where("c > 0").groupBy(F.floor(4 * F.log2("c")).cast("int").alias("k")).agg(F.count("*").alias("n"), F.min("c").alias("c"))
    total, limit = 0, None
    for r in sorted(sizes.collect(), key=lambda r: -r["k"]):  # a few hundred classes at most
        total += r["n"]
        if total > head:
            break
        limit = r["c"]
    return limit


def scores(docs, held_out, doc_id="doc_id", text="text", column="lang", vocabulary=None, rounds=ROUNDS, head=HEAD):
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), and
    lattice_score, the marginal of the subword lattices alone, without any count of a whole word.

    Null and empty texts consist of the end alone. Without training texts nothing is known and the
    lattice, with the vocabulary's own weights, scores everything. ``column`` may be None or missing: one class.
    """
    words, model = train(docs, held_out, doc_id, text, column, vocabulary, rounds)
    limit, classes = _common(words, head), len(model.n)
    top = [] if limit is None else words.where(F.col("c") >= limit).select("word", "base", "score").collect()
    number = {r["word"].encode(): i for i, r in enumerate(top)}
    table = np.array([[r["base"], *r["score"]] for r in top]).reshape(len(top), classes + 2)
    shared = docs.sparkSession.sparkContext.broadcast((number, table))
    end_base, end_score = model.end()
    end, known_end = np.r_[end_base, end_score], int(model.ends > 0)
    marks = ["s%d" % i for i in range(classes + 1)]  # the last one by the lattices alone

    def run(batches):
        number, table = shared.value
        for batch in batches:
            rows, ids, word, n, known, sums = [], [], [], [], [], []
            for k, i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                all_tokens = tokens(t)
                at, times, sure = [], [], known_end
                for w, m in Counter(all_tokens).items():
                    got = number.get(w)
                    if got is not None:
                        at.append(got)
                        times.append(m)
                        sure += m
                    else:
                        rows.append(k)
                        ids.append(None)
                        word.append(w)
                        n.append(m)
                        known.append(0)
                        sums.append(None)
                rows.append(k)
                ids.append(i)
                word.append(b" %d" % k)  # no word has a blank: the document's own row meets none
                n.append(len(all_tokens) + 1)
                known.append(sure)
                sums.append((end + np.array(times, float) @ table[at] if at else end).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, batch.column(1).type), pa.array(word, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(sums, pa.list_(pa.float64()))], ["row", "doc_id", "word", "n", "known", "sums"])

    kind = docs.schema[doc_id].dataType.simpleString()
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    parts = read.mapInArrow(run, f"row long, doc_id {kind}, word string, n long, known long, sums array<double>")
    rare = (words if limit is None else words.where(F.col("c") < limit)).withColumnRenamed("word", "w")
    met = parts.join(rare, F.col("word") == F.col("w"), "left")
    own = F.col("word").startswith(" ")
    add = lambda i: F.when(own, F.col("sums")[i]).otherwise(F.col("n") * (F.col("base") if i == 0 else F.col("score")[i - 1]))
    sums = met.groupBy("row").agg(
        F.first(F.when(own, F.col("doc_id")), True).alias("doc_id"), F.sum(F.when(own, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(own, F.col("known")).otherwise(F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0)))).alias("n_known"),
        F.sum(add(0)).alias("base_score"), *[F.sum(add(i + 1)).alias(m) for i, m in enumerate(marks)])
    each = F.array(*[F.col(m) + F.lit(float(p)) for m, p in zip(marks[:-1], model.prior)])
    sums = sums.withColumn("each", each).withColumn("best", F.array_max("each"))
    total = F.col("best") + F.log10(F.aggregate("each", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - F.col("best"))))
    return sums.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                       F.lit(model.total).cast("long").alias("train_tokens"), "base_score", total.alias("score"), F.col(marks[-1]).alias("lattice_score"))


def held_out(doc_id):
    return crc_mod(doc_id, 10) == 0
