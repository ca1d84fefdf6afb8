"""URL filters: rules first, then a ratio of character language models.

Rules (host and path prefix) decide the URLs they fit and label them accepted or rejected. On these labels two
variable-order Markov models of characters are learned: a context of up to ORDER characters is part of a
model if it was seen, probabilities are smoothed from the longest known context down to
a uniform distribution over the alphabet (Witten-Bell interpolation). The commonest contexts go to every task; where there
are more, what they do not settle is looked up in the table of all counts. A URL's score is the difference of
its log-likelihoods per character. A logistic curve fitted on labelled URLs that the models have not seen turns the
score into the probability of rejection, and the verdict is block from one half on.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.llm.common import crc_mod, keep, lower_ascii

ORDER = 5  # longest context
CONTEXTS = 1 << 16  # contexts of a model (those seen most often) that are broadcast; grams behind others meet their counts by joins
END, FRONT = "\x03", "\x02"  # written behind and before a URL
FOLDS = 5  # one of so many labelled URLs calibrates instead of training
BINS, WIDTH = 2001, 0.01  # histogram of scores for the calibration: -10 to 10 nats a character
MEMO = 500_000

#: (kind, host and path prefix)
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


# --- rules -----------------------------------------------------------------------------------------------

def host(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path(url):
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_col, path_col, rules=RULES):
    """(kind, rule) of the longest rule that fits the host or a parent domain and begins the path; of equally long
    ones the first. Null where none fits."""
    out = F.lit(None).cast("struct<kind:string,rule:string>")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):  # later cases go first
        name, _, prefix = rule.partition("/")
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith("/" + prefix)
        out = F.when(fits, F.struct(F.lit(kind).alias("kind"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def body(url):
    """The characters that the models read: the URL without its scheme, A-Z lower-cased; null: empty."""
    return lower_ascii(F.coalesce(F.regexp_replace(url, r"^[^:/?#]*://", ""), F.lit("")))


# --- models ----------------------------------------------------------------------------------------------

class Markov:
    """A variable-order model from {context: {character: count}}; ``symbols`` is the size of the alphabet."""

    def __init__(self, counts, symbols):
        self.uniform = 1.0 / (symbols + 1)  # one more for characters never seen
        self.counts = counts
        self.totals = {s: (sum(c.values()), len(c)) for s, c in counts.items()}

    def probability(self, context, character):
        """P(character | context): every known suffix of the context is mixed in, the longest last."""
        p = self.uniform
        for start in range(len(context), -1, -1):
            found = self.counts.get(context[start:])
            if found is None:
                break  # longer contexts are not known either
            total, kinds = self.totals[context[start:]]
            p = (found.get(character, 0) + kinds * p) / (total + kinds)
        return p


class Ratio:
    """Two models and the calibration; ``score`` is log P(accepted) - log P(rejected) per character."""

    def __init__(self, counts, slope=0.0, offset=0.0, whole=True):
        self.whole = whole  # whether ``counts`` holds all contexts
        symbols = len({c for model in counts.values() for c in model.get("", {})})
        self.models = [Markov(counts[k], symbols) for k in ("allow", "block")] if all(counts.get(k) for k in ("allow", "block")) else None
        self.slope, self.offset, self.memo = slope, offset, {}

    def parts(self, text):
        """(log ratio of the characters whose contexts settle it, the grams of the others)."""
        if self.models is None:
            return 0.0, []
        memo, total, rest = self.memo, 0.0, []
        if len(memo) > MEMO:
            memo.clear()
        text = FRONT + text + END
        accepted, rejected = self.models
        for i in range(1, len(text)):
            gram = text[max(0, i - ORDER):i + 1]
            value = memo.get(gram)
            if value is None:
                # every suffix of a known context is known; of others, longer ones may be among those left out
                settled = self.whole or (gram[:-1] in accepted.counts and gram[:-1] in rejected.counts)
                value = memo[gram] = float(np.log(accepted.probability(gram[:-1], gram[-1]) / rejected.probability(gram[:-1], gram[-1]))) if settled else np.nan
            if value == value:
                total += value
            else:
                rest.append(gram)
        return total, rest

    def score(self, text):
        """The score by the contexts at hand."""
        return self.parts(text)[0] / (len(text) + 1)

    def rejection(self, score):
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * score + self.offset, -700, 700)))


def gram_counts(rows):
    """(kind, context, character, n) over all ``rows`` (kind, body): every context of 0 to ORDER characters.
    Grams are counted per task before the shuffle, so that what all URLs share is one row a task."""
    chars = F.split(F.concat(F.lit(FRONT), "body", F.lit(END)), "")
    wide = F.expr(f"transform(sequence(2, size(c)), i -> array_join(slice(c, greatest(i - {ORDER}, 1), least(i, {ORDER + 1})), ''))")
    widest = rows.select("kind", chars.alias("c")).select("kind", F.explode(wide).alias("w")).groupBy("kind", "w").agg(F.count("*").alias("n"))
    grams = widest.select("kind", "w", "n", F.explode(F.expr("sequence(1, length(w))")).alias("k"))
    return grams.groupBy("kind", F.expr("substring(w, length(w) - k + 1, k - 1)").alias("context"),
                         F.expr("substring(w, length(w), 1)").alias("character")).agg(F.sum("n").alias("n"))


def model_counts(counts, contexts=CONTEXTS):
    """{kind: {context: {character: n}}} of the ``contexts`` most frequent contexts of each kind, ties in the order of
    the contexts. A context is never seen more often than its suffix is, and of equals the shorter goes first, so
    every suffix of a known context is known."""
    size = counts.groupBy("kind", "context").agg(F.sum("n").alias("total"))
    out = {}
    for kind in ("allow", "block"):
        chosen = size.where(F.col("kind") == kind).orderBy(F.desc("total"), F.length("context"), "context").limit(contexts)
        rows = counts.where(F.col("kind") == kind).join(chosen.select("context"), "context")
        model = defaultdict(dict)
        for r in rows.select("context", "character", "n").toLocalIterator():
            model[r["context"]][r["character"]] = r["n"]
        out[kind] = dict(model)
    return out


def logistic(positive, negative, at):
    """(slope, offset) of the logistic curve of most likelihood through counts of two classes at the points ``at``;
    half a count of each class at both ends keeps it finite where the classes are apart."""
    positive, negative = positive.astype(float).copy(), negative.astype(float).copy()
    positive[[0, -1]] += 0.5
    negative[[0, -1]] += 0.5
    w = np.zeros(2)
    x = np.c_[at, np.ones(len(at))]
    total = positive + negative
    loss = lambda w: (total * np.logaddexp(0.0, x @ w) - positive * (x @ w)).sum()
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -700, 700)))
        gradient = x.T @ (total * p - positive)
        step = np.linalg.solve((x * (total * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), gradient)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def gram_values(grams, counts, symbols):
    """(gram, value): the log ratio of every distinct gram in ``grams`` by all ``counts``, by joins on its contexts."""
    seen = counts.groupBy("kind", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    asked = grams.select("gram").distinct().withColumn("kind", F.explode(F.array(F.lit("allow"), F.lit("block")))) \
        .withColumn("k", F.explode(F.expr("sequence(0, length(gram) - 1)")))
    asked = asked.select("gram", "kind", "k", F.expr("substring(gram, length(gram) - k, k)").alias("context"), F.expr("right(gram, 1)").alias("character"))
    known = asked.join(seen, ["kind", "context"]).join(counts, ["kind", "context", "character"], "left")
    of = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct(
        "k", F.coalesce("n", F.lit(0)).cast("double").alias("n"), F.col("total").cast("double").alias("total"), F.col("kinds").cast("double").alias("kinds")))))
    both = known.groupBy("gram").agg(of("allow").alias("allow"), of("block").alias("block"))
    p = lambda kind: F.aggregate(kind, F.lit(1.0 / (symbols + 1)), lambda p, s: (s["n"] + s["kinds"] * p) / (s["total"] + s["kinds"]))
    return both.select("gram", F.log(p("allow") / p("block")).alias("value"))


def fit(labelled, contexts=CONTEXTS):
    """(Ratio, counts) learned from ``labelled`` rows (kind: allow or block, body); the counts are None where the Ratio holds
    all of them.

    Counts cover all labelled URLs but every FOLDS-th (by a hash of the URL, so that repeats fall on one side); those
    calibrate, as a histogram of scores. If one kind is missing, every score is 0 and nothing is rejected.
    """
    held = crc_mod(F.col("body"), FOLDS) == 0
    table = keep(gram_counts(labelled.where(~held)))
    counts = model_counts(table, contexts)
    sizes = table.groupBy("kind").agg(F.count_distinct("context").alias("n"))
    whole = sizes.where(F.col("n") > contexts).isEmpty()
    rest = None if whole else table
    ratio = Ratio(counts, whole=whole)
    if ratio.models is None:
        return Ratio(counts, 0.0, -1.0), None
    bins = F.least(F.greatest(F.round(F.col("score") / WIDTH), F.lit(-(BINS // 2))), F.lit(BINS // 2)).cast("int")
    histogram = scored(labelled.where(held), ratio, rest).groupBy("kind", bins.alias("bin")).count().collect()
    tally = {k: np.zeros(BINS, np.int64) for k in ("allow", "block")}
    for r in histogram:
        tally[r["kind"]][r["bin"] + BINS // 2] += r["count"]
    at = (np.arange(BINS) - BINS // 2) * WIDTH
    return Ratio(counts, *logistic(tally["block"], tally["allow"], at), whole=whole), rest


def scored(rows, ratio, counts=None):
    """``rows`` (with a string column body) and their score and rejection probability. ``counts`` are all counts, where the
    ratio holds the commonest contexts only."""
    if counts is not None:
        return _scored_by_all(rows, ratio, counts)
    shared = rows.sparkSession.sparkContext.broadcast(ratio)
    names, place = [*rows.columns, "score", "rejection"], rows.columns.index("body")

    def run(batches):
        ratio = shared.value
        for batch in batches:
            s = np.array([ratio.score(t or "") for t in batch.column(place).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array(ratio.rejection(s))], names)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, score double, rejection double")


def _scored_by_all(rows, ratio, counts):
    """Scores of all contexts: what the ratio settles is summed where the URL is; the grams it does not settle meet their
    values by a join, once per distinct gram, and come back to their URLs."""
    shared = rows.sparkSession.sparkContext.broadcast(ratio)
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    names, place = [*numbered.columns, "_part", "_rest"], numbered.columns.index("body")

    def run(batches):
        ratio = shared.value
        for batch in batches:
            found = [ratio.parts(t or "") for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.float64()),
                                              pa.array([f[1] for f in found], pa.list_(pa.string()))], names)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema.fields)
    parts = keep(numbered.mapInArrow(run, f"{fields}, _part double, _rest array<string>"))
    grams = parts.select("_row", F.explode("_rest").alias("gram"))
    symbols = len({c for model in ratio.models for c in model.counts.get("", {})})
    values = keep(gram_values(grams, counts, symbols))
    # added in order of size, so that copies of a URL come to the same sum
    sums = grams.join(values, "gram").groupBy("_row").agg(
        F.aggregate(F.sort_array(F.collect_list("value")), F.lit(0.0), lambda a, v: a + v).alias("_sum"))
    score = (F.col("_part") + F.coalesce("_sum", F.lit(0.0))) / (F.length(F.coalesce("body", F.lit(""))) + 1)
    curve = F.greatest(F.least(F.lit(ratio.slope) * F.col("score") + F.lit(ratio.offset), F.lit(700.0)), F.lit(-700.0))
    return parts.join(sums, "_row", "left").withColumn("score", score).select(*rows.columns, "score", (1 / (1 + F.exp(-curve))).alias("rejection"))


def judged(pages, rules=RULES, page_id="page_id", url="url", contexts=CONTEXTS):
    """One row per row of ``pages``: page_id, host, path, rule, verdict, score, rejection.

    The verdict is the rule's where one fits, else block where the rejection probability is one half or more. Null
    URLs and URLs without ``://`` have no host and no path, so no rule fits; the models read what there is. Repeated
    rows come out as often as they went in. Without labelled URLs of both kinds the models accept all.
    """
    named = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), body(F.col(url)).alias("body"))
    ruled = named.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    ruled = ruled.select("page_id", "host", "path", F.col("fit.kind").alias("kind"), F.col("fit.rule").alias("rule"), "body")
    ratio, counts = fit(ruled.where("kind is not null").select("kind", "body"), contexts)
    verdict = F.coalesce("kind", F.when(F.col("rejection") >= 0.5, "block").otherwise("allow"))
    return scored(ruled, ratio, counts).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score", "rejection")


def drop_rejected(pages, rules=RULES, page_id="page_id", url="url"):
    """The ids of the pages whose verdict is allow."""
    return judged(pages, rules, page_id, url).where("verdict = 'allow'").select("page_id")
