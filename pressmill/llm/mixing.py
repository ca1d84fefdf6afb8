"""Mixing sources to target weights by thresholds on a document hash.

Every document has a fixed hash. Words are summed by source and by the hash's leading bits; the
running sum of a source shows in which bucket its budget ends. Only that boundary bucket is
summed again by the next bits, so a few passes, each over a tiny part of the one before, give a
threshold per source, and a filter on the hash takes the documents. Nothing is sorted by document.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pressmill.llm.common import free, keep, word_count

WEIGHTS, CAP = (5, 2, 1), 3
BITS, LEVELS = 16, 2  # 32 bits of the hash, 65,536 sums of a source at most
NEAR = 0.0005  # a source whose words are that near to its target is not filled further


def _sized(docs, doc_id, text, source):
    value = F.col(text).cast("string")
    return [F.col(source).cast("string").alias("source"), word_count(value).alias("size"),
            F.shiftrightunsigned(F.xxhash64(F.col(doc_id), value), 64 - BITS * LEVELS).alias("h")]


def targets(sizes, weights=WEIGHTS, cap=CAP):
    """(source, source_size, target) from (source, size): sources by code point, null last, weigh
    ``weights`` in turn and share all words; no target is above ``cap`` times its source's words,
    and what that frees goes to the others by weight. The windows see one row per source."""
    one = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    one = one.withColumn("w", weight).withColumn("most", F.col("source_size") * cap)
    # In the order in which rising shares reach their limits: the share per weight if all before are at theirs.
    fill = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    every = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))
    one = one.withColumn("share", left / F.sum("w").over(after))
    free_from = F.first(F.when(F.col("share") * F.col("w") <= F.col("most"), F.col("share")), True).over(every)
    target = F.least(F.col("most").cast("double"), free_from * F.col("w"))
    return one.select("source", "source_size", target.alias("target"))


def _bounds(rows, state):
    """``state`` (source, need, bound, ...) with the bound moved on so far that the documents of ``rows`` between the old and
    the new bound have just at most ``need`` words. need is what remains, n the words at the new bound (null where all
    documents are taken)."""
    state = state.withColumn("prefix", F.lit(None).cast("long"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        if level > 1:
            inside = state.where("prefix is not null").select(F.col("source").alias("s"), F.col("prefix").alias("p"))
            here = F.col("source").eqNullSafe(F.col("s")) & (F.shiftrightunsigned("h", shift + BITS) == F.col("p"))
            rows = keep(rows.join(inside, here).drop("s", "p"))
        sums = rows.groupBy(F.col("source").alias("s"), F.shiftrightunsigned("h", shift).alias("b")).agg(F.sum("size").alias("n"))
        sums = sums.withColumn("until", F.sum("n").over(Window.partitionBy("s").orderBy("b")))  # at most 2 ** BITS buckets
        # The first bucket that passes the need; a source without one takes all the buckets there are.
        ends = state.select("source", "need").join(sums, F.col("source").eqNullSafe(F.col("s")), "left")
        ends = ends.groupBy(F.col("source").alias("s")).agg(
            F.min(F.when(F.col("until") > F.col("need"), F.struct("b", "n", "until"))).alias("e"), F.sum("n").alias("all"))
        state = state.join(ends, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        spent = F.when(F.col("e").isNotNull(), F.col("e.until") - F.col("e.n")).otherwise(F.coalesce("all", F.lit(0)))
        state = keep(state.withColumn("need", F.col("need") - spent).withColumn("prefix", F.col("e.b")).withColumn("n", F.col("e.n")).drop("e", "all"))
    end = F.coalesce(F.col("prefix"), F.lit(1 << (BITS * LEVELS)))
    return state.withColumn("bound", end).drop("prefix")


def thresholds(sized, weights=WEIGHTS, cap=CAP):
    """(source, source_size, target, full, takes): a document is taken ``full`` times, and once more
    if some entry (start, bound, most) of ``takes`` has start <= hash < bound and size <= most.

    The document in which a budget ends may be longer than what is left of it. It is passed over, and further rounds fill
    the rest with documents behind it that are small enough, as long as some source is not near its target and something
    fits. In the end each source is compared with the mixes that take one of those documents instead of what was filled
    in behind it, and the nearest to the target holds.
    """
    goal = targets(sized, weights, cap).withColumn(
        "full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int"))
    goal = goal.withColumn("need", F.col("target") - F.col("full") * F.col("source_size"))
    none = F.expr("cast(array() as array<struct<start:bigint,bound:bigint,most:double>>)")
    state = goal.withColumns({"bound": F.lit(0).cast("long"), "takes": none, "over": F.lit(float("inf")), "instead": none})
    state, rows, most = keep(state), sized, F.lit(float("inf"))
    while True:
        state = _bounds(rows, state.withColumn("start", F.col("bound")).withColumn("most", most))
        beyond = F.col("n") - F.col("need")
        entry = lambda bound: F.concat("takes", F.array(F.struct("start", bound.alias("bound"), "most")))
        nearer = F.coalesce(beyond < F.col("over"), F.lit(False))
        state = keep(state.withColumns({
            "instead": F.when(nearer, entry(F.col("bound") + 1)).otherwise(F.col("instead")),
            "over": F.when(nearer, beyond).otherwise(F.col("over")), "takes": entry(F.col("bound"))}).drop("start", "most", "n"))
        far = F.col("need") > NEAR * F.col("target")
        at = state.where(far).select(
            F.col("source").alias("s"), F.col("bound").alias("b"), F.col("need").alias("m"))
        fits = F.col("source").eqNullSafe(F.col("s")) & (F.col("h") >= F.col("b")) & (F.col("size") > 0) & (F.col("size") <= F.col("m"))
        rows, most = keep(sized.join(at, fits).drop("s", "b", "m")), F.when(far, F.col("need")).otherwise(F.lit(-1.0))
        if rows.isEmpty():
            break
    takes = F.when(F.col("over") < F.col("need"), F.col("instead")).otherwise(F.col("takes"))
    return keep(state.withColumn("takes", takes).drop("need", "bound", "over", "instead"))


def _joined(rows, limits):
    names = [F.col(c).alias(f"_limit_{c}") for c in limits.columns]
    return rows.join(limits.select(*names), rows["source"].eqNullSafe(F.col("_limit_source")), "left")


COPIES = "cast(_limit_full + if(exists(_limit_takes, x -> h >= x.start and h < x.bound and size <= x.most), 1, 0) as int)"


def mixture(docs, weights=WEIGHTS, cap=CAP, doc_id="doc_id", text="text", source="source"):
    """One row per row of ``docs``: doc_id, size, source_size, target, copies, taken (size x copies).

    Size is the number of words; null and blank texts have none and are taken like their
    neighbours, which costs nothing. A null source is a source of its own. The hash covers id and text,
    so reruns agree and equal rows are taken alike. An empty table gives no rows.
    """
    sized = keep(docs.select(F.col(doc_id).alias("doc_id"), *_sized(docs, doc_id, text, source)))
    out = _joined(sized, thresholds(sized, weights, cap)).withColumn("copies", F.expr(COPIES))
    return out.select("doc_id", "size", F.col("_limit_source_size").alias("source_size"), F.col("_limit_target").alias("target"),
                      "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs, weights=WEIGHTS, cap=CAP, doc_id="doc_id", text="text", source="source"):
    """The rows of ``docs`` that the mix takes, with ``copies``, the number of times (a name that
    ``docs`` uses gets an underscore)."""
    sized = keep(docs.select(*_sized(docs, doc_id, text, source)))
    limits = thresholds(sized, weights, cap)
    all_columns, name = free(docs, "_row", "copies")
    rows = docs.select(F.struct("*").alias(all_columns), *_sized(docs, doc_id, text, source))
    taken = _joined(rows, limits).withColumn("_copies", F.expr(COPIES)).where("_copies > 0")
    return taken.select(f"{all_columns}.*", F.col("_copies").alias(name))
