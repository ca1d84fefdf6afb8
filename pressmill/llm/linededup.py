"""Line dedup by winnowing over line hashes.

A run of consecutive lines counts as a passage from WEIGHT characters on, every line counting for
at least LEAST of them. From each line, the shortest passage forward and the shortest one back are
windows; whatever passage two texts share, it contains windows of both kinds that cover it
line by line. Each window's smallest line hash is its fingerprint, which equal windows share.
Fingerprints found at one position only are dropped; at the others the match is extended to
both sides, that is, the whole windows around the position are compared, and every window that occurs
earlier (by doc_id, then position) is deleted. Overlapping windows join into the maximal runs.
"""

from pyspark.sql import functions as F

from pressmill.llm.common import free, keep

WEIGHT, LEAST = 64, 8


def _windows(weight, least):
    """Array of structs (i, k, f, p, w): first line, lines, fingerprint and its line, hash of the window."""
    most = -(-weight // least)
    # Lines until the weight is reached, from line i on; 0 if the text ends before.
    def reach(part):
        return (f"aggregate({part}, named_struct('n', 0, 'k', 0), (a, x) -> if(a.n >= {weight}, a, "
                f"named_struct('n', a.n + x, 'k', a.k + 1)), a -> if(a.n >= {weight}, a.k, 0))")
    ahead = f"transform(weights, (x, i) -> named_struct('i', i, 'k', {reach(f'slice(weights, i + 1, {most})')}))"
    behind = (f"transform(weights, (x, i) -> named_struct('i', i, 'k', "
              f"{reach(f'reverse(slice(weights, greatest(i - {most} + 2, 1), least(i + 1, {most})))')}))")
    behind = f"transform({behind}, r -> named_struct('i', r.i - r.k + 1, 'k', r.k))"
    both = f"array_distinct(filter(concat({ahead}, {behind}), r -> r.k > 0))"
    part = "slice(hashes, r.i + 1, r.k)"
    return F.expr(f"""transform({both}, r -> named_struct('i', r.i, 'k', r.k, 'f', array_min({part}),
      'p', r.i + array_position({part}, array_min({part})) - 1, 'w', xxhash64({part})))""")


def repeated_lines(docs, weight=WEIGHT, least=LEAST, doc_id="doc_id", text="text"):
    """(doc_id, text_hash, lines): for every text that repeats an earlier passage, the positions of the
    lines in it. Earlier means a smaller doc_id (null last), or a smaller position in the same text.

    Hot lines: fingerprints and windows are counted by partial aggregates and joined back by
    equality (from a written table, which lets adaptive execution split a hot key), so the places of one line
    stay spread over tasks and no pairs are made. Repeated rows
    (same id and text) are one document. Null and empty texts have no passages.
    """
    read = docs.select(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("t"))
    read = read.where("t is not null").select("last", "doc_id", F.xxhash64("t").alias("text_hash"), F.split("t", "\n", -1).alias("l"))
    read = read.select("last", "doc_id", "text_hash", F.expr("transform(l, x -> xxhash64(x))").alias("hashes"),
                       F.expr(f"transform(l, x -> greatest(length(x), {least}))").alias("weights"))
    rows = read.select("last", "doc_id", "text_hash", F.explode(_windows(weight, least)).alias("x"))
    rows = rows.select(F.struct("last", "doc_id", "text_hash", F.col("x.i").alias("i")).alias("at"), F.col("x.k").alias("k"),
                       F.col("x.f").alias("f"), F.struct("last", "doc_id", "text_hash", F.col("x.p").alias("p")).alias("place"), F.col("x.w").alias("w"))
    shared = keep(rows.groupBy("f").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a < b").select("f"))
    near = keep(rows.join(shared, "f").select("at", "k", "w"))
    first = keep(near.groupBy("w").agg(F.min("at").alias("first"), F.max("at").alias("b")).where("first < b").select("w", "first"))
    later = near.join(first, "w").where("at > first")
    return later.groupBy("at.doc_id", "at.text_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(
        F.expr("sequence(at.i, at.i + k - 1)"))))).alias("lines"))


def _cut(docs, weight, least, doc_id, text):
    """``docs`` with the repeated positions and the shortened text beside it; names of both."""
    own = free(docs, "_doc", "_hash", "_lines", "_kept")
    found = repeated_lines(docs, weight, least, doc_id, text).select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "text_hash", "lines"), own)])
    value = F.col(text).cast("string")
    out = docs.join(found, docs[doc_id].eqNullSafe(found[own[0]]) & (F.xxhash64(value) == found[own[1]]), "left")
    lines = f"split(`{text}`, '\\n', -1)"
    kept = F.expr(f"if(`{own[2]}` is null, `{text}`, array_join(transform("
                  f"array_except(sequence(0, size({lines}) - 1), `{own[2]}`), p -> get({lines}, p)), '\\n'))")
    return out.withColumn(own[3], kept), own[2], own[3]


def line_report(docs, weight=WEIGHT, least=LEAST, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc_id, n_lines, n_deleted, kept_chars, kept_sha256 (of the text left).
    A null text has no lines."""
    out, lines, kept = _cut(docs, weight, least, doc_id, text)
    return out.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.size(F.split(F.col(text).cast("string"), "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col(lines).isNotNull(), F.size(lines)), F.lit(0)).cast("long").alias("n_deleted"),
        F.coalesce(F.length(kept), F.lit(0)).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce(F.col(kept), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def drop_repeated_lines(docs, weight=WEIGHT, least=LEAST, doc_id="doc_id", text="text", n_chars="n_chars"):
    """``docs`` without the lines of passages that occur earlier. Every row stays, texts may become
    empty; the column ``n_chars``, where there is one, follows the changed texts."""
    out, lines, kept = _cut(docs, weight, least, doc_id, text)
    cols = []
    for c in docs.columns:
        if c == text:
            cols.append(F.col(kept).alias(c))
        elif c == n_chars:
            cols.append(F.when(F.col(lines).isNotNull(), F.length(kept)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)
