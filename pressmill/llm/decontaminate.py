"""Benchmark decontamination: which words of a document lie in a word window of a benchmark item.

A window of L words holds, wherever it lies, one gram of g = (L + 1) // 2 words that starts at a
multiple of g. So a document is probed at every g-th word only; a gram found in the hash set of
benchmark grams names at most L - g + 1 windows around it, and those are compared word by word.
"""

from pyspark.sql import functions as F

from pressmill.llm.common import free, keep, lower_ascii

WINDOW = 13
WORDS = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
BROADCAST_BYTES = 64 << 20  # windows and their items up to this size are broadcast; beyond it only grams meet first


def words(col):
    """Words of a text, A-Z lower-cased; null text has none."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(col), F.lit(WORDS), F.lit(1)), F.expr("cast(array() as array<string>)"))


def benchmark_windows(benchmark, window=WINDOW):
    """One row per distinct window: length n, hash h, words w and the items that hold it, as sorted strings."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text").cast("string")).alias("t"))
    items = items.where("size(t) > 0").withColumn("n", F.least(F.size("t"), F.lit(window)))
    rows = items.select("item", "n", F.explode(F.expr("transform(sequence(1, size(t) - n + 1), i -> slice(t, i, n))")).alias("w"))
    rows = rows.groupBy("n", "w").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return keep(rows.select("n", F.xxhash64("w", "n").alias("h"), "w", "items"))


def _plan(benchmark, window):
    """(windows, grams, lengths, small): the hash sets, the window lengths in use, and whether the windows' measured size
    is below the bound of a broadcast (grams are at most seven longs a window)."""
    found = benchmark_windows(benchmark, window)
    size = F.sum(F.expr("octet_length(array_join(w, ' ')) + octet_length(array_join(items, ' ')) + 32 * (size(w) + size(items))"))
    sizes = {r["n"]: r["size"] for r in found.groupBy("n").agg(size.alias("size")).collect()}  # at most ``window`` lengths
    grams = found.select(F.explode(F.expr(
        "transform(sequence(0, (n + 1) div 2 - 1), o -> xxhash64(slice(w, cast(o + 1 as int), cast((n + 1) div 2 as int)), n))"
    )).alias("g")).distinct()
    return found, grams, sorted(sizes), sum(sizes.values()) <= BROADCAST_BYTES


def _probes(lengths):
    """The grams to look up, as structs (n, p, g), and one for the document itself (n = 0)."""
    parts = ["array(named_struct('n', 0, 'p', 0, 'g', 0L))"]
    for n in lengths:
        g = (n + 1) // 2
        parts.append(f"if(n_words >= {n}, transform(sequence(0, n_words - {g}, {g}), p -> named_struct("
                     f"'n', {n}, 'p', p, 'g', xxhash64(slice(t, p + 1, {g}), {n}))), cast(array() as array<struct<n:int,p:int,g:bigint>>))")
    return F.expr(f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0])


# The windows that hold the gram found at word p: starts p - (n - g) to p, inside the document.
AROUND = """if(n = 0, array(named_struct('s', 0, 'h', 0L, 'w', cast(array() as array<string>))),
  transform(sequence(greatest(p - n div 2, 0), least(p, n_words - n)), s -> named_struct(
    's', cast(s as int), 'h', xxhash64(slice(t, cast(s + 1 as int), n), n), 'w', slice(t, cast(s + 1 as int), n))))"""


def contamination(docs, benchmark, window=WINDOW, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit, n_items, items (sorted), hit_words
    (positions), contaminated (at least a twentieth of the words hit).

    With a benchmark that can be broadcast, one pass over the texts: every document sends one row for itself through the same
    joins, so nothing is read or joined twice, and only hits meet per document. With a larger one the words are written
    once, (row, length, place, gram) alone is shuffled to the grams, and what hits comes back to its document. Null, empty and wordless texts
    have no words and no hits. Items without words are ignored; items with a null id hit but
    are not listed. Repeated rows come out once each. An empty benchmark gives no hits.
    """
    windows, grams, lengths, small = _plan(benchmark, window)
    hint = F.broadcast if small else (lambda df: df)
    spark = docs.sparkSession
    own = "cast(0 as bigint)"
    grams = grams.unionAll(spark.range(1).select(F.expr(own).alias("g")))
    windows = windows.select("n", "h", "w", "items").unionAll(spark.range(1).selectExpr(
        "0 as n", "0L as h", "cast(array() as array<string>) as w", "cast(array() as array<string>) as items"))
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("t0")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("t0").alias("text_hash"), words(F.col("t0")).alias("t"))
    read = read.withColumn("n_words", F.size("t"))
    if small:
        hits = read.select("row", "doc_id", "text_hash", "t", "n_words", F.explode(_probes(lengths)).alias("x"))
        hits = hits.select("row", "doc_id", "text_hash", "t", "n_words", "x.n", "x.p", "x.g").join(hint(grams), "g", "left_semi")
    else:
        read = keep(read)  # the row numbers hold from here on
        probes = read.select("row", F.explode(_probes(lengths)).alias("x")).where("x.n > 0").select("row", "x.n", "x.p", "x.g")
        found = probes.join(grams, "g", "left_semi").groupBy("row").agg(F.collect_list(F.struct("n", "p")).alias("xs"))
        itself = "array(named_struct('n', 0, 'p', 0))"
        hits = read.join(found, "row", "left").select(
            "row", "doc_id", "text_hash", "t", "n_words", F.explode(F.expr(f"if(xs is null, {itself}, concat({itself}, xs))")).alias("x"))
        hits = hits.select("row", "doc_id", "text_hash", "t", "n_words", "x.n", "x.p")
    hits = hits.where("n = 0 or least(p, n_words - n) >= greatest(p - n div 2, 0)")
    around = hits.select("row", "doc_id", "text_hash", "n_words", "n", F.explode(F.expr(AROUND)).alias("y"))
    around = around.select("row", "doc_id", "text_hash", "n_words", "n", "y.s", "y.h", "y.w")
    real = around.join(hint(windows), ["n", "h", "w"])
    per = real.groupBy("row", "doc_id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.expr("if(n > 0, named_struct('s', s, 'e', s + n), null)"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    per = per.withColumn("hit_words", F.expr(
        "array_sort(array_distinct(flatten(transform(runs, r -> sequence(r.s, r.e - 1)))))"))
    per = per.withColumn("n_hit", F.size("hit_words").cast("long"))
    return per.select("doc_id", "text_hash", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "hit_words",
                      F.expr("n_hit > 0 and 20 * n_hit >= n_words").alias("contaminated"))


def _matched(docs, found, doc_id, text, how, *names):
    """``docs`` joined to rows of ``found`` on document and text, nulls included."""
    own = free(docs, "_doc", "_hash", *[f"_{n}" for n in names])
    found = found.select(F.col("doc_id").alias(own[0]), F.col("text_hash").alias(own[1]), *[F.col(n).alias(o) for n, o in zip(names, own[2:])])
    found = found.dropDuplicates(own[:2])
    on = docs[doc_id].eqNullSafe(found[own[0]]) & (F.xxhash64(docs[text].cast("string")) == found[own[1]])
    return docs.join(found, on, how), own


def drop_contaminated(docs, benchmark, window=WINDOW, doc_id="doc_id", text="text"):
    """``docs`` without the contaminated documents; columns and other rows as they are."""
    bad = contamination(docs, benchmark, window, doc_id, text).where("contaminated")
    return _matched(docs, bad, doc_id, text, "left_anti")[0]


def remove_spans(docs, benchmark, window=WINDOW, doc_id="doc_id", text="text"):
    """``docs`` with every hit word, and the separators after it, taken out of the text; texts
    without hits, null included, stay as they are."""
    hit = contamination(docs, benchmark, window, doc_id, text).where("n_hit > 0")
    joined, own = _matched(docs, hit, doc_id, text, "left", "hit_words")
    gone, mark = own[2], free(joined, "_cut")[0]
    any_case = r"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    full = f"regexp_extract_all(`{text}`, r'({any_case}[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*)', 1)".replace("\\\\", "\\")
    lead = r"regexp_extract(`%s`, r'^([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)', 1)" % text
    kept = f"transform(array_except(sequence(0, size({full}) - 1), `{gone}`), p -> get({full}, p))"
    out = joined.withColumn(mark, F.expr(f"if(`{gone}` is null, `{text}`, concat({lead}, array_join({kept}, '')))"))
    return out.select(*[F.col(mark).alias(c) if c == text else F.col(c) for c in docs.columns])
