"""Quality rules as a bitmask ledger.

Every text is measured once and every rule evaluated once: a row holds the measurements and one
bit per failed rule. Policies are versioned sets of rules, so a policy is a mask, a verdict is one
``bits & mask``, and ablations need no text: rows are counted by their bits (at most 2 ** rules
groups, summed map-side) and each policy is read off those counts.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.llm.common import text_bytes

# name -> condition of failure over the measurements. Positions are bits: only append.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_words": "n_words > 100000",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 5 * n_lines",
    "few_letters": "10 * n_letter_words < 6 * n_words",
}
BASE = ["few_words", "repeated_words"]
POLICIES = {"base": BASE, "v1": list(RULES), "v2": [r for r in RULES if r not in ("many_words", "short_words")]}
CURRENT = "v1"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words"]

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def repeated_words(words):
    """How many of the words lie in a 3-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    pair = np.unique(code[:-1] * len(ids) + code[1:], return_inverse=True)[1][:-1]
    _, where, count = np.unique(pair * len(ids) + code[2:], return_inverse=True, return_counts=True)
    twice, hit = count[where] > 1, np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= twice
    return int(hit.sum())


def measure(text):
    """The measurements of UTF-8 bytes, in the order of MEASURES."""
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.r_[True, space[:-1]]) if len(raw) else raw
    letters = int(np.logical_or.reduceat(_LETTER[raw], starts).sum()) if len(starts) else 0
    seen, lines, same = set(), text.split(b"\n") if text else [], 0
    for line in lines:
        if line.strip():
            same += line in seen
            seen.add(line)
    return (len(words), int((~space & ((raw & 0xC0) != 0x80)).sum()), int(_SYMBOL[raw].sum()), len(lines), same,
            repeated_words(words), letters)


def measured(docs, doc_id="doc_id", text="text"):
    """doc_id and the measurements (longs) of every row; null text measures as empty."""
    def run(batches):
        for batch in batches:
            rows = np.array([measure(t) for t in text_bytes(batch.column(1))], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows.T.copy())], ["doc_id", *MEASURES])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def mask(names, rules=RULES):
    order = list(rules)
    return sum(1 << order.index(n) for n in set(names))


def ledger(docs, doc_id="doc_id", text="text", rules=RULES):
    """The measurements with ``failed``, one bit per rule of ``rules`` that the text fails."""
    rows = measured(docs, doc_id, text)
    bits = [F.when(F.expr(rule), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, rule in enumerate(rules.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return rows.withColumn("failed", total)


def verdict(rows, policy=CURRENT, policies=POLICIES, rules=RULES):
    """``rows`` of a ledger with ``base_failed`` and ``kept`` under a policy."""
    fails = lambda names: F.col("failed").bitwiseAND(F.lit(mask(names, rules))) != 0
    return rows.withColumn("base_failed", fails(BASE)).withColumn("kept", ~fails([*BASE, *policies[policy]]))


def ablations(rows, policies=POLICIES, rules=RULES):
    """(policy, rule, failed, rejected, alone) from a ledger: texts failing the rule, texts the policy
    rejects, and texts that only this rule of the policy rejects, which dropping it would bring back.
    An empty ledger gives no rows."""
    by_bits = rows.groupBy("failed").agg(F.count("*").alias("n"))
    order = list(rules)
    cases = [F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(names, rules)).cast("long").alias("mask"),
                      F.lit(1 << order.index(r)).cast("long").alias("bit")) for p, names in policies.items() for r in names]
    each = by_bits.select("failed", "n", F.explode(F.array(*cases)).alias("c")).select("failed", "n", "c.*")
    count = lambda cond: F.coalesce(F.sum(F.when(F.expr(cond), F.col("n"))), F.lit(0)).alias
    return each.groupBy("policy", "rule").agg(count("failed & bit <> 0")("failed"), count("failed & mask <> 0")("rejected"),
                                              count("failed & mask = bit")("alone"))
