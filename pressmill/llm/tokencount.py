"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the pieces that end at each character; per character the search
carries the best score and the number of pieces on the best path, no back pointers. Ties go as
in the tokenizer: of equal scores the one whose last piece starts first stays. A character that no
piece ends at is unknown and costs the tokenizer's penalty; with byte fallback it counts its UTF-8 bytes.

Blanks become marks, and no piece holds a mark behind another character, so a text falls apart before
each run of marks, and every part is searched once per task (a bounded memo). Scores add in
double precision, part by part; the tokenizer adds them in single precision along the text.
"""

import re

import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.llm.common import free
from pressmill.llm.vocabulary import MARK, load

MEMO = 200_000  # parts remembered by a task; a full memo is emptied
_PARTS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+")


class Counter:
    def __init__(self, vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in zip(vocabulary.pieces, vocabulary.scores):
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown, self.bytes = vocabulary.unknown, vocabulary.byte_fallback
        self.memo = {}

    def part(self, text):
        """(pieces, score) of the best segmentation."""
        n, low = len(text), float("-inf")
        score, count = [0.0] + [low] * n, [0] * (n + 1)
        done = 0  # positions up to here are final

        def fill(upto):
            """Characters at which no piece ends continue with an unknown one, as far as ``upto``."""
            nonlocal done
            while done < upto:
                done += 1
                alone = score[done - 1] + self.unknown
                # A single character that is a piece itself is never unknown.
                if done not in single and (score[done] == low or alone > score[done]):
                    score[done] = alone
                    count[done] = count[done - 1] + (len(text[done - 1].encode()) if self.bytes else 1)

        single = set()
        for last, (length, value) in self.automaton.iter(text):  # by end, longest first
            end = last + 1
            fill(last)
            if length == 1:
                single.add(end)
            candidate = score[end - length] + value
            if candidate > score[end]:
                score[end], count[end] = candidate, count[end - length] + 1
        fill(n)
        return count[n], score[n]

    def text(self, text):
        """(tokens, score) of a whole text; a leading blank is implied, as the tokenizer adds it."""
        tokens, total, memo = 0, 0.0, self.memo
        if not text:
            return 0, 0.0
        for part in _PARTS.findall(MARK + text.replace(" ", MARK)):
            found = memo.get(part)
            if found is None:
                if len(memo) >= MEMO:
                    memo.clear()
                found = self.part(part)
                if len(part) <= 64:
                    memo[part] = found
            tokens += found[0]
            total += found[1]
        return tokens, total


def counted(docs, vocabulary=None, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc_id, n_tokens, score. Null and empty texts have no tokens.

    The vocabulary (a file's pieces, by default the one that is installed) is bounded and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or load())

    def run(batches):
        count = Counter(shared.value)
        for batch in batches:
            rows = [count.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.float64())], ["doc_id", "n_tokens", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(run, f"doc_id {kind}, n_tokens long, score double")


def with_counts(docs, vocabulary=None, text="text"):
    """``docs`` with a column n_tokens (underscores added where the name is taken)."""
    key, name = free(docs, "_row", "n_tokens")
    packed = docs.select(F.struct("*").alias(key), F.col(text).cast("string").alias("text"))
    return counted(packed, vocabulary, key, "text").select("doc_id.*", F.col("n_tokens").alias(name))
