"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Every text is encoded by a byte-level BPE (A) and by a piece model (B). Where tokens of both end at one
byte, a group ends; a token of A and one of B whose bytes overlap are linked. For every linked pair
of ids the corpus gets a postings list in chunks of documents: bit-sliced multiplicity planes, each
a compressed bitmap (sorted places, or a bit per document where that is smaller). The OR of a pair's planes
is the bitmap of the documents that hold it; its popcounts add up to the pair's count, the planes' weighted
popcounts to the number of links. The postings then carry the counts back to their documents.

No token of A crosses a blank between two other characters, and no piece of B holds a blank behind another
character, so that a long text can be taken in stretches that end at such blanks. Texts of characters whose class no
Unicode version has changed are encoded by a faster library from A's own vocabulary; tests compare the two.
"""

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from pressmill.llm.common import keep, text_bytes

CHUNK = 4096  # documents of one bitmap
POSTINGS = 1 << 21  # a chunk also ends with so many postings, which bounds a task's memory
DENSE = CHUNK // 8  # bytes of a bitmap with a bit per document
IDS = 1 << 20  # a pair is a * IDS + b
STRETCH = 1 << 18  # characters taken at once
_BLANK = re.compile(r"(?<=\S) (?=\S)")
# Latin, Cyrillic, punctuation, kana and the oldest CJK block, without separators that libraries disagree on.
_STEADY = re.compile("[\x00-\x1b\x20-\x84\x86-\u024f\u0400-\u045f\u2010-\u2027\u2030-\u205e\u20ac\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5]*")


# Fixed value: how byte-level BPE splits a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_alphabet():
    """Byte-level BPE writes each byte as a printable character: printable Latin-1 stands for itself, the other
    bytes take the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Two tokenizers (the first one's JSON, the second one's model bytes) and the groups of their tokens."""

    def __init__(self, json_text, model):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_text)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items() if all(c in alphabet for c in t)}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.fast = self._same_rules(json.loads(json_text), vocabulary) and tiktoken.Encoding(
            "a", pat_str=PATTERN, mergeable_ranks={t: i for t, i in ranks.items() if i < len(ranks) - self.extra}, special_tokens={})
        self.b_bytes, self.parted = [], True
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.parted &= "▁" not in piece.lstrip("▁")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        # an id with the mark behind it: 3 id + 0 within a group's side, + 1 at the end of A's, + 2 at the end of B's
        self.written = [f"{i}{mark}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for mark in ",|;"]
        self.a_size, self.b_size = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))

    def _same_rules(self, given, vocabulary):
        """Whether merges are in the order of the ids, as ranks need it, and words are split by the usual pattern."""
        self.extra = sum(t["content"] in vocabulary for t in given.get("added_tokens", ()))
        merges = [m if isinstance(m, list) else m.split(" ") for m in given["model"]["merges"]]
        ids = [vocabulary.get("".join(m)) for m in merges]
        before = given.get("pre_tokenizer") or {}
        return (ids == list(range(256, 256 + len(ids))) and len(ids) + 256 + self.extra == len(vocabulary)
                and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"))

    def first(self, text):
        if self.fast and _STEADY.fullmatch(text):
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def stretches(self, text):
        """The text in stretches whose blank between them both tokenizers begin a token with (and which is left out)."""
        start = 0
        while self.parted and len(text) - start > STRETCH:
            found = _BLANK.search(text, start + STRETCH)
            if not found:
                break
            yield text[start:found.start()]
            start = found.end()
        yield text[start:] if start else text

    def text(self, text):
        """(n_a, n_b, n_groups, groups' hash, pairs with repeats) or None (no tokens) for a whole text."""
        n_a = n_b = n_groups = 0
        digest, links = hashlib.sha256(), []
        if not text:
            return None
        for part in self.stretches(text):
            a, b = self.first(" " + part), self.b.encode(part, num_threads=1)
            want = b" " + part.encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
                return None
            a, b = np.array(a), np.array(b)
            a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            in_a, in_b = np.zeros(len(want) + 1, bool), np.zeros(len(want) + 1, bool)
            in_a[a_end] = in_b[b_end] = True
            a_last, b_last = in_b[a_end], in_a[b_end]
            ends = np.flatnonzero(in_a | in_b)  # each stretch between ends is the overlap of one pair
            links.append(a[np.searchsorted(a_end, ends)] * IDS + b[np.searchsorted(b_end, ends)])
            # every token's place when the groups are written one after the other, A before B
            a_until, b_until = np.flatnonzero(a_last) + 1, np.r_[0, np.flatnonzero(b_last) + 1]
            place = np.arange(len(a)) + b_until[np.cumsum(a_last) - a_last]
            written = np.empty(len(a) + len(b), np.int64)
            written[place] = 3 * a + a_last
            written[np.arange(len(b)) + a_until[np.cumsum(b_last) - b_last]] = 3 * b + 2 * b_last
            groups = "".join(map(self.written.__getitem__, written.tolist()))[:-1]
            digest.update(((";" if n_groups else "") + groups).encode())
            n_a, n_b, n_groups = n_a + len(a), n_b + len(b), n_groups + len(a_until)
        return n_a, n_b, n_groups, digest.hexdigest(), np.concatenate(links)


@lru_cache(maxsize=2)
def aligner(json_text, model):
    """One Aligner per process, whatever the number of its tasks."""
    return Aligner(json_text, model)


# --- bitmaps ---------------------------------------------------------------------------------------------

def pack(places):
    """Sorted places below CHUNK as a compressed bitmap."""
    if 2 * len(places) < DENSE:
        return places.astype("<u2").tobytes()
    bits = np.zeros(CHUNK, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(bitmap):
    """The places of a compressed bitmap."""
    if len(bitmap) < DENSE:
        return np.frombuffer(bitmap, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))


def union(bitmaps):
    """The OR of compressed bitmaps."""
    if len(bitmaps) == 1:
        return bitmaps[0]
    bits = np.zeros(CHUNK, np.uint8)
    for b in bitmaps:
        bits[unpack(b)] = 1
    return pack(np.flatnonzero(bits))


def popcount(bitmap):
    return len(bitmap) // 2 if len(bitmap) < DENSE else int(np.bitwise_count(np.frombuffer(bitmap, np.uint8)).sum())


def planes(pair, place, times):
    """(pair, [bitmap of every multiplicity bit]) from postings sorted by pair and place."""
    at = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.array([], np.int64)
    most = np.maximum.reduceat(times, at) if len(at) else times
    for key, a, b, top in zip(pair[at].tolist(), at.tolist(), [*at[1:].tolist(), len(pair)], most.tolist()):
        if top == 1:
            yield key, [pack(place[a:b])]
        else:
            yield key, [pack(place[a:b][(times[a:b] >> k) & 1 == 1]) for k in range(top.bit_length())]


# --- the operator ----------------------------------------------------------------------------------------

INDEX = "pair long, planes array<binary>, docs long, links long"


def _default(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded(docs, first=None, second=None, doc_id="doc_id", text="text"):
    """Two kinds of rows, from one pass over the texts. Documents (pair null): chunk, place in the chunk, doc_id,
    n_a, n_b, n_groups, n_links, groups_sha256. Postings: pair, chunk, planes, docs and links in the chunk.
    Vocabulary files are read on the driver and broadcast (a few MB, whatever the corpus)."""
    with open(first or _default("byte_bpe_50k.json"), encoding="utf-8") as f:
        json_text = f.read()
    with open(second or _default("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((json_text, model))
    kind = docs.schema[doc_id].dataType.simpleString()

    def decode(raw):
        try:
            return raw.decode()
        except UnicodeDecodeError:  # such bytes are never what a tokenizer gives back
            return ""

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        align, task, number = aligner(*shared.value), TaskContext.get().partitionId() << 32, 0
        pairs, places, times, held, place, id_type = [], [], [], 0, 0, None

        def postings():
            pair, where = np.concatenate(pairs), np.concatenate(places)
            count = np.concatenate(times)
            order = np.lexsort((where, pair))
            rows = list(planes(pair[order], where[order], count[order]))
            for at in range(0, len(rows), 50_000):
                some = rows[at:at + 50_000]
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, task + number)), pa.nulls(n, pa.int32()), pa.nulls(n, id_type),
                     *[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.string()),
                     pa.array([k for k, _ in some], pa.int64()), pa.array([p for _, p in some], pa.list_(pa.binary())),
                     pa.array([popcount(union(p)) for _, p in some], pa.int64()),
                     pa.array([sum(popcount(b) << k for k, b in enumerate(p)) for _, p in some], pa.int64())],
                    names)

        for batch in batches:
            rows, start, id_type = [], 0, batch.column(0).type

            def documents(upto):
                n = upto - start
                columns = list(zip(*rows)) or [()] * 7
                return pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), batch.column(0).slice(start, n),
                     *(pa.array(c, pa.int64()) for c in columns[2:6]), pa.array(columns[6], pa.string()),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.binary())), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)

            for i, raw in enumerate(text_bytes(batch.column(1))):
                found = align.text(decode(raw))
                if found is None:
                    rows.append((task + number, place, 0, 0, 0, 0, ""))
                else:
                    n_a, n_b, n_groups, digest, linked = found
                    key, count = np.unique(linked, return_counts=True)
                    rows.append((task + number, place, n_a, n_b, n_groups, len(linked), digest))
                    pairs.append(key)
                    places.append(np.full(len(key), place))
                    times.append(count)
                    held += len(key)
                place += 1
                if place == CHUNK or held >= POSTINGS:
                    yield documents(i + 1)
                    if held:
                        yield from postings()
                    rows, start = [], i + 1
                    pairs, places, times, held, place, number = [], [], [], 0, 0, number + 1
            if rows:
                yield documents(batch.num_rows)
        if held:
            yield from postings()

    names = ["chunk", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "planes", "docs", "links"]
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(
        run, f"chunk long, place int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, {INDEX}")


def pair_counts(postings):
    """(a, b, pair, docs, links, best) per pair of ids: documents that hold it, links, and whether no other pair
    of its A id is held by more documents."""
    counts = postings.groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    counts = keep(counts.withColumn("a", F.expr(f"pair div {IDS}")).withColumn("b", F.expr(f"pair % {IDS}")))
    tops = counts.groupBy("a").agg(F.max("docs").alias("top"))
    return counts.join(tops, "a").select("a", "b", "pair", "docs", "links", (F.col("docs") == F.col("top")).alias("best"))


def _returned(batches):
    """Adds up, per chunk and place, what the postings of the task's chunks carry."""
    sums = {}
    for batch in batches:
        for chunk, bitmaps, docs, best in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if chunk not in sums:
                sums[chunk] = np.zeros((2, CHUNK), np.int64)
            total = sums[chunk]
            for k, bitmap in enumerate(bitmaps):
                at = unpack(bitmap)
                total[0, at] += docs << k
                if best:
                    total[1, at] += 1 << k
    for chunk, total in sums.items():
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), chunk)), pa.array(at.astype(np.int32)),
                                          pa.array(total[0, at]), pa.array(total[1, at])], ["chunk", "place", "count_sum", "n_best"])


def aligned(docs, first=None, second=None, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts whose tokens do not give their bytes back, have no tokens: zeros and ''.
    Every row is a document of its own, repeated rows and rows with a null or repeated doc_id included.
    """
    rows = keep(encoded(docs, first, second, doc_id, text))
    documents = rows.where("pair is null")
    postings = rows.where("pair is not null").select("pair", "chunk", "planes", "docs", "links")
    counts = keep(pair_counts(postings)).select("pair", F.col("docs").alias("held"), "best")
    carried = postings.join(counts, "pair").select("chunk", "planes", "held", "best").repartition("chunk")
    scores = carried.mapInArrow(_returned, "chunk long, place int, count_sum long, n_best long")
    return documents.join(scores, ["chunk", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
        F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"), "groups_sha256")
