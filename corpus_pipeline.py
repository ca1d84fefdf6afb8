"""The training-data pipeline: named stages, each one operator, written and read again between stages.

Every stage takes (spark, docs, sf_dir) and returns documents: toxic ones go, lines of passages that occur
earlier go, one document of each group of close fingerprints stays, contaminated documents go, and the last
stage mixes what is left to the source weights, with the column ``copies``.
"""

from pressmill.llm import decontaminate, linededup, mixing, simhash, toxicity
from pressmill.llm.common import keep


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark, docs, sf_dir):
    index = toxicity.fit(docs, _table(spark, sf_dir, "labels"), train=lambda doc_id: ~toxicity.held_out(doc_id))
    return toxicity.drop_toxic(docs, index)


def dedupe_lines(spark, docs, sf_dir):
    return linededup.drop_repeated_lines(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    return simhash.drop_near_duplicates(docs, shingle=3)  # and three bits, as the operator's contract has it


def decontaminate_documents(spark, docs, sf_dir):
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedupe_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_documents),
    ("mixing", mix_sources),
]

# A trained score, hashes and iterated components are beyond SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the whole of documents; no rows in, no rows out."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
