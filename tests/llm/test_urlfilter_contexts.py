"""Contexts beyond those that are broadcast count like the others."""

from test_urlfilter import SCHEMA, urls

from pressmill.llm import urlfilter


def test_few_broadcast_contexts_give_the_scores_of_all(spark):
    rows = spark.createDataFrame([(i, u, None, 1, "b", "k", 2) for i, u in enumerate(urls())], SCHEMA).repartition(3)
    whole = {r["page_id"]: r for r in urlfilter.judged(rows).collect()}
    for contexts in (1, 40):
        got = {r["page_id"]: r for r in urlfilter.judged(rows, contexts=contexts).collect()}
        assert got.keys() == whole.keys()
        for i, r in got.items():
            assert r[:5] == whole[i][:5]
            assert abs(r["score"] - whole[i]["score"]) < 1e-9 and abs(r["rejection"] - whole[i]["rejection"]) < 1e-6
