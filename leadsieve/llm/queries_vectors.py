"""Registered queries: nearest neighbours."""

from leadsieve.llm import ann
from leadsieve.llm.registry import query, table


@query
def op7_ann(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 20 = 0"))
