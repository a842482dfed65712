"""A corpus from raw documents: five stages, each a table made from the one before.

Toxic documents go, one of each group of near copies stays, documents that hold test items
go, sources are mixed to their weights, and what is left is put into shards.
"""

from fractions import Fraction

from emberwatch.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from emberwatch.llm.common import kept, table

SHARDS = 16


def drop_toxic(spark, docs, sf_dir):
    machine = toxicity.fit(toxicity.labelled_texts(docs, table(spark, sf_dir, "labels")))
    return toxicity.without_toxic(docs, machine)


def drop_near_duplicates(spark, docs, sf_dir):
    return jaccard_join.without_near_duplicates(docs, width=5, threshold=Fraction(4, 5))


def drop_contaminated(spark, docs, sf_dir):
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    return mixing.mixed_documents(docs)


def shard(spark, docs, sf_dir):
    return sharding.shard_rows(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: A fitted model decides in the first stage; SQL cannot express it.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
