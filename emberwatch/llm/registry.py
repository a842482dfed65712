"""Queries of the operators by name, over the tables of a folder."""

from fractions import Fraction
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

from emberwatch.llm import chat, decontaminate, divergence, jaccard_join, language, mixing, nearest, pieces, pii, sharding, suffix_dedup, toxicity, variants
from emberwatch.llm.common import table
from emberwatch.llm.oracles import ORACLES

__all__ = ["QUERIES", "ORACLES"]


def op1_decontaminate(spark, folder):
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_key")


def op2_nearest(spark, folder):
    return nearest.nearest(table(spark, folder, "embeddings"))


def op3_suffix_dedup(spark, folder):
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"), length=100).drop("spans", "kept")


def op4_chat(spark, folder):
    return chat.perspectives(table(spark, folder, "conversations"))


def op5_language(spark, folder):
    return language.identify(table(spark, folder, "pages"), table(spark, folder, "documents"))


def op6_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    machine = toxicity.fit(toxicity.labelled_texts(docs, table(spark, folder, "labels")))
    scored = toxicity.score(docs, machine)
    return scored.select("doc_id", toxicity.is_held_out("doc_id").alias("held_out"), "score", "predicted")


def op7_pii(spark, folder):
    return pii.digest(pii.find_personal_data(table(spark, folder, "documents")))


def op8_jaccard_join(spark, folder):
    docs = table(spark, folder, "documents")
    return jaccard_join.near_duplicate_components(docs, width=3, threshold=Fraction(9, 10))


def op9_mixing(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_sharding(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("size", sharding.byte_size(F.col("text")))
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")))).withColumn("sort_text", sharding.sort_key(F.col("text"), F.col("doc_id")))
    sharded = sharding.shard_keyed(docs.select("doc_id", "size", "text_crc32", "sort_text"), "sort_text", "size", shards=16)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_pieces(spark, folder):
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, model, keep_text=False, read_back=True)
    size = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    digest = {name: F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256") for name in ("ids", "decoded", "spans")}
    return coded.select("doc_id", size, *digest.values())


def op12_variants(spark, folder):
    found = variants.spelling_variants(table(spark, folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_divergence(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_nearest": op2_nearest,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_chat": op4_chat,
    "op5_language": op5_language,
    "op6_toxicity": op6_toxicity,
    "op7_pii": op7_pii,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_mixing": op9_mixing,
    "op10_sharding": op10_sharding,
    "op11_pieces": op11_pieces,
    "op12_variants": op12_variants,
    "op13_divergence": op13_divergence,
}
