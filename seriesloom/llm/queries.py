"""The registered queries of this package: thin wrappers that derive the digest columns from the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import chat, collocations, decontam, embdedup, langid, linededup, lm, merkle, oracles, packing, pii, simhash, subdedup, toxicity
from seriesloom.llm.common import id_remainder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 1024 tokens, with a digest of each piece's ids."""
    pieces = packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, and one more made of control strings."""
    own = [(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    more = spark.createDataFrame(own, "conv_id long, turn long, role string, text string")
    given = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(given.unionByName(more)))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learnt from three quarters of the ids."""
    docs, held_out = _read(spark, sf_dir, "documents"), id_remainder("doc_id", 4) == 2
    found = langid.identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages to remove as repeats, with their offsets."""
    return subdedup.repeated(_read(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return embdedup.group(_read(spark, sf_dir, "embeddings")).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash.group(_read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every text by the add-0.1 word model and by the subword lattice, learnt from nine tenths of the ids."""
    docs, held_out = _read(spark, sf_dir, "documents"), id_remainder("doc_id", 10) == 0
    scored = lm.score(docs, ~held_out, public_tokenizers.path("piece_bpe_32k.model"))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark window found in a document."""
    return decontam.find(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every text, learnt from the labels of four fifths of the ids."""
    docs, held_out = _read(spark, sf_dir, "documents"), id_remainder("doc_id", 5) == 0
    model = toxicity.train(docs, _read(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _equals(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def _listed(column: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: counts and digest of the base spans, and all spans."""
    found = pii.find(_read(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines of 20 code points or more that three documents hold, but in the largest id of them."""
    docs = _read(spark, sf_dir, "documents")
    cut = linededup.apply(docs, linededup.keep_bitmaps(docs, min_chars=20, min_docs=3))
    return cut.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two to four words."""
    return collocations.collocations(_read(spark, sf_dir, "documents"), min_count=30, max_words=4, cover=0.8, top=2000)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what the proof makes of a text whose case was changed."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    text = F.when(id_remainder("doc_id", 5) == 0, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    tampered = merkle.leaf([*(F.col(c) for c in columns[:-1]), text])
    found = merkle.proofs(_read(spark, sf_dir, "documents"), columns=columns, tampered=tampered)
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline at the top of the repository, from documents to packed sequences."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_packing,
        op2_chat,
        op3_language_id,
        op4_substring_dedup,
        op5_embedding_dedup,
        op6_simhash,
        op7_lattice_lm,
        op8_decontamination,
        op9_toxicity,
        op10_pii,
        op11_line_dedup,
        op12_collocations,
        op13_merkle_manifest,
        pipeline,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op11_line_dedup": oracles.OP11_LINE_DEDUP,
        "op12_collocations": oracles.OP12_COLLOCATIONS,
        "op13_merkle_manifest": oracles.OP13_MERKLE_MANIFEST,
    }
