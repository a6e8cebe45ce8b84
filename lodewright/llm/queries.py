"""The registered queries of these operators, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodewright.llm import (
    cascade,
    fingerprints,
    lexical,
    licenses,
    packing,
    pitman_yor,
    prefix_tree,
    repeats,
    sentence_pieces,
    toxicity,
    vantage,
    warc,
    whitening,
)
from lodewright.llm.tables import documents, table


def op1_warc(spark, folder):
    found = warc.round_trip(table(spark, folder, "pages"))
    return found.select(
        warc.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
        F.col("target_uri").alias("url"),
        F.col("offset").alias("archive_offset"),
        "error",
    )


def op2_suffix_array_dedup(spark, folder):
    return repeats.deduplicated(table(spark, folder, "documents"))


def op3_ngram_jaccard_join(spark, folder):
    return prefix_tree.join(table(spark, folder, "documents"))


def op4_sentence_pieces(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    decoded = sentence_pieces.round_trip(table(spark, folder, "documents"), path)
    return decoded.select("doc_id", "n_ids", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def op5_lm_scoring(spark, folder):
    return pitman_yor.score(table(spark, folder, "documents"))


def op6_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = toxicity.toxicity(docs, labels, ["doc_id"])
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_document_fingerprints(spark, folder):
    found = fingerprints.edited(documents(table(spark, folder, "documents")))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        fingerprints.distinct_shingles(F.col("sketch")).alias("shingles"),
    )


def op8_nearest_vectors(spark, folder):
    frame = table(spark, folder, "embeddings")
    return vantage.nearest(frame, frame.where("vec_id % 50 = 0"), k=5)


def op9_license_scan(spark, folder):
    found = licenses.scan(table(spark, folder, "documents"))
    return found.drop("licences")


def op10_best_fit_packing(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, folder, "documents"), path)


def op11_lexical_search(spark, folder):
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_url_filters(spark, folder):
    pages = table(spark, folder, "pages")
    rules = spark.createDataFrame(cascade.RULES, "host string, path string, verdict string")
    return cascade.judge(pages, rules, cascade.listed_domains(pages, cascade.WORDS))


def op13_embedding_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES = {name: value for name, value in list(globals().items()) if name.startswith("op")}
ORACLE = {
    "op9_license_scan": licenses.ORACLE,
    "op11_lexical_search": lexical.ORACLE,
    "op12_url_filters": cascade.ORACLE,
}
