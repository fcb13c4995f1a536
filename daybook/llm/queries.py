"""The registered queries of the training-data operators, each over its whole table.

Each takes (spark, sf_dir). Models are fitted, and intermediate tables cut,
while a query is being built; the returned DataFrame runs the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import ann, html, langid, licenses, lm, mixing, packing, pivots, quality, ranked, simhash, urls, warc
from daybook.llm.common import id_bucket, scratch_folder, table


def site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.with_ledger(docs).select("doc_id", "ledger.*")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      quality.fails(F.col("bits"), "base").alias("base_failed"),
                      (~quality.fails(F.col("bits"), quality.POLICY)).alias("kept"), "bits")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy rejects, over all documents."""
    return quality.ablations(quality.with_ledger(table(spark, sf_dir, "documents").select("text")).select("ledger.bits"))


def kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(ann.clean(table(spark, sf_dir, "embeddings"))).select("query_id", "rank", "vec_id", "score")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packing.pack(pieces).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.fit(urls.labelled(spark))
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), model).select(
        "page_id", "host", "path", "rule", "verdict", "score")


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 5) == 1, F.lit(False))
    model = lm.fit(docs.where(~held_out))
    return lm.score(docs, model, keep={"held_out": held_out}).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    profiles = langid.fit(docs.where(~held_out))
    told = docs.select("doc_id", held_out.alias("held_out"), langid.predict(F.col("text"), profiles).alias("p"))
    return told.select("doc_id", "held_out", "p.lang_pred", "p.score")


def transaction_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages, scratch_folder(spark, "warc"))


def laesa_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.compress(table(spark, sf_dir, "embeddings"))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_site_style_tree": site_style_tree,
    "op2_quality_rules": quality_rules,
    "quality_ablation": quality_ablation,
    "op3_kmeans_tree_neighbours": kmeans_tree_neighbours,
    "op4_best_fit_packing": best_fit_packing,
    "op5_mixed_sources": mixed_sources,
    "op6_license_scan": license_scan,
    "op7_url_filter": url_filter,
    "op8_simhash_near_dedup": simhash_near_dedup,
    "op9_recurrent_lm": recurrent_lm,
    "op10_language_id": language_id,
    "op11_transaction_assembly": transaction_assembly,
    "op12_laesa_codes": laesa_codes,
    "op13_ranked_search": ranked_search,
}
