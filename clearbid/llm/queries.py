"""The registered queries of the subpackage, thin over the operators, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbid.llm import chat, decontaminate, divergence, filter_audit, licenses, line_dedup, packing, quality, revisits, sharding, simhash, toxicity, two_fit
from clearbid.llm.common import materialize, read_table
from clearbid.llm.oracles import ORACLES  # noqa: F401

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
BOTH = "<|im_end|><|im_start|>assistant ok"   # text of the two turns of conversation -1


def packed(docs: DataFrame) -> DataFrame:
    """The packing of ``docs``: each piece's token ids, their crc32 and the piece's place."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).withColumn("ids_crc32", F.crc32("ids"))


def packed_digest(docs: DataFrame) -> DataFrame:
    """Digest of the packing of ``docs``: crc32 of each piece's ids beside its place."""
    return packed(docs).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def archive_records(pages: DataFrame) -> DataFrame:
    """A crawl log derived from pages: three captures of each, under varying spellings of its URL.

    The first capture is a full response.  The second is a 304 that confirms it
    or, for every seventh page, names another entity tag.  The third is a 304 by
    date alone, or a changed full response for every fifth page.
    """
    page, url = F.col("page_id"), F.col("url")
    day = lambda d: F.expr(f"timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, {d}, 0, 0, page_id % 86400)")
    tag = F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16)
    spelled = F.when(page % 2 == 0, F.regexp_replace(url, "^http://", "https://")).otherwise(F.concat(url, F.lit("#again")))

    def headers(**h):
        return F.create_map(*[x for k, v in h.items() for x in (F.lit(k.replace("_", "-")), v)])

    first = F.struct((page * 3).alias("record_id"), url.alias("url"), day(0).alias("ts"), F.lit("response").alias("kind"),
                     headers(etag=tag, last_modified=F.date_format(day(0), "yyyy-MM-dd"), content_type=F.lit("text/html"),
                             content_length=F.octet_length("html").cast("string")).alias("headers"), F.col("html").alias("payload"))
    second = F.struct((page * 3 + 1).alias("record_id"), spelled.alias("url"), day(3).alias("ts"), F.lit("revisit").alias("kind"),
                      headers(etag=F.when(page % 7 == 0, F.lit("other")).otherwise(F.concat(F.lit("W/"), tag)),
                              content_length=F.lit("0"), expires=F.lit("2024-02-01")).alias("headers"), F.lit(None).cast("string").alias("payload"))
    change = page % 5 == 0
    third = F.struct((page * 3 + 2).alias("record_id"), url.alias("url"), day(6).alias("ts"),
                     F.when(change, F.lit("response")).otherwise(F.lit("revisit")).alias("kind"),
                     F.map_filter(headers(last_modified=F.date_format(day(0), "yyyy-MM-dd"), date=F.date_format(day(6), "yyyy-MM-dd"),
                                          etag=F.when(change, F.lit("changed"))), lambda k, v: v.isNotNull()).alias("headers"),
                     F.when(change, F.concat(F.col("html"), F.lit("<!-- changed -->"))).alias("payload"))
    return pages.select(F.explode(F.array(first, second, third)).alias("r")).select("r.*")


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(archive_records(read_table(spark, sf_dir, "pages")))
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return found.select("record_id", "canonical_url", "ref_record_id", "outcome", F.array_join(pairs, ";").alias("headers"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "n_dropped", "text")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def conversation_log(rows: DataFrame) -> DataFrame:
    """Event log whose final messages are ``rows`` (conv_id, turn, role, text), one message per row.

    Every text is streamed in two deltas; some messages are first drafted and
    regenerated, others edited in the middle.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    one = told.select("conv_id", F.posexplode("rows").alias("message", "r")).select("conv_id", "message", "r.role", "r.text")
    half = (F.char_length("text") / 2).cast("int")
    left, right = F.substring(F.col("text"), F.lit(1), half), F.substring(F.col("text"), half + 1, F.char_length("text"))
    event = lambda kind, text, when=None: (F.struct(F.lit(kind).alias("kind"), text.alias("text")) if when is None
                                           else F.when(when, F.struct(F.lit(kind).alias("kind"), text.alias("text"))))
    again, edited = F.col("message") % 3 == 1, F.col("message") % 5 == 2
    none = F.lit(None).cast("string")
    events = F.array_compact(F.array(event("start", none), event("delta", F.concat(F.lit("draft "), left), again),
                                     event("regenerate", none, again), event("delta", F.lit("typo"), edited),
                                     event("edit", left, edited), event("delta", left, ~edited), event("delta", right)))
    out = one.select("conv_id", "message", "role", F.posexplode(events).alias("n", "e"))
    return out.select("conv_id", (F.col("message") * 8 + F.col("n")).cast("long").alias("seq"), "message", "e.kind", "role", "e.text")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", BOTH), (-1, 1, "assistant", BOTH)], "conv_id long, turn long, role string, text string")
    done = chat.format_log(conversation_log(rows.union(extra)))
    read = done.select("conv_id", "formatted", chat.read_turns().alias("turns"), chat.read_loss().alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_hits(docs, read_table(spark, sf_dir, "benchmark"))
    items = F.col("hits.items")
    return found.select("doc_id", "hits.n_words", "hits.n_hit", F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = two_fit.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))
    return found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op1_packing, op2_quality, op3_revisits, op4_line_dedup, op5_licenses, op6_chat,
                                   op7_decontaminate, op8_simhash, op9_toxicity, op10_sharding, op11_divergence, op12_filter_audit, op13_two_fit)}
