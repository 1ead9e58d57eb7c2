"""Thin queries over the corpus operators: each reads whole tables and derives the columns that its contract fixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, clusters, codes, decontaminate, jaccard, langid, minhash, oracles, packing, pii, quality, secrets, toxicity, warc
from .common import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans: str, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the spans (those of kinds, if given), comma-joined."""
    of = F.filter(spans, lambda x: x["kind"].isin(*kinds)) if kinds else F.col(spans)
    return F.array_join(F.transform(of, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _n(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _span_digests(found: DataFrame, spans: str, kinds: tuple[str, ...]) -> DataFrame:
    base = kinds[:-1]
    return found.select("doc_id", *[_n(spans, k) for k in base], F.sha2(_joined(spans, base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return _span_digests(secrets.scan(docs, secrets.fit(docs)).select("doc_id", "secrets"), "secrets", secrets.KINDS)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = warc.plan_revisits(_table(spark, sf_dir, "pages"))
    records = warc.read_archives(warc.write_archives(plan, warc.new_folder(spark)))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def _crc(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(_crc(5) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", F.coalesce(_crc(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(pii.extract(_table(spark, sf_dir, "documents")), "entities", pii.KINDS)


def op6_packing(spark: SparkSession, sf_dir: str, size: int = 1024) -> DataFrame:
    import public_tokenizers

    cut = packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, vocabulary=public_tokenizers.path("byte_bpe_50k.json"), size=size)
    return packing.pack(cut, size).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    nodes = written(chat.linear_trees(rows.unionByName(more)), "messages")
    chosen = chat.best_paths(nodes).select("node", "depth")
    return chat.digests(chat.formatted_turns(nodes.join(chosen, "node")), "conv_id", ["depth"])


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(F.coalesce(_crc(4) != 2, F.lit(True))))
    return langid.predict(docs.drop("lang"), model).select("doc_id", F.coalesce(_crc(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(_table(spark, sf_dir, "embeddings"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(_table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_secrets, op2_warc, op3_decontaminate, op4_toxicity, op5_pii, op6_packing, op7_quality, op8_chat, op9_language, op10_jaccard, op11_minhash, op12_clusters, op13_codes)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
