"""The queries of the operators over the test tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldstats.llm import archives, chat, decontam, licenses, lm, manifest, mixing, near, search, secrets, topk, toxicity, urls
from fieldstats.llm.components import stored
from fieldstats.session import scratch_path

#: The chain of categories; the last one decides.
CATEGORIES = ["low_quality", "toxic"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Python workers of a session on one machine are told where this package lies."""
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def category_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic"))


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scanned(docs, secrets.fit(secrets.labelled_strings(spark, docs)))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("found")).alias("spans"),
    )


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.jaccard_components(spark, table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, table(spark, sf_dir, "documents").select("doc_id", "source"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    archives.write_arc(table(spark, sf_dir, "pages"), arc)
    archives.convert(spark, arc, warc)
    back = archives.resolved(stored(archives.read_warc(spark, warc), "warc-heads"))  # the archives are parsed once
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scanned(docs, *licenses.document_frequencies(docs)).drop("text")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = toxicity.fit(spark, docs, category_labels(table(spark, sf_dir, "labels")), CATEGORIES)
    return toxicity.scored(spark, docs, models, CATEGORIES)


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(spark, vectors.where("vec_id % 100 = 0"), vectors)


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Messages of linear trees: each row answers the row before it; rows by turn, ties by role and text."""
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(tree.alias("tree"), "turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    text = F.lit("</s>[INST] ok [/INST]").alias("text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text)
    out = chat.formatted(conversation_messages(own.union(probe)))
    out = out.withColumn("turns", chat.turns_of(F.col("formatted")))
    # the loss text is read from the formatted output at the mask's spans (start, stop: code points, stop exclusive)
    under_mask = F.transform("mask", lambda m: F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), (m["stop"] - m["start"]).cast("int")))
    loss = F.concat_ws("", F.transform(under_mask, chat.unescaped))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), chat.unescaped(t["body"]), F.lit("\n"))))
    return out.select(
        F.when(F.col("tree") != "", F.col("tree").cast("long")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", manifest.UPPER, manifest.LOWER)
    changed = F.coalesce((F.crc32(F.col("doc_id").cast("string")) % 3) == 0, F.lit(False))
    tampered = F.when(changed, manifest.leaf_of(columns, text=lowered)).otherwise(manifest.leaf_of(columns))
    out = manifest.manifest(docs.select(*columns), columns, "doc_id", "lang", tampered)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce((F.crc32(F.col("doc_id").cast("string")) % 7) == 2, F.lit(False))
    out = lm.scored(spark, docs, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_near_duplicates,
        op3_decontamination,
        op4_mixing,
        op5_warc,
        op6_licenses,
        op7_toxicity,
        op8_urls,
        op9_topk,
        op10_chat,
        op11_manifest,
        op12_search,
        op13_lm_scores,
    )
}
#: DuckDB statements of whole results, where SQL can state them.
CHECKS: dict[str, str] = {
    # exact top 10 by integer inner product of floor(1024 x) components; ties to the smaller vec_id
    # payload size and digest of the UTF-8 html; of equal payloads of 100 bytes or more the smallest page_id is the response
    "op5_warc": """with d as (
  select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages
),
f as (select *, min(page_id) over (partition by payload_digest) as first_id from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id > first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id > first_id then first_id end as refers_to
from f""",
    "op9_topk": """with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)
),
q as (select distinct vec_id, v from v where vec_id % 100 = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from q join v c on c.vec_id <> q.vec_id and len(c.v) = len(q.v)
)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
) where rank <= 10""",
}
