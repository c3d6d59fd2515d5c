"""The corpus pipeline: documents -> quality -> near-duplicates -> decontamination -> secrets -> SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and reads it back
for the next one, so that a lost executor costs no more than its stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaysight.llm import pieces, quality, secrets
from quaysight.llm.common import release, standing, written
from quaysight.llm.simhash import simhash_survivors
from quaysight.llm.winnow import decontaminate

#: None: no SQL expresses the models, fingerprints and merges; tests hold the stages against brute force.
ORACLE_SQL = None


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns of these names set aside under others, and how to name them again."""
    away = {n: f"{n} (input)" for n in names if n in docs.columns}
    return docs.withColumnsRenamed(away), {v: k for k, v in away.items()}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is below 0.3. The model learns from labelled rows outside the held-out fifth. Null and empty
    texts are scored as empty ones; repeated rows stay or go together; an empty table stays empty; all columns, one named score
    too, stay as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out("doc_id", 5, 0))
    rows, back = _aside(docs, "score")
    return quality.score(rows, quality.train(docs, labels)).where("score >= 0.3").drop("score").withColumnsRenamed(back).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of exact and near copies the document of the smallest id stays. Texts without words, null ones too, are copies of
    each other; rows of one id stay or go together, rows without id stay; all columns stay as they are."""
    return simhash_survivors(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share ten consecutive words with a benchmark item, or a whole shorter item. Null and empty texts have no
    words and stay; rows of one id go together; all columns stay as they are."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = written(found.where("contaminated").select("doc_id"), "contaminated")  # its size is known, so texts needn't be shuffled where few go
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and replaces each secret in their texts by <secret>. A column n_chars, if there is one, follows the text;
    null texts stay null; all other columns, ones named spans or redacted too, stay as they are."""
    rows, back = _aside(docs, "spans", "redacted")
    found = secrets.scan(rows, redacted=True)
    hit = F.size("spans") > 0
    out = found.withColumn("text", F.when(hit, F.col("redacted")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.drop("spans", "redacted").withColumnsRenamed(back).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids with their byte spans; `exact` says whether they decode to the text (a null one is empty). Of other columns doc_id, lang and
    source stay, as far as they are there."""
    import public_tokenizers

    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    found = pieces.encode(docs.select(*kept, "text"), public_tokenizers.path("piece_bpe_32k.model"), forget=True, remembered=50_000)
    return found.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids", "starts", "ends", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"))


STAGES = [("quality classifier", keep_quality), ("SimHash near-dedup", drop_near_duplicates), ("benchmark decontamination", drop_contaminated), ("secret scans", redact_secrets), ("SentencePiece encoding and decoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Once a stage is written, all tables that it has read or made on its way are removed."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), standing()
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i}")
            release(spark, since, docs)
    return docs
