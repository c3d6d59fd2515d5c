"""The registered queries of the corpus operators, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, licenses, manifest, periodic, pieces, quality, secrets, toxicity, urls
from .passages import repeated
from .simhash import simhash_components
from .vectors import near_vectors
from .winnow import decontaminate


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op2_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """score: 1 if an expression or a base phrase names a licence, 0.7 for other notices, 0 without any."""
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("matches", lambda m: m["base"])
    named = lambda of: F.array_join(F.array_sort(F.array_distinct(of)), ",")
    labels = F.concat(F.col("matches.label"), F.flatten(F.col("expressions.licenses")))
    score = F.when((F.size(base) > 0) | (F.size("expressions") > 0), 1.0).when(F.size("matches") > 0, 0.7).otherwise(0.0)
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base["first"]).alias("first_word"), F.array_max(base["first"]).alias("last_word"),
        named(base["label"]).alias("base_labels"), named(labels).alias("labels"), score.alias("score"),
    )


def op3_zstd_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op4_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_levenshtein_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), quality.held_out("doc_id", 3, 1)
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~out))
    return toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op7_additive_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), quality.held_out("doc_id", 5, 0)
    model = quality.train(docs, table(spark, sf_dir, "labels").where(~out))
    return quality.score(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op8_markov_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op9_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All paragraphs and runs are compared; stretches of fewer than 24 repeated words aren't named, which leaves out documents that only
    have headings and stock lines in common with others."""
    return repeated(table(spark, sf_dir, "documents"), shortest=24)


def op10_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    """n_bytes is the end of the last span: the bytes of the whole text."""
    if model_file is None:
        import public_tokenizers

        model_file = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model_file)
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), F.coalesce(F.element_at("ends", -1), F.lit(0)).cast("long").alias("n_bytes"))


def op11_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_words: the words of the text; the sums are over every run and every kept word."""
    found = periodic.runs(periodic.planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("best")
    return found.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), quality.held_out("doc_id", 4, 2)
    model = language.train(docs.where(~out))
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op13_octopus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = manifest.proofs(manifest.manifest(docs, claim=manifest.tampered(docs)))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_simhash": op1_simhash, "op2_aho_corasick": op2_aho_corasick, "op3_zstd_novelty": op3_zstd_novelty, "op4_projection_forest": op4_projection_forest, "op5_winnowing": op5_winnowing, "op6_levenshtein_trie": op6_levenshtein_trie, "op7_additive_model": op7_additive_model, "op8_markov_ratio": op8_markov_ratio, "op9_paragraph_minhash": op9_paragraph_minhash, "op10_sentencepiece": op10_sentencepiece, "op11_difference_cover": op11_difference_cover, "op12_naive_bayes": op12_naive_bayes, "op13_octopus": op13_octopus}


#: CRC-32 of a number's digits, bit by bit.
_CRC32 = """xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)),
    lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::bigint[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295), 4294967295)"""


def _leaf_sql(text: str) -> str:
    one = lambda v: f"coalesce(cast(strlen(cast({v} as varchar)) as varchar) || ':' || cast({v} as varchar), '-')"
    return "sha256(" + " || ".join(map(one, ("doc_id", "source", "lang", "n_chars", text))) + ")"


#: The trees of all groups, and that of the subroots under the group '/', level by level; what stands before and behind a node in its run.
_OP13 = f"""
with recursive docs as (
  select coalesce('=' || lang, '') as g, doc_id, {_leaf_sql("text")} as leaf,
    case when {_CRC32} % 3 = 0 then {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as claim
  from documents),
leaves as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i, row_number() over (order by g, doc_id nulls first, leaf) as row from docs),
low(g, k, i, h, c) as (
  select g, 0, i, leaf, count(*) over (partition by g) from leaves
  union all
  select g, k + 1, i // 8, sha256(string_agg(h, '' order by i)), (c + 7) // 8 from low where c > 1 group by g, k, i // 8, c),
tops as (select g, h, row_number() over (order by g) - 1 as i from low where c = 1),
high(g, k, i, h, c) as (
  select '/', 0, i, h, count(*) over () from tops
  union all
  select g, k + 1, i // 8, sha256(string_agg(h, '' order by i)), (c + 7) // 8 from high where c > 1 group by g, k, i // 8, c),
nodes as (select * from low union all select * from high),
beside as (
  select a.g, a.k, a.i, coalesce(string_agg(b.h, '' order by b.i) filter (b.i < a.i), '') as before, coalesce(string_agg(b.h, '' order by b.i) filter (b.i > a.i), '') as behind
  from nodes a join nodes b on a.g = b.g and a.k = b.k and a.i // 8 = b.i // 8 where a.c > 1 group by a.g, a.k, a.i),
way(row, g, k, i, siblings, node, up, place) as (
  select l.row, l.g, 0, l.i, '', coalesce(l.claim, l.leaf), 0, t.i from leaves l join tops t using (g)
  union all
  select w.row, case when n.c > 1 then w.g else '/' end, case when n.c > 1 then w.k + 1 else 0 end, case when n.c > 1 then w.i // 8 else w.place end,
    case when n.c > 1 then w.siblings || b.before || b.behind else w.siblings end, case when n.c > 1 then sha256(b.before || w.node || b.behind) else w.node end,
    case when n.c > 1 then w.up else 1 end, w.place
  from way w join nodes n on n.g = w.g and n.k = w.k and n.i = w.i left join beside b on b.g = w.g and b.k = w.k and b.i = w.i where n.c > 1 or w.up = 0),
ends as (select w.* from way w join high n on n.k = w.k and n.i = w.i and n.c = 1 where w.up = 1 and w.g = '/')
select l.doc_id, l.leaf, t.h as subroot, r.h as root, sha256(e.siblings) as proof_sha256, e.node as folded_root, e.node = r.h as verified
from leaves l join tops t using (g) join ends e using (row) cross join (select h from high where c = 1) r
"""


def oracle_sql() -> dict[str, str]:
    return {"op13_octopus": _OP13}
