"""Each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.llm import arc_to_warc, decontaminate, line_winnow, merkle, mixing, pairwise_quality, pii_semicrf, ring_shards, simhash_trie, spelling, token_cache, toxicity, walsh_codes
from acreline.llm.common import table
from acreline.llm.registry import ORACLES, QUERIES, query
from acreline.session import fresh_dir

__all__ = ["ORACLES", "QUERIES"]


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), simhash_trie.hex_fingerprint(F.col("simhash")).alias("fingerprint"), "component_id")


@query("op2_line_winnowing")
def op2_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is deleted where (code points, end exclusive), and the documents that have it first."""
    found = line_winnow.find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ranges = F.transform("deleted", lambda x: F.concat_ws(":", x["start"].cast("string"), x["stop"].cast("string")))
    return found.select(F.col("id").alias("doc_id"), "n_units", "n_deleted", F.array_join(ranges, ",").alias("deleted"), "sources")


@query("op3_pii_semicrf")
def op3_pii_semicrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_semicrf.find_pii(docs, pii_semicrf.fit_pii(docs)).select("doc_id", "pii.*")


@query("op4_ring_shards")
def op4_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: the capacities of the ring are exact quotas, so counts differ by one at most."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    placed = ring_shards.assign_shards(docs, shards=40, key="doc_id", ties=("text_crc32", "size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "home_shard")


@query("op5_arc_to_warc")
def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC files of both versions, converted to WARC files, which are read back."""
    arc, warc = fresh_dir(spark, "arc"), fresh_dir(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    arc_to_warc.write_arc(pages, arc, version=F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(2)) + 1)
    arc_to_warc.convert(spark, arc, warc)
    back = arc_to_warc.read_warc(spark, warc).filter("type IS NULL OR type <> 'warcinfo'")  # one a file, no page
    return back.select(
        F.col("key").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to", "record_id", "error"
    )


# The tables have no domain column; sources are dealt to four domains by their number.
DOMAINS = ("web", "news", "books", "forum")
WEIGHTS = {
    "domain": {"web": 4, "news": 3, "books": 2, "forum": 1},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
}
MIX = {"share": "1", "max_epochs": 2, "seed": 6}


def domain(source: Column) -> Column:
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    named = F.element_at(F.array(*map(F.lit, DOMAINS)), (number.cast("int") % len(DOMAINS) + 1).cast("int"))
    return F.coalesce(F.when(number != "", named), F.lit("other"))


_NUMBER = "regexp_extract(source, '([0-9]{1,9})$', 1)"
DOMAIN_SQL = (
    f"coalesce(CASE WHEN {_NUMBER} <> '' THEN CASE CAST({_NUMBER} AS INTEGER) % 4 "
    + " ".join(f"WHEN {k} THEN '{d}'" for k, d in enumerate(DOMAINS))
    + " END END, 'other')"
)


@query("op6_mix_to_weights", mixing.mix_sql(DOMAIN_SQL, WEIGHTS, **MIX))
def op6_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.select_mix(docs.withColumn("domain", domain(F.col("source"))), weights=WEIGHTS, **MIX)
    tokens = mixing.token_count(F.col("text"))
    return mixed.select("doc_id", "mix.domain", "mix.lang", "mix.source", "mix.epoch", tokens.alias("n_tokens"), mixing.mix_tokens(F.col("text")).alias("n_used"))


@query("op7_merkle_fingerprints", merkle.merkle_sql())
def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    grow = lambda rows: merkle.fingerprints(rows, F.col("text"), "tree")
    docs = merkle.with_next(docs, "doc_id", ["text", "tree"], tie="text", prepare=grow)
    docs = docs.withColumn("edited", merkle.edited(F.col("text"), F.col("next.text")))
    docs = merkle.fingerprints(docs, F.col("edited"), "edited_tree")
    return docs.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        merkle.as_text("tree").alias("fingerprint"),
        merkle.as_text("edited_tree").alias("edited_fingerprint"),
        merkle.likeness("tree", "edited_tree").alias("near_edited"),
        merkle.likeness("tree", "next.tree").alias("near_next"),
    )


@query("op8_toxicity_chain")
def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, chain).select("doc_id", "toxicity.*").withColumnRenamed("flagged", "predicted")


OP9_SQL = """
WITH w AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item, win FROM (
  SELECT item, unnest(list_transform(range(1, greatest(1, len(ws) - 9) + 1), lambda i: list_slice(ws, i, i + 9))) AS win FROM w WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT len(win) AS n FROM win),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS ws FROM documents),
pos AS (SELECT r, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM d, lens WHERE len(ws) >= n),
hit AS (SELECT pos.r, pos.i, pos.n, win.item FROM pos JOIN win ON list_slice(pos.ws, pos.i, pos.i + pos.n - 1) = win.win),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)
"""


@query("op9_benchmark_decontamination", OP9_SQL)
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    hits = decontaminate.hit_words("contamination")
    return found.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("contamination.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("contamination.items")), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


@query("op10_pairwise_quality")
def op10_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranker = pairwise_quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = pairwise_quality.score_quality(docs, ranker)
    return scored.select(
        "doc_id",
        pairwise_quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= pairwise_quality.THRESHOLD).cast("int").alias("predicted"),
    )


#: Where the tokenizer file of op11 is found, relative to the folder of public tokenizers.
TOKENIZER, TOKEN_LIMIT = "piece_bpe_32k.model", 4096


@query("op11_token_cache")
def op11_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache begins empty, so every distinct text is encoded once."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_cache.count_tokens(docs, token_cache.load_tokenizer(public_tokenizers.path(TOKENIZER)), fresh_dir(spark, "tokens"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query("op12_walsh_codes", walsh_codes.codes_sql())
def op12_walsh_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = walsh_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


@query("op13_spelling_variants", spelling.variants_sql())
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
