"""Token counts through a digest cache.

The cache is a Parquet folder with one partition a tokenizer version: ``tokenizer=<digest>/(content, n_tokens)``.
``content`` is the SHA-256 of the normalised text, the tokenizer's digest covers its file, its library and the
library's version, so a new file or library never meets old counts. Counting takes three steps:

1. The digests of the table are joined to the stored ones; what has none is a miss.
2. Each distinct miss is encoded once, whole, and appended to the cache.
3. Rows take their count from the cache by digest.

Only step 2 moves texts, and only as far as needed: a few misses are sent to the tables' tasks, which then pass on
just those texts; with many, each task passes on one copy of a text at most (a partial aggregation), so a text on a
third of all rows is no hot key. Steps 1 and 3 move digests.

An append is a Spark write: a job that fails leaves no partial file behind, or (with a committer that publishes task
by task) entries that are right as far as they go; runs side by side may store an entry twice. Reading takes one
entry a digest, so neither changes a count.

Normalisation may only merge texts that the tokenizer cannot tell apart. It is read off the tokenizer's own normaliser:
A-Z to a-z where that lowers, runs of ASCII blanks to one where that does so, nothing else.

Defined results: a null text counts as an empty one, 0 tokens; texts are encoded whole, without special tokens,
truncation or padding; repeated rows and rows with a null id come back once each; an empty table gives an empty table;
other columns stay, and a column that has a result's name already is an error.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.llm.common import ascii_lower, claim, free_name, utf8, written

#: Missing digests (of 32 bytes) that are broadcast to the texts; above, they are joined by a shuffle.
SENT = 100_000
#: Texts handed to the library at a time.
BATCH = 256
SCHEMA = "content binary, n_tokens long, tokenizer string"


@dataclass(frozen=True)
class Tokenizer:
    """A tokenizer file's bytes (they travel with the job, executors need no path) and its version digest."""

    library: str
    model: bytes = field(repr=False)
    digest: str
    lowers: bool = False
    squeezes: bool = False

    def normalised(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        if self.lowers:
            text = ascii_lower(text)
        return F.regexp_replace(text, "[ \\t\\n\\x0B\\f\\r]+", " ") if self.squeezes else text


def _steps(normaliser: dict | None) -> list[dict]:
    if not normaliser:
        return []
    return [s for part in normaliser["normalizers"] for s in _steps(part)] if normaliser["type"] == "Sequence" else [normaliser]


def load_tokenizer(path: str) -> Tokenizer:
    """``.json`` for the library tokenizers, ``.model`` for sentencepiece."""
    with open(path, "rb") as file:
        model = file.read()
    steps: list[dict] = []
    if path.endswith(".json"):
        import tokenizers as library

        steps = _steps(json.loads(model).get("normalizer"))
    elif path.endswith(".model"):
        import sentencepiece as library
    else:
        raise ValueError(f"no library for {path}: use .json or .model")
    name = library.__name__
    digest = hashlib.sha256(f"{name} {library.__version__} plain 1\n".encode() + model).hexdigest()
    # steps that come before must not see a difference either: only these orders are known to be safe
    kinds = [s["type"] for s in steps]
    safe = set(kinds) <= {"NFC", "Replace", "Lowercase"}
    blanks = any(s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " " for s in steps)
    return Tokenizer(name, model, digest, safe and "Lowercase" in kinds, safe and kinds.count("Replace") == 1 and blanks)


@lru_cache(maxsize=2)
def _counter(library: str, model: bytes) -> Callable[[list[bytes]], list[int]]:
    if library == "sentencepiece":
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        return lambda rows: [len(ids) for ids in pieces.encode(rows, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's cores are dealt out by Spark
    from tokenizers import Tokenizer as Loaded

    loaded = Loaded.from_buffer(model)
    loaded.no_truncation()
    loaded.no_padding()

    def count(rows: list[bytes]) -> list[int]:
        found = loaded.encode_batch_fast([r.decode("utf-8", "replace") for r in rows], add_special_tokens=False)
        return [len(x) for x in found]

    return count


def encoded(text: Column, tokenizer: Tokenizer) -> Column:
    """Token count of each text, by the library itself; no cache."""
    library, model = tokenizer.library, tokenizer.model

    @F.arrow_udf("long")
    def lengths(column: pa.Array) -> pa.Array:
        count, rows = _counter(library, model), column.cast(pa.large_binary())
        out: list[int] = []
        for at in range(0, len(rows), BATCH):
            out += count(list(utf8(rows.slice(at, BATCH))))
        return pa.array(out, pa.int64())

    return lengths(text)


def content_digest(text: Column, tokenizer: Tokenizer) -> Column:
    return F.unhex(F.sha2(tokenizer.normalised(text), 256))


def stored(spark: SparkSession, cache: str, tokenizer: Tokenizer) -> DataFrame:
    """(content, n_tokens): one entry a digest of this tokenizer version."""
    try:
        rows = spark.read.schema(SCHEMA).parquet(cache)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], SCHEMA)
    return rows.filter(F.col("tokenizer") == tokenizer.digest).groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, tokenizer: Tokenizer, cache: str, text_col: str = "text", sent: int = SENT) -> None:
    """Encodes the distinct texts of ``docs`` that the cache lacks and appends their counts."""
    spark = docs.sparkSession
    rows = docs.select(content_digest(F.col(text_col), tokenizer).alias("content"), F.coalesce(text_col, F.lit("")).alias("t"))
    known = stored(spark, cache, tokenizer).select("content")
    if known.isEmpty():
        misses = rows.dropDuplicates(["content"])
    else:
        wanted = written(rows.select("content").distinct().join(known, "content", "left_anti"), "misses")
        n = wanted.count()
        if n == 0:
            return
        if n <= sent:
            misses = rows.join(F.broadcast(wanted), "content", "left_semi").dropDuplicates(["content"])
        else:
            misses = rows.dropDuplicates(["content"]).join(wanted, "content", "left_semi")
    counted = misses.select("content", encoded(F.col("t"), tokenizer).alias("n_tokens"), F.lit(tokenizer.digest).alias("tokenizer"))
    counted.write.mode("append").partitionBy("tokenizer").parquet(cache)


def count_tokens(
    docs: DataFrame, tokenizer: Tokenizer, cache: str, text_col: str = "text", out: str = "n_tokens", out_bytes: str = "n_bytes", sent: int = SENT
) -> DataFrame:
    """``docs`` with its texts' UTF-8 bytes and token counts, after the cache at path ``cache`` has been filled.

    Select what is needed from the result: columns left out, the text above all, then take no part in the join.
    """
    claim(docs, out, out_bytes)
    fill_cache(docs, tokenizer, cache, text_col, sent)
    key = free_name(docs, "__content")
    counts = stored(docs.sparkSession, cache, tokenizer).select(F.col("content").alias(key), F.col("n_tokens").alias(out))
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint")
    keyed = docs.withColumns({key: content_digest(F.col(text_col), tokenizer), out_bytes: size})
    return keyed.join(counts, key, "left").drop(key)
