"""Near-duplicates by word shingles: one row stays of the texts that links of Jaccard ``SIMILAR`` or more join.

A text is the set of its ``words``-word shingles (lowered, split and hashed as in ``simhash_trie``; fewer words
are one shingle, no words an empty set, and two empty sets are equal). Distinct texts, told apart by 128 bits, are compared:

1. Each text gives a SimHash over its distinct shingles and ``BANDS`` keys of ``ROWS`` minima each. Texts of
   similarity s share a key with probability 1 - (1 - s^ROWS)^BANDS: 0.99995 at 0.8.
2. The trie walk of ``simhash_trie`` runs inside each key, with a ``BUDGET`` of differing bits sized for recall
   (at 0.8 the mean is 10 of 64, the deviation 3). Its forests join texts into clusters. A cluster is no
   group yet: it only says which texts have to be compared.
3. The shingle sets of a cluster meet once and are searched through breadth first with exact Jaccard. Only links
   that hold there make groups.
4. A cluster of more than ``CHUNK`` texts is searched in chunks, so each set is still sent once. The first texts of the
   groups found there are compared with each other. Then the texts outside a cluster's largest group meet those inside
   that share a key with one of them, chunk by chunk, and each other. Texts of the largest group are not compared with each
   other again, so k near copies cost about k comparisons; every two texts of a cluster that share a key are in one
   group or have been compared.

Rows stay linear: a walk and a search give out forests, never all pairs.

Defined results: a null text is an empty one; rows without words are one group; rows with one id and one text are one
row; of a group the smallest id stays, of rows with that id the smallest digest; a row without an id stays only where its
group has no other; an empty table gives an empty table; other columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.llm.common import components, free_name, utf8, written
from acreline.llm.simhash_trie import SHINGLES, chunk_cells, walked

#: Links have a Jaccard similarity of at least SIMILAR[0] / SIMILAR[1].
SIMILAR = (4, 5)
BANDS, ROWS, BUDGET = 25, 5, 24
#: Fingerprints of one key that a task may walk; texts that a task compares at a time.
WALK, CHUNK = 2_048, 1_024
#: Shingles whose minima are taken at a time.
MINIMA = 1 << 12

_RNG = np.random.default_rng(5)
_ODD = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingle_set(text: bytes, words: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    ws = text.lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    line = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(ws) - words + 1)
    starts, ends = starts[:n].tolist(), ends[min(words, len(ws)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends)), np.uint64, n))


def sketch(h: np.ndarray) -> tuple[int, np.ndarray]:
    """SimHash of a shingle set, and its band keys."""
    if not len(h):
        return 0, np.arange(BANDS, dtype=np.int64)
    ones, low = np.zeros(64, np.int64), np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), SHINGLES):
        bits = np.unpackbits(h[at : at + SHINGLES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    for at in range(0, len(h), MINIMA):
        np.minimum(low, (h[at : at + MINIMA, None] * _ODD + _ADD).min(axis=0), out=low)
    low = low.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(low)]
    fp = int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])
    return fp, np.array(keys, np.uint64).view(np.int64)


def similar_forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs (member, first of its group) for the groups that links of exact similarity make.

    The texts that share a shingle are looked up, so a text costs as much as it has in common with those that are still
    without a group; the lookup is cut down to these whenever they have become half as many.
    """
    n = len(sets)
    size = np.fromiter(map(len, sets), np.int64, n)
    names = np.unique(np.concatenate(sets), return_inverse=True)[1] if size.sum() else np.zeros(0, np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    order = np.argsort(names, kind="stable")
    post = np.repeat(np.arange(n), size)[order]
    ends = np.concatenate(([0], np.cumsum(np.bincount(names)))) if len(names) else np.zeros(1, np.int64)
    alone, left, known, out = np.ones(n, bool), n, n, []
    for first in range(n):
        if not alone[first]:
            continue
        alone[first], queue, left = False, [first], left - 1
        while queue and left:
            x = queue.pop()
            if 2 * left < known:
                keep = alone[post]
                ends = np.concatenate(([0], np.cumsum(keep)))[ends]
                post, known = post[keep], left
            mine = names[begin[x] : begin[x + 1]]
            many = ends[mine + 1] - ends[mine]
            at = np.repeat(ends[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            shared = np.bincount(post[at], minlength=n)
            found = np.flatnonzero(alone & (SIMILAR[1] * shared >= SIMILAR[0] * (size + size[x] - shared))).tolist()
            alone[found] = False
            left -= len(found)
            queue += found
            out += [(y, first) for y in found]
    return out


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, text, set) come sorted by cell; the last cell of a batch waits for its rest."""
    cell, names, sets = None, [], []

    def done() -> pa.RecordBatch:
        pairs = similar_forest(sets)
        a, b = ([names[p[i]] for p in pairs] for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    for batch in batches:
        values = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))
        for c, name, h in values:
            if c != cell:
                if len(sets) > 1:
                    yield done()
                cell, names, sets = c, [], []
            names.append(name)
            sets.append(h.values.to_numpy(zero_copy_only=False).view(np.uint64))
    if len(sets) > 1:
        yield done()


def text_digest(text: Column) -> Column:
    """128 bits: among any number of texts that can be stored, no two different ones are expected to share them."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _compared(docs: DataFrame, text_col: str, cells: DataFrame, words: int) -> DataFrame:
    """(a, b): forests of the links between the texts of each of ``cells(trie, digest)``. A set is made once a text."""

    @F.arrow_udf("array<long>")
    def shingles(column: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t, words).view(np.int64) for t in utf8(column)], pa.list_(pa.int64()))

    text = docs.select(text_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("t"))
    wanted = cells.groupBy("digest").agg(F.collect_list("trie").alias("tries"))
    # texts of no cell go no further; copies of a text are one
    sets = text.join(wanted, "digest").dropDuplicates(["digest"]).select("tries", "digest", shingles("t").alias("h"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sets.select(F.explode("tries").alias("trie"), "digest", "h").repartition(parts, "trie").sortWithinPartitions("trie")
    return dealt.select("trie", "digest", "h").mapInArrow(_search, "a binary, b binary")


def similar_links(docs: DataFrame, text_col: str, sketched: DataFrame, words: int = 5) -> DataFrame:
    """(a, b): a forest of the links between distinct texts, named by their digests. ``sketched`` has their
    (digest, fp, keys)."""
    tries = sketched.select(F.explode("keys").alias("trie"), "fp").distinct()
    cluster = components(walked(tries, BUDGET, WALK))
    named = sketched.select("digest", "fp").distinct().join(cluster, F.col("fp") == F.col("node"), "left")
    named = written(named.select("digest", F.coalesce("root", "fp").alias("trie")), "named")
    sizes = written(named.groupBy("trie").count().filter("count > 1"), "clusters")
    chunk = F.pmod(F.xxhash64("digest"), F.ceil(F.col("count") / CHUNK))
    own = F.when(F.col("count") > CHUNK, F.xxhash64("trie", chunk)).otherwise(F.col("trie"))
    links = written(_compared(docs, text_col, named.join(sizes, "trie").select(own.alias("trie"), "digest"), words), "links")
    large = sizes.filter(F.col("count") > CHUNK).select("trie")
    if large.isEmpty():
        return links
    hot = sketched.dropDuplicates(["digest"]).select("digest", "keys").join(named.join(large, "trie", "left_semi"), "digest")
    hot = written(hot.select("trie", "digest", "keys"), "large")

    def grouped(found: DataFrame) -> DataFrame:
        root = components(found)
        return hot.join(root, F.col("digest") == F.col("node"), "left").select("trie", "digest", "keys", F.coalesce("root", "digest").alias("root"))

    # the first texts of the groups that the chunks have found
    heads = grouped(links).groupBy("trie", "root").agg(F.min("digest").alias("digest"), F.count("*").alias("n")).filter("n > 1").select("trie", "digest")
    links = written(links.union(_compared(docs, text_col, chunk_cells(heads, heads, "digest", CHUNK), words)), "links")

    # what is still apart: the texts outside a cluster's largest group, and those inside that share a key with one of them
    rows = written(grouped(links), "large")
    groups = rows.groupBy("trie", "root").count()
    most = groups.groupBy("trie").agg(F.max(F.struct("count", "root")).alias("most"), F.sum("count").alias("n"))
    most = most.select("trie", F.col("most.root").alias("big"), (F.col("n") - F.col("most.count")).alias("others")).filter("others > 0")
    rows = rows.join(most, "trie").withColumn("is_big", F.col("root") == F.col("big"))
    apart = rows.filter(~F.col("is_big"))
    key = F.explode("keys").alias("key")
    near = rows.filter("is_big").select("trie", "digest", key).join(apart.select("trie", key).distinct(), ["trie", "key"], "left_semi")
    near = near.select("trie", "digest").distinct().withColumn("is_big", F.lit(True))
    met = written(apart.select("trie", "digest", "is_big").union(near), "apart")
    sizes = met.groupBy("trie").agg(F.ceil(F.count_if("is_big") / CHUNK).alias("bigs"), F.ceil(F.count_if(~F.col("is_big")) / CHUNK).alias("others"))
    met = met.join(sizes.withColumn("bigs", F.greatest("bigs", F.lit(1))), "trie")
    # every chunk of the one side meets every chunk of the other
    here = F.pmod(F.xxhash64("digest"), F.when(F.col("is_big"), F.col("bigs")).otherwise(F.col("others")))
    there = F.sequence(F.lit(0), F.when(F.col("is_big"), F.col("others")).otherwise(F.col("bigs")) - 1)
    cell = F.transform(there, lambda k: F.xxhash64("trie", F.when(F.col("is_big"), here).otherwise(k), F.when(F.col("is_big"), k).otherwise(here)))
    cells = met.select(F.explode(cell).alias("trie"), "digest")
    # chunks of texts apart meet each other in the keys they share
    many = apart.join(sizes.filter("others > 1").select("trie"), "trie", "left_semi").select(F.col("trie").alias("of"), "digest", key)
    many = many.select(F.xxhash64("of", "key", F.lit("apart")).alias("trie"), "digest")
    several = many.groupBy("trie").count().filter("count > 1").select("trie")
    many = many.join(several, "trie", "left_semi")
    cells = cells.union(chunk_cells(many, many, "digest", CHUNK).select("trie", "digest"))
    return written(links.union(_compared(docs, text_col, cells, words)), "links")


def drop_similar_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """One row of each group stays, by the rule of ``simhash_trie.drop_near_duplicates``."""

    @F.arrow_udf("struct<fp: long, keys: array<long>>")
    def sketches(column: pa.Array) -> pa.Array:
        rows = [sketch(shingle_set(t, words)) for t in utf8(column)]
        kind = pa.struct([("fp", pa.int64()), ("keys", pa.list_(pa.int64()))])
        return pa.array([{"fp": a, "keys": b} for a, b in rows], kind)

    digest = text_digest(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), digest.alias("digest"), sketches(F.col(text_col)).alias("s"))
    rows = written(rows.select("id", "digest", "s.*"), "similar")
    root = components(similar_links(docs, text_col, rows.drop("id"), words))
    order = F.struct(F.col("id").isNull().alias("lone"), "id", "digest")
    lows = rows.groupBy("digest").agg(F.min(order).alias("low")).join(root, F.col("digest") == F.col("node"), "left")
    first, mine = free_name(docs, "__first"), free_name(docs, "__mine")
    stay = lows.groupBy(F.coalesce("root", "digest").alias("r")).agg(F.min("low").alias("low"))
    stay = stay.select(F.struct("low.id", "low.digest").alias(first))
    # of exactly the other side's type: else the join key is a cast of it, and the next step shuffles the texts again
    keyed = docs.withColumn(mine, F.struct(F.col(id_col).alias("id"), digest.alias("digest")).cast(stay.schema[first].dataType))
    return keyed.join(stay, F.col(mine) == F.col(first), "left_semi").dropDuplicates([mine]).drop(mine)
