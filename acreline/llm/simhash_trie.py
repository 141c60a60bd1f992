"""SimHash near-duplicate groups by a binary trie self-join.

A text's fingerprint has 64 bits: bit b is set when it is set in more than half of the hashes of
the text's word shingles. Two fingerprints link at ``budget`` or fewer differing bits.

The join walks a binary trie over the fingerprints, a pair of nodes at a time. A node pair carries
the number of bits in which its two prefixes differ; equal branches keep it, crossed branches add
one, and a pair above the budget is pruned with everything below it.

Spark deals the work out. With ``budget`` errors in ``budget + 1`` blocks of bits, two linked
fingerprints agree in one block at least, so each block value is a subtrie of its own and no link is
lost. Only distinct fingerprints take part. A subtrie above ``SUBTRIE`` fingerprints is cut into
chunks and every pair of chunks becomes a task. A task gives out a spanning forest of its links, never
all pairs.

Defined results: a null text is an empty text; a text without words has fingerprint zero, which links
like any other; a null id never becomes a group id unless the group has no other (then null);
repeated rows come back once each; an empty table gives an empty table; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.llm.common import checkpointed, components, free_name, utf8, written

#: Fingerprints of one subtrie that a single task may join.
SUBTRIE = 16_384
#: Rows gathered in a task before their subtries are walked; node pairs walked at a time.
BATCH, FRONT = 131_072, 1 << 19
#: Node pairs with so few leaf pairs are compared leaf by leaf.
LEAVES = 32
#: Shingles hashed at a time, so that a very long text needs bounded memory.
SHINGLES = 1 << 16


def _majority(text: bytes, words: int, seed: int) -> int:
    ws = text.lower().split()  # bytes: lowers A-Z only, splits at the six ASCII blanks only
    if not ws:
        return 0
    line = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(ws) - words + 1)
    starts, ends = starts[:n].tolist(), ends[min(words, len(ws)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES):
        cut = zip(starts[at : at + SHINGLES], ends[at : at + SHINGLES])
        h = np.array([digest(line[a:b], seed) for a, b in cut], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def simhash(text: Column, words: int = 4, seed: int = 42) -> Column:
    """64-bit fingerprint of a text as a signed long."""

    @F.arrow_udf("long")
    def fingerprint(column: pa.Array) -> pa.Array:
        return pa.array([_majority(t, words, seed) for t in utf8(column)], pa.int64())

    return fingerprint(text)


def hex_fingerprint(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- the trie walk ---------------------------------------------------------------------------


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of a[i] and b[i]; label holds the smallest member of each tree afterwards."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _leaf_pairs(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaf indices of all pairs below the node pairs ``p`` (rows: from, to, from, to, errors)."""
    left, right = p[1] - p[0], p[3] - p[2]
    size = left * right
    which = np.repeat(np.arange(p.shape[1]), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return p[0][which] + at // right[which], p[2][which] + at % right[which]


def trie_forest(tries: np.ndarray, prints: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links inside each trie: pairs (member, smallest member).

    ``prints`` are unsigned fingerprints, ``tries`` says to which trie each belongs. A node at depth
    d is a range of the sorted fingerprints; the running count of ones of bit d gives its children.
    """
    order = np.lexsort((prints, tries))
    tries, prints = tries[order], prints[order]
    label = np.arange(len(prints))
    edge = np.flatnonzero(np.concatenate(([True], tries[1:] != tries[:-1], [True])))
    roots = np.stack([edge[:-1], edge[1:], edge[:-1], edge[1:], np.zeros(len(edge) - 1, np.int64)])
    ones: dict[int, np.ndarray] = {}
    todo = [(0, roots)]
    while todo:
        depth, p = todo.pop()
        if p.shape[1] > FRONT:
            todo += [(depth, p[:, FRONT:]), (depth, p[:, :FRONT])]
            continue
        # the product of the sizes alone is not enough: a self pair has to hold two leaves
        few = ((p[1] - p[0]) * (p[3] - p[2]) <= LEAVES) | (depth == 64)
        if few.any():
            a, b = _leaf_pairs(p[:, few])
            close = (a < b) & (np.bitwise_count(prints[a] ^ prints[b]) <= budget)
            _hook(label, a[close], b[close])
            p = p[:, ~few]
        if not p.shape[1]:
            continue
        if depth not in ones:
            bit = (prints >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bit))).astype(np.int64)
        one = ones[depth]
        m1, m2 = p[1] - (one[p[1]] - one[p[0]]), p[3] - (one[p[3]] - one[p[2]])
        same = p[0] == p[2]
        crossed = [
            np.stack([p[0], m1, p[2], m2, p[4]]),
            np.stack([m1, p[1], m2, p[3], p[4]]),
            np.stack([p[0], m1, m2, p[3], p[4] + 1]),
            np.stack([m1, p[1], p[2], m2, p[4] + 1])[:, ~same],
        ]
        p = np.concatenate(crossed, axis=1)
        p = p[:, (p[0] < p[1]) & (p[2] < p[3]) & (p[4] <= budget)]
        todo.append((depth + 1, p))
    member = np.flatnonzero(label != np.arange(len(label)))
    return prints[member], prints[label[member]]


def _walk(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by trie; whole tries are walked together, the last one waits for its rest."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []

    def done(tries: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        a, b = trie_forest(tries, prints.view(np.uint64), budget)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    rows = 0
    for batch in batches:
        kept.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
        rows += batch.num_rows
        if rows >= BATCH:
            tries, prints = (np.concatenate(x) for x in zip(*kept))
            last = int(np.searchsorted(tries, tries[-1]))
            if last:
                yield done(tries[:last], prints[:last])
            kept, rows = [(tries[last:], prints[last:])], len(tries) - last
    if kept:
        yield done(*(np.concatenate(x) for x in zip(*kept)))


def links(prints: DataFrame, budget: int = 4, subtrie: int = SUBTRIE) -> DataFrame:
    """(a, b): a spanning forest of the links between the distinct longs of column ``fp``."""
    blocks = budget + 1
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    keys = [
        # the sign bit is part of the first block, hence the unsigned shift
        F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1)) * blocks + F.lit(i)
        for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))
    ]
    return walked(prints.select("fp", F.explode(F.array(*keys)).alias("trie")), budget, subtrie)


def chunk_cells(rows: DataFrame, tries: DataFrame, key: str, most: int) -> DataFrame:
    """``rows`` with column trie, those of a trie above ``most`` rows of ``tries`` dealt to pairs of chunks by ``key``."""
    hot = tries.groupBy("trie").count().filter(F.col("count") > most).withColumn("chunks", F.ceil(F.col("count") / most))
    hot = checkpointed(hot.select("trie", "chunks"))
    if hot.isEmpty():
        return rows
    chunk = F.pmod(F.xxhash64(key), "chunks")
    cell = lambda j: F.xxhash64("trie", F.least(chunk, j), F.greatest(chunk, j))
    cells = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), cell)
    cells = F.explode(F.when(F.col("chunks").isNull(), F.array("trie")).otherwise(cells)).alias("trie")
    return rows.join(hot, "trie", "left").select(cells, *(c for c in rows.columns if c != "trie"))


def walked(tries: DataFrame, budget: int, subtrie: int) -> DataFrame:
    """(a, b): a spanning forest of the links inside each trie of ``tries(trie, fp)``."""
    parts = int(tries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunk_cells(tries, tries, "fp", subtrie).select("trie", "fp").repartition(parts, "trie").sortWithinPartitions("trie")
    return dealt.mapInArrow(lambda batches: _walk(batches, budget), "a long, b long")


def _rooted(prints: DataFrame, low: Column, budget: int, subtrie: int) -> DataFrame:
    """(fp, root, low) per distinct fingerprint: ``low`` is the smallest of its rows, ``root`` names its group."""
    groups = prints.groupBy("fp").agg(F.min(low).alias("low"))
    root = components(links(prints.select("fp").distinct(), budget, subtrie))
    rooted = groups.join(root, groups["fp"] == root["node"], "left")
    return rooted.select("fp", F.coalesce("root", "fp").alias("root"), "low")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, budget: int = 4, subtrie: int = SUBTRIE
) -> DataFrame:
    """(id, simhash long, component_id) per row: the smallest id that its links reach, itself included."""
    prints = written(docs.select(F.col(id_col).alias("id"), simhash(F.col(text_col), words).alias("fp")), "simhash")
    rooted = _rooted(prints, F.col("id"), budget, subtrie)
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lows, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("id", F.col("fp").alias("simhash"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, budget: int = 4, subtrie: int = SUBTRIE
) -> DataFrame:
    """One row of each group stays: that of the smallest id, and of rows with that id that of the smallest text
    hash. Of rows equal in both, any one stays. A row without an id stays only where the group has no other."""
    digest = F.xxhash64(text_col)
    prints = docs.select(F.col(id_col).alias("id"), digest.alias("digest"), simhash(F.col(text_col), words).alias("fp"))
    order = F.struct(F.col("id").isNull().alias("lone"), "id", "digest")
    rooted = _rooted(written(prints, "simhash"), order, budget, subtrie)
    first, mine = free_name(docs, "__first"), free_name(docs, "__mine")
    stay = rooted.groupBy("root").agg(F.min("low").alias("low")).select(F.struct("low.id", "low.digest").alias(first))
    # of exactly the other side's type: else the join key is a cast of it, and the next step shuffles the texts again
    keyed = docs.withColumn(mine, F.struct(F.col(id_col).alias("id"), digest.alias("digest")).cast(stay.schema[first].dataType))
    return keyed.join(stay, F.col(mine) == F.col(first), "left_semi").dropDuplicates([mine]).drop(mine)
