"""Benchmark decontamination: a broadcast hash set of test n-grams against all training windows.

Words are runs of anything but ASCII blanks, signs and punctuation, after lowering A-Z. A benchmark
item gives its windows of ``n`` consecutive words; an item with fewer words is one window. The windows
go to every task as a sorted array of 64-bit hashes; each document's windows are hashed in one go,
candidates are looked up, and every candidate is verified word by word before it counts.

The broadcast is bounded: the benchmark is cut into blocks of at most ``BLOCK`` window words, and
each block is one pass over the documents, whose result is written before the next pass. A benchmark
of usual size is one block and one map-only pass.

Defined results: a null text has no words, in documents and benchmark; items without words have no
windows; rows with one item_id are one item; an item whose id is null still hits words but is never
listed or counted; repeated documents are judged one by one; empty tables hit nothing. All columns of
the documents stay.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.llm.common import claim, free_name, utf8, written

#: Words of benchmark windows that one broadcast may hold.
BLOCK = 5_000_000

#: Every byte that is no word byte becomes a blank, A-Z become a-z; bytes of non-ASCII letters stay.
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))

HITS = "struct<n_words: bigint, hits: array<struct<start: int, stop: int>>, items: array<string>>"
_SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
_HITS = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Windows:
    """Windows of some benchmark items: a vocabulary, and per window length the sorted hashes."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], n: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, words in items:
            for i in range(max(1, len(words) - n + 1) if words else 0):
                found.setdefault(tuple(words[i : i + n]), set()).update(() if item is None else (item,))
        self.ids = {w: k for k, w in enumerate(sorted({w for window in found for w in window}), 1)}
        rng = np.random.default_rng(9)
        self.salt = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list[list[str]]]] = {}
        for length in sorted({len(w) for w in found}):
            rows = [w for w in found if len(w) == length]
            ids = np.array([[self.ids[x] for x in w] for w in rows], np.uint64)
            hashes = (ids * self.salt[:length]).sum(axis=1, dtype=np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.by_length[length] = (hashes[order], ids[order], [sorted(found[rows[k]]) for k in order])

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged hit ranges of word positions, and the items found."""
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        hit, items = np.zeros(len(words) + 1, np.int32), set()
        for length, (hashes, rows, names) in self.by_length.items():
            n = len(words) - length + 1
            if n < 1 or not ids.any():
                continue
            unknown = np.concatenate(([0], np.cumsum(ids == 0)))
            at = np.flatnonzero(unknown[length:] == unknown[:n])
            if not len(at):
                continue
            mine = ids[at[:, None] + np.arange(length)]
            h = (mine * self.salt[:length]).sum(axis=1, dtype=np.uint64)
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for k in np.flatnonzero(hi > lo):
                for j in range(lo[k], hi[k]):
                    if np.array_equal(rows[j], mine[k]):  # the hash agrees: verify
                        items.update(names[j])
                        hit[at[k]] += 1
                        hit[at[k] + length] -= 1
        on = np.concatenate(([0], np.cumsum(hit[:-1]) > 0, [0])).astype(np.int8)
        turn = np.diff(on)
        return list(zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist())), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, n: int, block: int):
    """The items in pieces of at most ``block`` window words each (a single longer item alone)."""
    size = lambda words: n * max(1, len(words) - n + 1)
    kept: list[tuple[str | None, list[bytes]]] = []
    held = 0
    for row in benchmark.select(F.col(item_col).cast("string"), F.encode(text_col, "UTF-8")).toLocalIterator():
        words = words_of(bytes(row[1] or b""))
        if kept and held + size(words) > block:
            yield kept
            kept, held = [], 0
        if words:
            kept.append((row[0], words))
            held += size(words)
    if kept:
        yield kept


def _scanner(shared):
    """A UDF that looks up the windows of one broadcast and adds what it finds to earlier hits."""

    @F.arrow_udf(HITS)
    def scan(text: pa.Array, before: pa.Array) -> pa.Array:
        windows, rows = shared.value, []
        for t, old in zip(utf8(text), before):
            words = words_of(t)
            spans, found = windows.scan(words)
            old = old.as_py()
            if old:
                spans = _merged(spans + [(x["start"], x["stop"]) for x in old["hits"]])
                found |= set(old["items"])
            rows.append({"n_words": len(words), "hits": [{"start": a, "stop": b} for a, b in spans], "items": sorted(found)})
        return pa.array(rows, _HITS)

    return scan


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    n: int = 10,
    out: str = "contamination",
    block: int = BLOCK,
) -> DataFrame:
    """The documents plus ``out``: n_words, hits (merged ranges of word positions), items found. ``out`` must be free."""
    claim(docs, out)
    spark = docs.sparkSession
    held = free_name(docs, "__before")
    current, k = docs.withColumn(held, F.lit(None).cast(HITS)), -1
    for k, items in enumerate(_blocks(benchmark, item_col, item_text, n, block)):
        if k:
            current = written(current, "decontaminate")
        scan = _scanner(spark.sparkContext.broadcast(Windows(items, n)))
        current = current.withColumn(held, scan(F.col(text_col), F.col(held)))

    @F.arrow_udf("long")
    def count_words(text: pa.Array) -> pa.Array:
        return pa.array([len(words_of(t)) for t in utf8(text)], pa.int64())

    if k < 0:  # no window anywhere: only words to count
        none = F.struct(count_words(F.col(text_col)).alias("n_words"), F.array().cast("array<struct<start:int,stop:int>>").alias("hits"), F.array().cast("array<string>").alias("items"))
        current = current.withColumn(held, none)
    return current.withColumnRenamed(held, out)


def hit_words(contamination: str) -> Column:
    return F.aggregate(f"{contamination}.hits", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.0, **settings) -> DataFrame:
    """Documents of whose words at most ``max_share`` are hit."""
    out = free_name(docs, "__contamination")
    found = find_contamination(docs, benchmark, out=out, **settings)
    return found.filter(hit_words(out) <= F.lit(max_share) * F.col(f"{out}.n_words")).drop(out)


def cut_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The documents without the hit words: each hit range goes from its first word to its last,
    what stands between other words stays as it is."""
    out = free_name(docs, "__contamination")
    found = find_contamination(docs, benchmark, text_col=text_col, out=out, **settings)

    @F.arrow_udf("string")
    def cut(text: pa.Array, hits: pa.Array) -> pa.Array:
        rows = []
        for t, spans in zip(text.cast(pa.large_binary()), hits):
            t, spans = t.as_py(), spans.as_py() or []
            if t is None or not spans:
                rows.append(None if t is None else t.decode())
                continue
            plain, starts, ends, at = t.translate(WORD_BYTES), [], [], 0
            for w in plain.split():
                at = plain.index(w, at)
                starts.append(at)
                at += len(w)
                ends.append(at)
            parts, last = [], 0
            for s in spans:
                parts.append(t[last : starts[s["start"]]])
                last = ends[s["stop"] - 1]
            rows.append(b"".join([*parts, t[last:]]).decode())
        return pa.array(rows, pa.string())

    return found.withColumn(text_col, cut(F.col(text_col), F.col(f"{out}.hits"))).drop(out)
