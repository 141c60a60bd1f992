"""Spelling variants: words that differ by one code point, found through Bloom-guided neighbourhoods.

1. Words are counted over all texts; each task adds up its own before anything is shuffled. Words of at least ``SHORTEST``
   code points and ``LEAST`` occurrences are the vocabulary.
2. The vocabulary goes into blocked Bloom filters, a shard for each word length: a word sets ``BITS`` bits of one block of
   512. The filters are broadcast in slices of a bounded size (``SLICE`` bytes); a large vocabulary takes several passes.
3. Every word's edits are generated and probed: each deletion in the shard one shorter, each replacement in the word's own
   shard. A pair that differs by an insertion is found from its longer word, one that differs by a replacement from its
   smaller word, so each pair is generated once. Edits are made as hashes, by arithmetic on the hash of the word (a sum of
   c_i B^i modulo 2^64, mixed afterwards); only an edit that the filter has becomes a string.
4. Only these positives are shuffled, to an exact join with the vocabulary that removes the false ones. Equal words have
   equal hashes and a filter misses no word it holds, so no pair is lost.
5. A word's form is its near word of largest count if that is ``RATIO`` times its own at least; counts grow along a chain of
   forms, so roots are found by a few rounds of pointer doubling.

A word has a bounded number of edits, so no key of the joins is hot. Words, not texts, are moved.

Defined results: a null text has no words; a null id counts as an empty one in the checksum that picks the runs to
edit; repeated rows count again; ties of the largest near word go to the smallest in code point order; an empty table or
vocabulary gives an empty table; only the id and the text of ``docs`` are read, whatever other columns it has.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.llm.common import checkpointed, utf8, written

#: Least code points and occurrences of a word; how much more often its form occurs.
SHORTEST, LEAST, RATIO = 6, 5, 5
#: One run in so many, by checksum, loses a code point.
EDITED = 199
#: Words that a task may hold before it passes its counts on.
HELD = 1 << 18
#: Words a block of 512 bits is made for, bits a word sets, bytes of filter in one broadcast, blocks built in one piece.
FULL, BITS, SLICE, PIECE = 32, 7, 64 << 20, 1 << 10
#: Edits probed at a time.
PROBES = 1 << 20

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


# --- words -----------------------------------------------------------------------------------


def words_of(doc_id: str, text: bytes) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of a text. Shorter runs can give no word, so they are not even cut out."""
    runs = Counter(_RUN.findall(text.lower().decode("utf-8", "replace")))
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % EDITED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < SHORTEST:
                continue
        yield run, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            for word, n in words_of(doc_id, text):
                held[word] += n
            if len(held) >= HELD:
                yield out()
                held.clear()
    yield out()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``SHORTEST`` code points that occur ``LEAST`` times or more."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).alias("t"))
    added = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return added.filter(F.col("n") >= LEAST)


# --- hashes of words and of their edits ---------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _points(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row a word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, length)


def _powers(length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(1)], np.cumprod(np.full(length, _BASE), dtype=np.uint64)))


def _terms(points: np.ndarray) -> np.ndarray:
    """c_i B^i, where c is a mixed code point."""
    return _mixed(points.astype(np.uint64)) * _powers(points.shape[1])[:-1]


def word_hashes(points: np.ndarray) -> np.ndarray:
    return _terms(points).sum(axis=1, dtype=np.uint64)


def deletions(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of every different word that a deletion gives: of a run of equal code points only the first goes."""
    terms = _terms(points)
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    after = before[:, -1:] - before
    hashes = before - terms + after * _BACK
    first = np.ones(points.shape, bool)
    first[:, 1:] = points[:, 1:] != points[:, :-1]
    row, place = np.nonzero(first)
    return row, place, hashes[row, place]


def replacements(points: np.ndarray, place: int, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, letter's index, hash) of every replacement at ``place`` by a larger letter."""
    power = _powers(points.shape[1])[place]
    old = points[:, place]
    rest = word_hashes(points) - _mixed(old.astype(np.uint64)) * power
    row, letter = np.nonzero(letters[None, :] > old[:, None])
    return row, letter, rest[row] + (_mixed(letters.astype(np.uint64)) * power)[letter]


# --- filters -----------------------------------------------------------------------------------


def _places(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of a word in its shard, and the number its bits are read from."""
    m = _mixed(h)
    return ((m >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), _mixed(m + _BASE)


def held(shard: np.ndarray, low: int, h: np.ndarray, blocks: int) -> np.ndarray:
    """Indices of the hashes that the filter may hold; ``shard`` has the blocks from ``low`` on, of ``blocks`` in all."""
    block, bits = _places(h, blocks)
    left = np.flatnonzero((block >= low) & (block < low + len(shard)))
    block, bits = (block[left] - low) * 8, bits[left]
    flat = shard.reshape(-1)
    for _ in range(BITS):
        bit = bits & np.uint64(511)
        hit = (flat[block + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        left, block, bits = left[hit], block[hit], bits[hit] >> np.uint64(9)
    return left


def blocks_of(words: int) -> int:
    return -(-words // FULL)


def _pieces(batches: Iterator[pa.RecordBatch], sizes: dict[int, int], cut: int) -> Iterator[pa.RecordBatch]:
    """Rows (length, piece, word) come sorted: each piece of a shard is built whole and given out once."""
    at, filled = None, np.zeros((cut, 8), np.uint64)

    def out() -> pa.RecordBatch:
        row = [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([filled.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(row, ["length", "piece", "bits"])

    for batch in batches:
        lengths, pieces = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edge = np.flatnonzero(np.concatenate(([True], (lengths[1:] != lengths[:-1]) | (pieces[1:] != pieces[:-1]), [True])))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            key = (int(lengths[a]), int(pieces[a]))
            if key != at:
                if at is not None:
                    yield out()
                at, filled = key, np.zeros((cut, 8), np.uint64)
            block, bits = _places(word_hashes(_points(batch.column(2)[a:b].to_pylist(), key[0])), sizes[key[0]])
            block -= key[1] * cut
            for _ in range(BITS):
                bit = bits & np.uint64(511)
                np.bitwise_or.at(filled, (block, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
                bits = bits >> np.uint64(9)
    if at is not None:
        yield out()


def slices(sizes: dict[int, int], most: int = SLICE, cut: int = PIECE) -> Iterator[list[tuple[int, int, int]]]:
    """(length, first piece, piece after the last) of the shards, dealt to broadcasts of ``most`` bytes at most."""
    room = whole = max(1, most // (cut * 64))
    dealt: list[tuple[int, int, int]] = []
    for length, blocks in sorted(sizes.items()):
        low, high = 0, -(-blocks // cut)
        while low < high:
            take = min(room, high - low)
            dealt.append((length, low, low + take))
            low, room = low + take, room - take
            if not room:
                yield dealt
                dealt, room = [], whole
    if dealt:
        yield dealt


def _probed(batches: Iterator[pa.RecordBatch], shards: dict[int, tuple[int, np.ndarray]], sizes: dict[int, int], letters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(word, n, edit) for the edits of a batch's words that the broadcast filters have."""
    for batch in batches:
        words, counts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
        size = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(size).tolist():
            mine = np.flatnonzero(size == length)
            step = max(1, PROBES // max(length, len(letters)))
            for at in range(0, len(mine), step):
                some = mine[at : at + step]
                points = _points(words[some].tolist(), length)
                found: list[tuple[np.ndarray, list[str]]] = []
                if length - 1 in shards:
                    row, place, h = deletions(points)
                    hit = held(shards[length - 1][1], shards[length - 1][0], h, sizes[length - 1])
                    texts = [(w := words[some[r]])[:p] + w[p + 1 :] for r, p in zip(row[hit].tolist(), place[hit].tolist())]
                    found.append((some[row[hit]], texts))
                if length in shards:
                    for p in range(length):
                        row, letter, h = replacements(points, p, letters)
                        hit = held(shards[length][1], shards[length][0], h, sizes[length])
                        new = letters[letter[hit]].tolist()
                        texts = [(w := words[some[r]])[:p] + chr(c) + w[p + 1 :] for r, c in zip(row[hit].tolist(), new)]
                        found.append((some[row[hit]], texts))
                for who, texts in found:
                    if texts:
                        columns = [pa.array(words[who].tolist(), pa.string()), pa.array(counts[who]), pa.array(texts, pa.string())]
                        yield pa.RecordBatch.from_arrays(columns, ["word", "n", "edit"])


def _alphabet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = {c for batch in batches for word in batch.column(0).to_pylist() for c in word}
    yield pa.RecordBatch.from_arrays([pa.array(sorted(map(ord, seen)), pa.int64())], ["point"])


# --- the operator --------------------------------------------------------------------------------


def near_pairs(vocabulary: DataFrame, most: int = SLICE, cut: int = PIECE) -> DataFrame:
    """(word, n, near, near_n): every pair of words of ``vocabulary(word, n)`` that differ by one code point, once."""
    spark = vocabulary.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    length = F.char_length("word")
    sizes = {r["length"]: blocks_of(r["count"]) for r in vocabulary.groupBy(length.alias("length")).count().collect()}
    # the alphabet: at most every code point there is
    points = vocabulary.select("word").mapInArrow(_alphabet, "point long").distinct()
    letters = np.array(sorted(r["point"] for r in points.collect()), np.uint32)

    @F.arrow_udf("long")
    def piece(words: pa.Array) -> pa.Array:
        names = np.array(words.to_pylist(), object)
        size, out = np.fromiter(map(len, names), np.int64, len(names)), np.zeros(len(names), np.int64)
        for k in np.unique(size).tolist():
            mine = size == k
            out[mine] = _places(word_hashes(_points(names[mine].tolist(), k)), sizes[k])[0] // cut
        return pa.array(out)

    dealt = vocabulary.select(length.alias("length"), piece("word").alias("piece"), "word")
    positives = None
    for slice_ in slices(sizes, most, cut):
        inside = [(F.col("length") == k) & F.col("piece").between(a, b - 1) for k, a, b in slice_]
        mine = dealt.filter(F.array_contains(F.array(*inside), True))
        built = mine.repartition(parts, "length", "piece").sortWithinPartitions("length", "piece")
        built = built.mapInArrow(partial(_pieces, sizes=sizes, cut=cut), "length int, piece long, bits binary")
        shards = {k: (a * cut, np.zeros(((b - a) * cut, 8), np.uint64)) for k, a, b in slice_}
        for r in built.collect():  # a slice in all, which is bounded
            low, bits = shards[r["length"]]
            at = r["piece"] * cut - low
            bits[at : at + cut] = np.frombuffer(bytes(r["bits"]), np.uint64).reshape(-1, 8)
        sent = spark.sparkContext.broadcast(shards)
        del shards
        probe = lambda batches, sent=sent: _probed(batches, sent.value, sizes, letters)
        found = written(vocabulary.repartition(parts).mapInArrow(probe, "word string, n long, edit string"), "positives")
        sent.unpersist()
        positives = found if positives is None else positives.union(found)
    if positives is None:
        return vocabulary.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    exact = vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    return positives.join(exact, "edit").select("word", "n", F.col("edit").alias("near"), "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms(word, form)``: the last of the chain. Each round doubles the steps taken."""
    steps = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        longer = steps.join(ahead, "root", "left")
        longer = checkpointed(longer.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        steps = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return steps


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SLICE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    vocabulary = written(count_words(docs, id_col, text_col), "vocabulary")
    pairs = near_pairs(vocabulary, most)
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    sides = pairs.select(both.alias("s")).select("s.*")
    # the largest count first, then the smallest word
    best = sides.groupBy("word", "n").agg(F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"), F.count("*").alias("n_near"))
    often = -F.col("best.m") >= RATIO * F.col("n")
    best = best.select("word", "n_near", F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.m")).alias("form_n"))
    best = written(best, "forms")
    last = roots(best.filter(F.col("form").isNotNull()))
    rows = vocabulary.join(best, "word", "left").join(last, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")


def variants_sql() -> str:
    """The same for a table ``documents``: CRC-32 byte by byte, near words by equal rests around a hole."""
    return f"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t FROM range(256) AS r(i)),
runs AS (SELECT key, run, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS key, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{00C0}}-\\x{{00FF}}]{{{SHORTEST},}}')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(key || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h FROM runs, crc),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % {EDITED} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {LEAST}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS MATERIALIZED (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
best AS MATERIALIZED (SELECT word, count(*) AS n_near, min(struct_pack(m := -other_n, w := other)) AS top, any_value(n) AS n FROM near GROUP BY word),
forms AS MATERIALIZED (SELECT word, n_near, CASE WHEN -top.m >= {RATIO} * n THEN top.w END AS form, CASE WHEN -top.m >= {RATIO} * n THEN -top.m END AS form_n FROM best),
walk AS (SELECT word, form AS at FROM forms WHERE form IS NOT NULL UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.at = forms.word WHERE forms.form IS NOT NULL),
roots AS (SELECT walk.word, walk.at AS root FROM walk LEFT JOIN forms ON walk.at = forms.word WHERE forms.form IS NULL)
SELECT words.word, form, coalesce(root, words.word) AS root, words.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM words LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)
"""
