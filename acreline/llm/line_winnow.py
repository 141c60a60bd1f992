"""Line dedup by winnowing over line hashes.

A text is cut into units: lines, long lines at sentence ends, and sentences of more than ``WORDS`` words after
each word whose hash is below those of the ``NEAR`` words on both sides, so that a shared passage is cut at the
same words wherever it stands; pieces without such a word are cut after ``WORDS`` words. A gram is
``GRAM`` consecutive units. Of the grams of each shortest run of ``MIN_WORDS`` words the one with the smallest hash
(the last of equals) is kept as a fingerprint, so a run of ``MIN_WORDS`` words in whole units that two texts share
always has a common fingerprint (immediate repeats counted once). Texts with fewer words are one window.

Fingerprints that occur twice or more are joined with their first occurrence in corpus order (id, then
row, then place), never with each other, so a group of n occurrences gives n - 1 pairs. Pairs on one
diagonal of the same two texts are one candidate; there the match is extended both ways to its full length,
unit by unit. Runs that touch are merged, and the later run is deleted when it has ``MIN_WORDS`` words or
more. Every deleted unit has an equal unit earlier in the corpus, so a first occurrence always stays.
Immediate repeats of a unit count as a run of their own and are taken out before the grams are made.

The texts are cut once, into a table of unit hashes and sizes; each step after that is a shuffle of narrow
rows and texts never move. A first text that very many others match makes a skewed join, which AQE splits.

Defined results: a null text stays null and an empty one empty; rows without id come last, rows with one id
in the order of their text's hash; of rows with one id and one text one stays; a text that is all repeats becomes empty; an empty table gives an
empty table; other columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acreline.llm.common import arrow_batches, checkpointed, free_name, texts, written

WORDS, NEAR, GRAM, MIN_WORDS = 16, 2, 2, 30
#: Code points that are cut at a time, and bytes of texts that a task hands over at a time.
GROUP = 1 << 18
BATCH_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: ASCII blanks and sentence ends by byte; other blanks become a space before the bytes are looked at.
_BLANK, _END = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_END[list(b".!?")] = True
_WIDE = re.compile("[^\\S\x00-\x7f]")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """base^0 to base^n; those of usual lengths are kept."""
    held = _POWERS.get(int(base), np.zeros(0, np.uint64))
    if len(held) <= n:
        held = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(max(n, GROUP), base, np.uint64))))
        if n <= 2 * GROUP:
            _POWERS[int(base)] = held
    return held[: n + 1]


def _word_hashes(b: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each word [start, stop) of the bytes: the sum of byte hashes times powers of a base, from its first byte on."""
    out = np.zeros(len(start), np.uint64)
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(start, start[at] + GROUP)))
        low, size = int(start[at]), int(stop[upto - 1] - start[at])
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b[low : low + size]] * _powers(size, _BASE)[:size])))
        first, last = start[at:upto] - low, stop[at:upto] - low
        out[at:upto] = (total[last] - total[first]) * _powers(size, _BACK)[first]
        at = upto
    return _mixed(out + (stop - start).astype(np.uint64))


def _cut_places(h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Words (in ``h``, the words of all sentences) after which the long sentences [start, stop) are cut: those of locally
    smallest hash, and each ``WORDS``th word since the last cut."""
    sentence = np.repeat(np.arange(len(start)), stop - start)
    at = np.arange(len(sentence)) + np.repeat(start - np.concatenate(([0], np.cumsum(stop - start)[:-1])), stop - start)
    x, low = h[at], np.ones(len(at), bool)
    for d in range(1, NEAR + 1):
        same = sentence[d:] == sentence[:-d]
        low[d:] &= ~same | (x[d:] < x[:-d])
        low[:-d] &= ~same | (x[:-d] < x[d:])
    begins = np.zeros(len(h) + 1, bool)
    for places in (at[low] + 1, start, stop):
        begins[places] = True
    cut = np.flatnonzero(begins)  # pieces so far begin here
    # pieces lie inside one sentence, or between two; only those inside are cut again
    size = np.diff(cut)
    inside = np.searchsorted(start, cut[:-1], "right") - 1
    extra = np.where((inside >= 0) & (cut[:-1] < stop[np.maximum(inside, 0)]), (size - 1) // WORDS, 0)
    more = np.repeat(cut[:-1], extra) + (np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1) * WORDS
    begins[more] = True
    return np.flatnonzero(begins)


def _plain(text: str) -> bytes:
    """UTF-8 with blanks beyond ASCII as spaces: as many code points, the same words."""
    return (_WIDE.sub(" ", text) if not text.isascii() else text).encode()


def _unit_sizes(rows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all words, words of each unit, code points of each unit, units of each text), all texts at once.

    A word is a run of other bytes than blanks, cut where a sentence ends inside. A sentence begins with a text, behind a
    sentence end, and behind blanks with a line feed.
    """
    data = list(map(_plain, rows))
    size = np.fromiter(map(len, data), np.int64, len(data))
    begin = np.concatenate(([0], np.cumsum(size)))
    b = np.frombuffer(b"".join(data), np.uint8)
    del data
    solid = ~_BLANK[b]
    edge = np.zeros(len(b) + 1, bool)
    edge[begin] = True
    before = np.concatenate(([False], solid[:-1])) if len(b) else solid
    first = np.flatnonzero(solid & (~before | edge[:-1]))
    last = np.flatnonzero(solid & (np.concatenate((~solid[1:], [True])) | edge[1:])) + 1 if len(b) else first
    end = _END[b]
    behind = np.concatenate(([False], end[:-1])) if len(b) else end
    inside = solid & ~end & behind & before & ~edge[:-1]
    opens = np.zeros(len(b) + 1, bool)
    opens[first] = True
    start = np.flatnonzero(opens[:-1] | inside)
    word = np.cumsum(opens[start]) - 1  # the run of solid bytes that a word lies in
    stop = last[word] if len(start) else start
    same = np.flatnonzero(~opens[start[1:]]) if len(start) else start
    stop[same] = start[same + 1]
    # where sentences begin
    text = np.searchsorted(begin, start, "right") - 1
    gap = np.maximum(np.concatenate(([0], last[:-1]))[word], begin[text]) if len(start) else start
    feeds = np.flatnonzero(b == 10)
    feed = np.searchsorted(feeds, start) > np.searchsorted(feeds, gap)
    ended = (gap > begin[text]) & end[np.maximum(gap - 1, 0)] if len(b) else feed
    begins = np.zeros(len(b) + 1, bool)
    begins[begin[:-1]] = True
    begins[start[~opens[start] | feed | ended]] = True
    sentence = np.flatnonzero(begins[:-1])
    words = np.bincount(np.searchsorted(sentence, start, "right") - 1, minlength=len(sentence))
    h = _word_hashes(b, start, stop)
    total = np.concatenate(([0], np.cumsum(words)))
    long = np.flatnonzero(words > WORDS)
    at = sentence
    word_at = total[:-1]
    if len(long):
        cut = _cut_places(h, total[long], total[long + 1])
        which = np.searchsorted(total[long], cut, "right") - 1
        cut = cut[(cut > total[long[which]]) & (cut < total[long[which] + 1])]
        order = np.argsort(np.concatenate([sentence, start[cut]]), kind="stable")
        at, word_at = np.concatenate([sentence, start[cut]])[order], np.concatenate([word_at, cut])[order]
    later = np.flatnonzero((b & 0xC0) == 0x80)  # bytes that begin no code point
    place = np.append(at, len(b))
    chars = np.diff(place - np.searchsorted(later, place))
    per_text = np.diff(np.searchsorted(at, begin))
    return h, np.diff(np.append(word_at, total[-1])), chars, per_text


def units(text: str) -> list[str]:
    """The text in units; joined they are the text again."""
    ends = np.cumsum(_unit_sizes([text])[2]).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _unit_hashes(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A hash of each unit's words, from the words' hashes: the sum of h_i B^i over the unit, its first power taken out."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(len(h), _BASE)[1:])))
    end = np.cumsum(words)
    start = end - words
    return _mixed((total[end] - total[start]) * _powers(len(h), _BACK)[start] + words.astype(np.uint64)).view(np.int64)


def squeezed(h: np.ndarray) -> np.ndarray:
    """Places of the units that do not repeat the unit before them."""
    return np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)


def winnow(h: np.ndarray, words: np.ndarray, per_text: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of squeezed hash sequences, one behind the other, ``per_text`` units each: gram hashes and their places
    in ``h``. A window is the grams of each shortest run of ``min_words`` words; a text with fewer words is one window."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    per_text = per_text[per_text > 0]
    stop = np.repeat(np.cumsum(per_text), per_text)
    start = stop - np.repeat(per_text, per_text)
    final = np.maximum(start, stop - GRAM)  # the last gram of the unit's text
    wide, at = h.view(np.uint64), np.arange(len(h))
    gram = wide * np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, GRAM):
        there = at + k < stop
        longer = (gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + wide[np.minimum(at + k, len(h) - 1)]
        gram = np.where(there, longer, gram)
    gram = (gram ^ (gram >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    total = np.concatenate(([0], np.cumsum(words)))
    whole = total[stop] - total[:-1] >= min_words
    first = at[(at <= final) & (whole | ((at == start) & ~whole))]
    # the last gram of the run that begins at a unit
    last = np.clip(np.searchsorted(total, total[first] + min_words) - GRAM, first, final[first])
    best, open_ = first.copy(), np.arange(len(first))
    for d in range(1, int((last - first).max()) + 1):
        open_ = open_[first[open_] + d <= last[open_]]
        there = first[open_] + d
        best[open_] = np.where(gram[there] <= gram[best[open_]], there, best[open_])
    taken = np.zeros(len(h), bool)
    taken[best] = True
    at = np.flatnonzero(taken)
    return gram[at].view(np.int64), at


_CUT = pa.struct([("h", pa.list_(pa.int64())), ("chars", pa.list_(pa.int32())), ("words", pa.list_(pa.int32())), ("g", pa.list_(pa.int64())), ("p", pa.list_(pa.int32()))])
_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_CUT = pa.struct([*_CUT, ("n_deleted", pa.int32()), ("deleted", _RANGES)])
_CUT_SCHEMA = """struct<h: array<bigint>, chars: array<int>, words: array<int>, g: array<bigint>, p: array<int>,
    n_deleted: int, deleted: array<struct<start: int, stop: int>>>"""


def _lists(values: np.ndarray, per_text: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per_text))), pa.int32()), pa.array(values, kind))


def _cut(rows: list[str], min_words: int = MIN_WORDS) -> pa.Array:
    """For each text: hash, code points and words of each unit; fingerprints and their places among squeezed units; what
    goes if no other text matches."""
    word_hashes, words, chars, per_text = _unit_sizes(rows)
    h = _unit_hashes(word_hashes, words)
    text = np.repeat(np.arange(len(rows)), per_text)
    begins = np.concatenate(([0], np.cumsum(per_text)))
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    squeezed_of = np.bincount(text[new], minlength=len(rows))
    g, at = winnow(h[new], words[new], squeezed_of, min_words)
    of = text[new][at]
    place = at - np.concatenate(([0], np.cumsum(squeezed_of)))[of]
    # only texts with a unit twice can lose something by themselves
    order = np.lexsort((h, text))
    twice = np.unique(text[order][1:][(h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])]).tolist()
    alone = [{"n_deleted": 0, "deleted": []}] * len(rows)
    for k in twice:
        a, b = begins[k], begins[k + 1]
        alone[k] = _judged(h[a:b], chars[a:b], words[a:b], [], min_words)
    prints = np.bincount(of, minlength=len(rows))
    columns = [_lists(h, per_text, pa.int64()), _lists(chars, per_text, pa.int32()), _lists(words, per_text, pa.int32())]
    columns += [_lists(g, prints, pa.int64()), _lists(place, prints, pa.int32()), pa.array([x["n_deleted"] for x in alone], pa.int32())]
    return pa.StructArray.from_arrays([*columns, pa.array([x["deleted"] for x in alone], _RANGES)], fields=list(_CUT))


def _grouped(column: pa.Array) -> Iterator[list[str]]:
    """The texts in lists of about ``GROUP`` code points, a longer text alone."""
    group, size = [], 0
    for text in texts(column):
        if group and size + len(text) > GROUP:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def matched_runs(later: np.ndarray, first: np.ndarray, shift: int) -> list[tuple[int, int]]:
    """Runs of ``GRAM`` or more equal units on a diagonal: later[i] == first[i - shift]."""
    lo, hi = max(0, shift), min(len(later), len(first) + shift)
    if hi <= lo:
        return []
    same = np.concatenate(([0], (later[lo:hi] == first[lo - shift : hi - shift]).astype(np.int8), [0]))
    turn = np.diff(same)
    starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    short = min(GRAM, len(later), len(first))
    return [(lo + a, lo + b) for a, b in zip(starts.tolist(), ends.tolist()) if b - a >= short]


def deleted_units(h: np.ndarray, words: np.ndarray, runs: list[tuple[int, int]], min_words: int) -> np.ndarray:
    """Which units go. ``runs`` are in squeezed places; immediate repeats join the run they follow."""
    place = squeezed(h)
    gone = np.ones(len(h), bool)
    gone[place] = False  # immediate repeats
    ends = np.append(place[1:], len(h)) if len(place) else place
    for a, b in runs:
        gone[place[a] : ends[b - 1]] = True
    total = np.concatenate(([0], np.cumsum(words)))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if total[b] - total[a] < min_words:
            gone[a:b] = False
    return gone


def _judged(h: np.ndarray, chars: np.ndarray, words: np.ndarray, runs: list[tuple[int, int]], min_words: int) -> dict:
    gone = deleted_units(h, words, runs, min_words)
    border = np.concatenate(([0], np.cumsum(chars)))
    edge = border[np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))].tolist()
    return {"n_deleted": int(gone.sum()), "deleted": [{"start": a, "stop": b} for a, b in zip(edge[::2], edge[1::2])]}


_FOUND = pa.struct([("n_deleted", pa.int32()), ("deleted", _RANGES)])
_FOUND_SCHEMA = "struct<n_deleted: int, deleted: array<struct<start: int, stop: int>>>"
_NUMPY = {"zero_copy_only": False}


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, digest, n_units, n_deleted, deleted, sources) per row: the ranges of code points to delete, and
    the ids of the texts in which the matched runs occur first. ``digest`` is the hash of the text.

    Rows with one id and one text are one text here; ``dedup_lines`` tells the copies apart.
    """

    @F.arrow_udf(_CUT_SCHEMA)
    def cut(column: pa.Array) -> pa.Array:
        return pa.concat_arrays([_cut(group, min_words) for group in _grouped(column)] or [pa.array([], _CUT)])

    laid = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), cut(F.col(text_col)).alias("cut"))
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        laid = written(laid.select("id", "digest", "cut.*"), "winnow")
    place = F.explode(F.arrays_zip("g", "p")).alias("x")
    prints = laid.select("id", "digest", place).select("x.g", "id", "digest", F.col("x.p").alias("at"))
    order = F.struct(F.col("id").isNull().alias("lone"), "id", "digest", "at")
    again = prints.groupBy("g").count().filter("count > 1").select("g")
    again = written(prints.join(again, "g"), "winnow")  # few of all fingerprints
    firsts = again.groupBy("g").agg(F.min(order).alias("first"))
    later = again.join(firsts, "g").filter(order > F.col("first"))
    pairs = later.groupBy("id", "digest", F.col("first.id").alias("first_id"), F.col("first.digest").alias("first_digest"))
    pairs = pairs.agg(F.collect_set(F.col("at") - F.col("first.at")).alias("shifts"))  # its diagonals
    pairs = checkpointed(pairs.withColumn("pair", F.monotonically_increasing_id()))

    # one row a text; texts under one id that are equal are rare, so the plan looks for them first
    one = laid
    if not laid.groupBy("id", "digest").count().filter("count > 1").isEmpty():
        one = written(laid.dropDuplicates(["id", "digest"]), "winnow")
    # the hashes of both texts of a pair, from one shuffle of the texts' hashes
    first = F.struct("pair", F.lit(True).alias("first"), F.col("first_id").alias("i"), F.col("first_digest").alias("d"))
    own = F.struct("pair", F.lit(False).alias("first"), F.col("id").alias("i"), F.col("digest").alias("d"))
    sides = pairs.select(F.inline(F.array(first, own)))
    hashes = one.select("id", "digest", "h").join(sides, F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")))
    hashes = hashes.groupBy("pair").agg(F.sort_array(F.collect_list(F.struct("first", "h"))).alias("both"))
    pairs = pairs.join(hashes, "pair").select("id", "digest", "first_id", "shifts", F.col("both")[0]["h"].alias("h"), F.col("both")[1]["h"].alias("other"))

    @F.arrow_udf("array<struct<a: int, b: int>>")
    def runs(shifts: pa.Array, later: pa.Array, first: pa.Array) -> pa.Array:
        out = []
        for s, x, y in zip(shifts, later, first):
            x, y = x.values.to_numpy(**_NUMPY), y.values.to_numpy(**_NUMPY)
            x, y = x[squeezed(x)], y[squeezed(y)]
            out.append([{"a": a, "b": b} for k in s.as_py() for a, b in matched_runs(x, y, k)])
        return pa.array(out, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))

    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d"))
    spans = pairs.select("id", "digest", "first_id", F.explode(runs("shifts", "h", "other")).alias("s"))
    spans = spans.groupBy(F.col("id").alias("i"), F.col("digest").alias("d")).agg(
        F.collect_set("s").alias("s"), F.array_sort(F.collect_set("first_id")).alias("sources")
    )

    @F.arrow_udf(_FOUND_SCHEMA)
    def judge(h: pa.Array, chars: pa.Array, words: pa.Array, found: pa.Array) -> pa.Array:
        rows = []
        for *arrays, s in zip(h, chars, words, found):
            x, c, w = (a.values.to_numpy(**_NUMPY) for a in arrays)
            rows.append(_judged(x, c, w, [(y["a"], y["b"]) for y in s.as_py()], min_words))
        return pa.array(rows, _FOUND)

    judged = one.select("id", "digest", "h", "chars", "words").join(spans, same)
    judged = judged.select("i", "d", judge("h", "chars", "words", "s").alias("f"), "sources")
    joined = laid.select("id", "digest", F.size("h").alias("n_units"), "n_deleted", "deleted").join(judged, same, "left")
    deleted = F.coalesce("f.deleted", "deleted")
    sources = F.when(F.size(deleted) > 0, F.coalesce("sources", F.array().cast(spans.schema["sources"].dataType))).otherwise(F.array())
    return joined.select("id", "digest", "n_units", F.coalesce("f.n_deleted", "n_deleted").alias("n_deleted"), deleted.alias("deleted"), sources.alias("sources"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with the repeated runs cut out. Of rows with one id and one text the first keeps what the
    others lose; whether they lose anything depends on ``min_words`` too."""
    digest, many = free_name(docs, "__digest"), free_name(docs, "__copy")
    found = find_repeats(docs, id_col, text_col, min_words).dropDuplicates(["id", "digest"])
    found = found.select(F.struct("id", "digest", "deleted").alias(many))
    laid = docs.withColumn(digest, F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(F.col(f"{many}.id")) & (F.col(digest) == F.col(f"{many}.digest"))
    copy = F.row_number().over(W.partitionBy(id_col, digest).orderBy(digest))
    joined = laid.join(found, same)
    nth = free_name(docs, "__nth")
    joined = joined.withColumn(nth, copy)

    @F.arrow_udf("string")
    def cut(column: pa.Array, ranges: pa.Array, copy: pa.Array) -> pa.Array:
        rows = []
        for x, r, n in zip(column, ranges, copy):
            t, r = x.as_py(), r.as_py()
            if t is None:
                rows.append(None)
            elif n.as_py() > 1 and len(t.split()) >= min_words:
                rows.append("")
            else:
                stops = [0, *(y["stop"] for y in r)]
                rows.append("".join(t[a:b] for a, b in zip(stops, [*(y["start"] for y in r), len(t)])))
        return pa.array(rows, pa.string())

    clean = cut(F.col(text_col), F.col(f"{many}.deleted"), F.col(nth)).alias(text_col)
    return joined.select(*(clean if c == text_col else F.col(c) for c in docs.columns))
