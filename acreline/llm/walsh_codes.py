"""Vector codes by product quantisation, searched exactly in the Walsh-Hadamard domain of integers.

A component x becomes the integer floor(SCALE * x), a vector is cut into ``parts`` equal consecutive parts, and each
part position has a codebook that is refined by rounds of nearest-entry assignment and floored means.

The nearest entry is found without floating point. A part and the entries are padded with zeros to a power of two m
and taken through the Walsh-Hadamard transform H, which keeps integers: |Hx - Hy|^2 = m |x - y|^2. The transform's
rows are put in sequency order (number of sign changes), where smooth parts have their weight first. The entry that is
nearest in the first coefficient gives a bound; squared differences are then added up coefficient by coefficient, and an
entry goes as soon as its sum passes the bound. Sums that equal the bound stay to the end, so ties go to the lowest index.

A round is one pass over the vectors: each task adds up its parts by (position, entry), Spark adds up the tasks, and
``parts`` x ``entries`` sums, a fixed number, reach the driver. Codebooks travel with the job; vectors stay in place.

Defined results: a row whose vector is null, or holds null, NaN or an infinity, is dropped. Vectors of unequal length
count as padded with zeros to the longest, and that length to a multiple of ``parts``. Codebooks start from the smallest
ids, null ids last, equal ids by their components; fewer rows than entries give fewer entries. Repeated rows are coded
one by one, null labels are one group, other columns take no part, an empty table gives an empty table. Arithmetic is
exact for every size: integers above 2^26 / m go through Python's own. A component of 2^50 or more, or a squared distance
that fits no long, is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.llm.common import written

SCALE = 4096
#: Components from here on are refused.
LARGEST = 1 << 50
#: Parts searched at a time.
BLOCK = 1 << 14


def sequency(m: int) -> np.ndarray:
    """Rows of the Walsh-Hadamard matrix of order m, a power of two, by their number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < m:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1))]


def _transformed(x: np.ndarray, walsh: np.ndarray) -> np.ndarray:
    """Rows of x, padded with zeros, through the transform: sums and differences only, in x's own integers."""
    out = np.zeros((len(x), len(walsh)), x.dtype)
    for j in range(x.shape[1]):
        out = out + x[:, j : j + 1] * walsh[:, j].astype(x.dtype)
    return out


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are where every step fits 64 bits, else as Python integers."""
    width = max(1, arrays[0].shape[-1])
    m = 1 << (width - 1).bit_length()
    top = max((max(int(a.max()), -int(a.min())) for a in arrays if a.size), default=0)
    # |Hx - Hy| <= 2 m top, and m of its squares are added up
    return [a.astype(np.int64 if 4 * m**3 * top * top < 1 << 62 else object) for a in arrays]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: lowest) and the squared distance to it, for each row of x."""
    x, entries = _exact(x, entries)
    walsh = sequency(1 << max(0, x.shape[1] - 1).bit_length())
    m = len(walsh)
    c = _transformed(entries, walsh)
    which, far = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    for at in range(0, len(x), BLOCK):
        t = _transformed(x[at : at + BLOCK], walsh)
        first = (t[:, :1] - c[None, :, 0]) ** 2
        guess = first.argmin(axis=1) if first.dtype != object else np.array([min(range(len(c)), key=r.__getitem__) for r in first])
        bound = ((t - c[guess]) ** 2).sum(axis=1)
        row, entry = np.nonzero(first <= bound[:, None])
        total = first[row, entry]
        for s in range(1, m):
            total = total + (t[row, s] - c[entry, s]) ** 2
            alive = np.asarray(total <= bound[row], bool)
            row, entry, total = row[alive], entry[alive], total[alive]
        # rows are in order and each has its guess at least; within a row entries rise, so the first of the least wins
        order = np.lexsort((entry, total, row)) if total.dtype != object else sorted(range(len(row)), key=lambda i: (row[i], total[i], entry[i]))
        order = np.asarray(order, np.int64)
        lead = order[np.concatenate(([True], row[order][1:] != row[order][:-1]))] if len(order) else order
        which[at : at + BLOCK], far[at : at + BLOCK] = entry[lead], total[lead]
    return which, far // m


@dataclass(frozen=True)
class Codebooks:
    """``entries[p]``: integer rows of part position p."""

    entries: list[list[list[int]]]

    def sha256(self) -> str:
        numbers = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def arrays(self) -> list[np.ndarray]:
        return [np.array(part, object).reshape(len(part), -1) for part in self.entries]


def integer_vectors(rows: DataFrame, vec_col: str, *columns: str) -> DataFrame:
    """``columns`` and the integers ``v`` of the rows whose vector is whole."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda a: a.isNull() | F.isnan(a) | (F.abs(a) == float("inf")))
    large = F.exists(x, lambda a: F.abs(a) >= float(LARGEST))
    v = F.when(large, F.raise_error(F.lit(f"{vec_col}: a component of 2^50 or more")).cast("array<long>"))
    v = v.otherwise(F.transform(x, lambda a: F.floor(a * SCALE).cast("long")))
    return rows.filter(x.isNotNull() & ~bad).select(*columns, v.alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of ``width``, zeros behind."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat
    return out


def _codes(column: pa.Array, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matrix, codes, squared distances by part) of a batch."""
    wide = books[0].shape[1]
    x = _matrix(column, wide * len(books))
    found = [nearest(x[:, p * wide : (p + 1) * wide], book) for p, book in enumerate(books)]
    return x, np.stack([f[0] for f in found], axis=1), np.stack([f[1].astype(object) for f in found], axis=1)


SUMS = "part int, entry int, place int, n long, total decimal(38,0)"


def _sums(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts and component sums by (part, entry) of a whole task."""
    wide, most = books[0].shape[1], max(map(len, books))
    n = np.zeros((len(books), most), np.int64)
    total = np.zeros((len(books), most, wide), object)
    for batch in batches:
        x, codes, _ = _codes(batch.column(0), books)
        for p in range(len(books)):
            n[p] += np.bincount(codes[:, p], minlength=most)
            part = x[:, p * wide : (p + 1) * wide]
            # 2^20 rows of two halves of 31 bits never pass 64 bits
            for half, weight in ((part >> 31, 1 << 31), (part & 0x7FFFFFFF, 1)):
                for at in range(0, len(part), 1 << 20):
                    add = np.zeros((most, wide), np.int64)
                    np.add.at(add, codes[at : at + (1 << 20), p], half[at : at + (1 << 20)])
                    total[p] += add.astype(object) * weight
    p, e = np.nonzero(n)
    rows = [(int(a), int(b), j, int(n[a, b]), total[a, b, j] if wide else 0) for a, b in zip(p, e) for j in range(max(1, wide))]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    from decimal import Decimal

    columns.append(pa.array([Decimal(int(r[4])) for r in rows], pa.decimal128(38, 0)))
    yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "place", "n", "total"])


def first_codebooks(vectors: DataFrame, id_col: str, parts: int, entries: int) -> Codebooks:
    """The parts of the ``entries`` smallest ids' vectors; ``vectors`` has ``id_col`` and ``v``."""
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    wide = -(-width // parts)
    rows = vectors.orderBy(F.col(id_col).asc_nulls_last(), "v").limit(entries).collect()  # a fixed number of rows
    padded = [list(r["v"]) + [0] * (wide * parts - len(r["v"])) for r in rows]
    return Codebooks([[v[p * wide : (p + 1) * wide] for v in padded] for p in range(parts)])


def refined(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part to its nearest entry, every entry to the floored mean of its parts."""
    arrays = books.arrays()
    partial = vectors.select("v").mapInArrow(lambda batches: _sums(batches, arrays), SUMS)
    added = partial.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    entries = [[list(e) for e in part] for part in books.entries]
    for r in added:
        if entries[r["part"]][r["entry"]]:
            entries[r["part"]][r["entry"]][r["place"]] = int(r["total"]) // r["n"]
    return Codebooks(entries)


def fit_codebooks(vectors: DataFrame, id_col: str, parts: int = 8, entries: int = 16, rounds: int = 6) -> Codebooks:
    books = first_codebooks(vectors, id_col, parts, entries)
    if not books.entries[0]:
        return books
    for _ in range(rounds):
        books = refined(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vectors`` with ``code`` (two hex digits a part) and ``error`` (squared distances, added up) for ``v``."""
    arrays = books.arrays()

    @F.arrow_udf("struct<code: string, error: long>")
    def codes(column: pa.Array) -> pa.Array:
        _, code, far = _codes(column, arrays)
        digits = [row.tobytes().hex() for row in code.astype(np.uint8)]
        return pa.StructArray.from_arrays([pa.array(digits, pa.string()), pa.array(far.sum(axis=1).tolist(), pa.int64())], ["code", "error"])

    rest = [c for c in vectors.columns if c != "v"]
    return vectors.select(*rest, codes("v").alias("c")).select(*rest, "c.code", "c.error")


def compress(
    rows: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6
) -> tuple[DataFrame, Codebooks]:
    """(id, label, code, error, label_error) of every whole vector, and the codebooks."""
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    named = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("x"))
    vectors = written(integer_vectors(named, "x", "id", "label"), "vectors")
    books = fit_codebooks(vectors, "id", parts, entries, rounds)
    if not books.entries[0]:
        none = vectors.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none.withColumn("label_error", F.col("error")), books
    coded = written(encode(vectors, books), "codes")
    by_label = coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("l"))).drop("l"), books


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same for vectors of one length that ``parts`` divides, by plain squared differences: rounds written out one after another."""
    ctes = [
        f"""k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))""",
        f"""parted AS MATERIALIZED (SELECT r, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x FROM k, range({parts}) AS t(p))""",
        f"c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parted WHERE r <= {entries})",
    ]
    far = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for i in range(rounds + 1):
        # the least of distance * entries + entry has the lowest index among the nearest
        near = f"SELECT r, parted.p, min(CAST({far} AS HUGEINT) * {entries} + e) AS least FROM parted JOIN c{i} ON parted.p = c{i}.p GROUP BY ALL"
        ctes.append(f"a{i} AS MATERIALIZED (SELECT r, p, least % {entries} AS e, least // {entries} AS d FROM ({near}))")
        if i < rounds:
            one = "SELECT p, e, unnest(x) AS y, unnest(range(1, len(x) + 1)) AS j FROM a{0} JOIN parted USING (r, p)".format(i)
            floored = "CAST((sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
            mean = f"SELECT p, e, list(y ORDER BY j) AS c FROM (SELECT p, e, j, {floored} AS y FROM ({one}) GROUP BY p, e, j) GROUP BY p, e"
            ctes.append(f"c{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN ({mean}) AS m USING (p, e))")
    return f"""
WITH {", ".join(ctes)},
coded AS (SELECT r, string_agg(printf('%02x', CAST(e AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
books AS (SELECT sha256(coalesce(string_agg(array_to_string(c, ','), ',' ORDER BY p, e), '')) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN coded USING (r), books
"""
