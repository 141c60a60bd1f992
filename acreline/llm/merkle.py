"""Document fingerprints: a Merkle tree over blocks, paragraphs and sections. DataFrame functions only.

A paragraph is a line of the text; it is cut into blocks at sentence ends and after ``BLOCK`` code points
without one, so a change inside a sentence touches the blocks of that sentence only. A section is a run
of ``SECTION`` paragraphs. Every digest is a whole md5, each node the digest of its children's digests.

``as_text`` is the tree as root|sections|paragraphs|blocks, all with their whole digests. Equal texts have equal roots,
and trees with different roots are compared branch by branch: a branch that both have is done, and
only the blocks below the others are looked at. The likeness of two trees is the share of their
distinct blocks that both have (Jaccard), 1 for equal roots.

Defined results: a null text is an empty text; an empty text has one empty paragraph and no block, and its
likeness to any other text is 0; very long texts stay one row; repeated rows have the same tree.

``with_next`` gives every row the row with the next key in ascending order, null first, and the first row
after the last. Rows with equal keys follow each other in the order of their text. The order is global but
no task holds it: rows go to key ranges between quantiles, and each range's first row is sent to the
range before it as well. The keys are expected to name documents; a key on very many rows makes a long
range, which sorts and spills but is not split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acreline.llm.common import claim, free_name

BLOCK, SECTION = 48, 4
BLOCKS = f"[^\\n.!?]{{1,{BLOCK}}}[.!?]*|[.!?]+"
#: Rows of a key range, and the most ranges.
RANGE, RANGES = 2_000, 1 << 16


def _above(nodes: Column) -> Column:
    return F.md5(F.array_join(nodes, ","))


def _sections(paragraphs: Column) -> Column:
    firsts = F.sequence(F.lit(1), F.size(paragraphs), F.lit(SECTION))
    return F.transform(firsts, lambda i: _above(F.slice(paragraphs, i, F.lit(SECTION))))


def fingerprints(df: DataFrame, text: Column, out: str) -> DataFrame:
    """``df`` plus ``out``, a free name: struct<root, sections, paragraphs, leaves>, leaves being an array per paragraph."""
    claim(df, out)
    a, b, c = (free_name(df, f"__{x}") for x in ("leaves", "paragraphs", "sections"))
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    df = df.withColumn(a, F.transform(lines, lambda p: F.transform(F.regexp_extract_all(p, F.lit(BLOCKS), F.lit(0)), F.md5)))
    df = df.withColumn(b, F.transform(a, _above))
    df = df.withColumn(c, _sections(F.col(b)))
    root = _above(F.col(c))
    node = F.struct(root.alias("root"), F.col(c).alias("sections"), F.col(b).alias("paragraphs"), F.col(a).alias("leaves"))
    return df.withColumn(out, node).drop(a, b, c)


def as_text(t: str) -> Column:
    parts = [F.array_join(x, ",") for x in (F.col(f"{t}.sections"), F.col(f"{t}.paragraphs"), F.flatten(f"{t}.leaves"))]
    return F.concat_ws("|", f"{t}.root", *parts)


def likeness(one: str, two: str) -> Column:
    """Share of the distinct blocks of two trees that both have, in [0, 1]."""
    a, b = F.flatten(f"{one}.leaves"), F.flatten(f"{two}.leaves")
    shared = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    same = F.col(f"{one}.root") == F.col(f"{two}.root")
    return F.when(same, 1.0).when(union == 0, 0.0).otherwise(shared.cast("double") / union)


def edits(one: str, two: str) -> Column:
    """The paragraphs (numbers from 0) of ``one`` that ``two`` has nowhere: sections that both have are
    passed over whole, then paragraphs by their digests."""
    indexed = F.transform(f"{one}.paragraphs", lambda p, i: F.struct(i.alias("i"), p.alias("p")))

    def changed(x: Column) -> Column:
        section = F.element_at(F.col(f"{one}.sections"), (F.floor(x["i"] / SECTION) + 1).cast("int"))
        return ~F.array_contains(F.col(f"{two}.sections"), section) & ~F.array_contains(F.col(f"{two}.paragraphs"), x["p"])

    return F.when(F.col(f"{one}.root") == F.col(f"{two}.root"), F.array().cast("array<int>")).otherwise(
        F.transform(F.filter(indexed, changed), lambda x: x["i"])
    )


def with_next(
    df: DataFrame, key: str, columns: list[str], tie: str, prepare: Callable[[DataFrame], DataFrame] = lambda x: x, rows_per_range: int = RANGE
) -> DataFrame:
    """``df`` plus a struct ``next`` of ``columns`` of the row that follows; key has to be a whole number.

    ``prepare`` adds columns where the rows of a range have met and are in order, so that they need no shuffle and no sort
    holds them; it has to keep the rows and their order. A column ``next`` in ``df`` is an error.
    """
    claim(df, "next")
    k, part, last = (free_name(df, f"__{x}") for x in ("key", "range", "copy"))
    low = -(2**63)
    keyed = df.withColumn(k, F.coalesce(F.col(key).cast("bigint"), F.lit(low)))
    n = keyed.count()
    if not n:
        return (df := prepare(df)).withColumn("next", F.struct(*columns))
    ranges = max(1, min(RANGES, -(-n // rows_per_range)))
    shares = [i / ranges for i in range(1, ranges)]
    found = keyed.agg(F.min(k).alias("low"), (F.percentile_approx(k, shares, max(10_000, 10 * ranges)) if shares else F.array().cast("array<bigint>")).alias("cuts")).first()
    starts = sorted({found["low"], *found["cuts"]})  # the first keys of the ranges: real keys, at most RANGES
    steps = [1 << b for b in reversed(range(len(starts).bit_length()))]
    table = F.array(*[F.lit(x).cast("bigint") for x in starts]) if len(starts) < 64 else F.from_json(F.lit(str(starts)), "array<bigint>")

    def jump(at: Column, s: Column) -> Column:
        there = at + s
        fits = (there <= F.lit(len(starts))) & (F.get(table, F.least(there, F.lit(len(starts))) - 1) <= F.col(k))
        return F.when(fits, there).otherwise(at)

    at = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), jump) - 1  # the last start that is not above the key
    laid = keyed.withColumn(part, at)
    begins = F.get(table, F.col(part)) == F.col(k)
    before = F.pmod(F.col(part) - 1, F.lit(len(starts)))
    here = F.struct(F.col(part).alias("r"), F.lit(0).alias("c"))
    ahead = F.struct(before.alias("r"), F.lit(1).alias("c"))
    copies = free_name(df, "__copies")
    laid = laid.withColumn(copies, F.explode(F.when(begins, F.array(here, ahead)).otherwise(F.array(here))))
    laid = laid.withColumn(part, F.col(f"{copies}.r")).withColumn(last, F.col(f"{copies}.c")).drop(copies)
    met = prepare(laid.repartition(part).sortWithinPartitions(part, last, k, tie))
    row = F.lead(F.struct(*columns)).over(W.partitionBy(part).orderBy(last, k, tie))
    return met.withColumn("next", row).filter(F.col(last) == 0).drop(k, part, last)


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by as many of the following text."""
    text, following = F.coalesce(text, F.lit("")), F.coalesce(following, F.lit(""))
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - quarter), F.substr(following, F.lit(1), quarter))


def merkle_sql() -> str:
    """The digest columns of the query for a table ``documents`` with unique, non-null doc_id."""

    def built(source: str, text: str, name: str) -> str:
        return f"""
{name}a AS (SELECT doc_id, list_transform(string_split({text}, chr(10)), lambda p: list_transform(
      regexp_extract_all(p, '[^\\n.!?]{{1,{BLOCK}}}[.!?]*|[.!?]+'), lambda x: md5(x))) AS leaves FROM {source}),
{name}b AS (SELECT *, list_transform(leaves, lambda x: md5(coalesce(array_to_string(x, ','), ''))) AS par FROM {name}a),
{name}c AS (SELECT *, list_transform(range(1, len(par) + 1, {SECTION}), lambda i: md5(array_to_string(list_slice(par, i, i + {SECTION - 1}), ','))) AS sec FROM {name}b),
{name} AS (SELECT doc_id, md5(array_to_string(sec, ',')) AS root, flatten(leaves) AS blocks,
      md5(array_to_string(sec, ',')) || '|' || array_to_string(sec, ',') || '|' || array_to_string(par, ',') || '|' || coalesce(array_to_string(flatten(leaves), ','), '') AS fp FROM {name}c)"""

    def like(x: str, y: str) -> str:
        union = f"len(list_distinct(list_concat({x}.blocks, {y}.blocks)))"
        shared = f"len(list_distinct(list_intersect({x}.blocks, {y}.blocks)))"
        return f"CASE WHEN {x}.root = {y}.root THEN 1.0::DOUBLE WHEN {union} = 0 THEN 0.0::DOUBLE ELSE {shared}::DOUBLE / {union} END"

    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS nt,
      coalesce(lead(doc_id) OVER (ORDER BY doc_id), first(doc_id) OVER (ORDER BY doc_id)) AS nid FROM d),
e AS (SELECT *, left(text, length(text) - length(text) // 4) || left(nt, length(text) // 4) AS et FROM n),{built("d", "text", "f")},{built("e", "et", "g")}
SELECT e.doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(et) AS edited_sha256, f.fp AS fingerprint, g.fp AS edited_fingerprint,
  {like("f", "g")} AS near_edited, {like("f", "h")} AS near_next
FROM e JOIN f ON e.doc_id = f.doc_id JOIN g ON e.doc_id = g.doc_id JOIN f h ON e.nid = h.doc_id"""
