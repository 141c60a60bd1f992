"""Mixing sources to target weights by hierarchical budgets. DataFrame functions only.

The sources are the leaves of a tree, such as domain, language, source. A token budget enters at the
root and is shared out level by level in proportion to the weights. A node cannot take more than the
tokens below it times the number of epochs allowed; what it cannot take goes to its siblings first, in
proportion to their weights, and only what a whole family cannot take reaches the family's own
siblings. All sums are whole tokens; the rest of a division goes to the largest remainders.

A leaf with budget b and T tokens gives b div T whole epochs and a token prefix of the next: its texts in
the order of a seeded hash, a new order each epoch, up to the text in which the remaining tokens end.

Counts per leaf decide the budgets, counts per leaf and hash bucket the prefixes, and counts inside that
bucket narrow it down once more. Only the texts in the one fine bucket of a leaf where its prefix ends are
ordered row by row; no window holds a leaf, and a text is only shuffled if it lies in such a bucket.

Defined results: a null level is a node named ''; a null text has no tokens; a leaf without tokens
gives nothing; texts without words are taken where they stand before the end of the prefix; a null id
is ordered as ''; equal ids are ordered by text; a budget above what all leaves can give takes all they
can give; a missing weight is 1; empty tables give empty tables; other columns stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acreline.llm.common import checkpointed, claim, free_name, written

WORD = "[^\\x20\\x09-\\x0D]+"
#: Hexadecimal digits of the order hash by which the end of a prefix is looked for, one step after the
#: other: 4,096 buckets a leaf, then 4,096 inside the one that holds the end.
DIGITS = (3, 6)
#: Leaves whose plan is broadcast.
SENT = 50_000


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def order_hash(doc_id: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def share_out(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Water filling in whole tokens: ``nodes`` (parent, name, cap, weight, budget of the parent) plus
    ``given``. Nodes are taken by rising cap/weight; the first that can take its share fixes the level
    for the rest. Weights are whole numbers and budget x sum of weights has to stay below 2^63."""
    family = W.partitionBy(*parent)
    order = family.orderBy(F.col("cap") / F.col("weight"), name)
    until = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    nodes = nodes.withColumns(
        {
            "left_": F.col("budget") - (F.sum("cap").over(until) - F.col("cap")),
            "weights_": F.sum("weight").over(family) - F.sum("weight").over(until) + F.col("weight"),
        }
    )
    nodes = nodes.withColumn("full_", F.col("cap") * F.col("weights_") <= F.col("weight") * F.col("left_"))
    nodes = nodes.withColumns(
        {
            "pool_": F.col("budget") - F.sum(F.when(F.col("full_"), F.col("cap")).otherwise(0)).over(family),
            "open_": F.sum(F.when(F.col("full_"), 0).otherwise(F.col("weight"))).over(family),
        }
    )
    product = F.col("pool_") * F.col("weight")
    nodes = nodes.withColumns(
        {
            "given": F.when(F.col("full_"), F.col("cap")).otherwise(F.expr("(pool_ * weight) div open_")),
            "rest_": F.when(F.col("full_"), F.lit(-1)).otherwise(product % F.col("open_")),
        }
    )
    spare = F.least("budget", F.sum("cap").over(family)) - F.sum("given").over(family)
    place = F.row_number().over(family.orderBy(F.desc("rest_"), name))
    nodes = nodes.withColumn("spare_", spare).withColumn("place_", place)
    nodes = nodes.withColumn("given", F.col("given") + ((F.col("rest_") >= 0) & (F.col("place_") <= F.col("spare_"))).cast("bigint"))
    return nodes.drop("left_", "weights_", "full_", "pool_", "open_", "rest_", "spare_", "place_")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: Column, max_epochs: int) -> DataFrame:
    """``leaves`` (levels, tokens) plus ``given``. ``weights[level][name]`` are whole numbers."""
    all_leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    current = all_leaves.agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    current = current.select(F.lit(0).alias("root_"), F.least(budget, "cap").cast("bigint").alias("given"))
    for k, level in enumerate(levels):
        path, parent = list(levels[: k + 1]), list(levels[:k])
        nodes = all_leaves.withColumn("root_", F.lit(0)).groupBy("root_", *path).agg(F.sum("cap").alias("cap"))
        known = weights.get(level, {})
        weight = F.lit(1)
        if known:
            cells = [F.lit(x) for item in known.items() for x in item]
            weight = F.coalesce(F.element_at(F.create_map(*cells), F.col(level)), F.lit(1))
        nodes = nodes.withColumn("weight", weight.cast("bigint"))
        parents = current.select("root_", *parent, F.col("given").alias("budget"))
        nodes = nodes.join(parents, ["root_", *parent])
        current = checkpointed(share_out(nodes, ["root_", *parent], level).select("root_", *path, "given"))
    return leaves.join(current.drop("root_"), list(levels))


def select_mix(
    docs: DataFrame,
    levels: Sequence[str] = ("domain", "lang", "source"),
    weights: Mapping[str, Mapping[str, int]] | None = None,
    share: str = "1",
    max_epochs: int = 1,
    seed: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "mix",
) -> DataFrame:
    """The chosen rows, one per epoch, plus a struct column ``out``: leaf names, epoch, tokens of the
    text (null inside a whole epoch, where nothing depends on it), tokens used of it.

    The budget is ``share`` (a fraction or decimal as text) of all tokens of ``docs``. A column ``out`` in ``docs`` is an error.
    """
    claim(docs, out)
    part = Fraction(share)
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"n{k}") for k, c in enumerate(levels)]
    path = [f"n{k}" for k in range(len(levels))]
    kinds = {f"n{k}": (weights or {}).get(c, {}) for k, c in enumerate(levels)}
    rows = written(docs.select(*names, F.col(id_col).cast("string").alias("id"), token_count(F.col(text_col)).alias("tokens")), "mix")
    leaves = checkpointed(rows.groupBy(*path).agg(F.sum("tokens").alias("tokens")))
    budget = F.expr(f"CAST(tokens AS DECIMAL(38,0)) * {part.numerator} div {part.denominator}")
    budgets = leaf_budgets(leaves.filter("tokens > 0"), path, kinds, budget, max_epochs)
    plan = budgets.select(*path, F.expr("given div tokens").alias("whole"), (F.col("given") % F.col("tokens")).alias("rest"))
    plan = checkpointed(plan)
    # a row a leaf: sent to the texts while small, else a join whose hot leaves AQE splits
    near = F.broadcast if plan.count() <= SENT else lambda x: x

    # where each leaf's prefix ends: the bucket, and the tokens before it
    ends = plan.filter("rest > 0").select(*path, "whole", "rest", F.lit("").alias("bucket"), F.lit(0).cast("bigint").alias("start"))
    h = order_hash(F.col("id"), F.col("whole"), seed)
    upto = W.partitionBy(*path).orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    for digits in DIGITS:
        cells = rows.join(near(ends), path).filter(h.startswith(F.col("bucket")))
        cells = cells.groupBy(*path, "whole", "rest", "start", F.substring(h, 1, digits).alias("bucket")).agg(F.sum("tokens").alias("n"))
        cells = cells.withColumn("start", F.col("start") + F.sum("n").over(upto) - F.col("n"))
        cells = cells.filter("start < rest AND start + n >= rest").groupBy(*path, "whole", "rest")
        ends = checkpointed(cells.agg(F.min("bucket").alias("bucket"), F.min_by("start", "bucket").alias("start")))
    plan = checkpointed(plan.join(ends.select(*path, "bucket", "start"), path, "left"))

    mine, leaf = free_name(docs, "__row"), free_name(docs, "__leaf")
    here = docs.withColumn(leaf, F.struct(*names))
    other = free_name(docs, "__other")
    plan = plan.select(F.struct(*path).alias(other), F.struct("whole", "rest", "bucket", "start").alias(mine))
    here = here.join(near(plan), F.col(leaf) == F.col(other)).drop(other)
    p = lambda c: F.col(f"{mine}.{c}")
    epoch, used = free_name(docs, "__epoch"), free_name(docs, "__used")
    copies = here.withColumn(epoch, F.explode(F.sequence(F.lit(0).cast("bigint"), p("whole")))).filter((F.col(epoch) < p("whole")) | (p("rest") > 0))
    bucket = F.substring(order_hash(F.col(id_col), p("whole"), seed), 1, DIGITS[-1])
    partial = F.col(epoch) == p("whole")
    unknown = F.lit(None).cast("bigint")
    inside = copies.filter(~partial | (bucket < p("bucket"))).withColumn(used, unknown)
    edge = copies.filter(partial & (bucket == p("bucket")))
    count = free_name(docs, "__tokens")
    edge = edge.withColumn(count, token_count(F.col(text_col)))
    order = W.partitionBy(leaf).orderBy(order_hash(F.col(id_col), p("whole"), seed), F.col(text_col))
    run = F.sum(count).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    edge = edge.withColumn(used, p("rest") - p("start") - (run - F.col(count))).filter(F.col(used) > 0)
    edge = edge.withColumn(used, F.least(used, count)).drop(count)
    mix = F.struct(*(F.col(f"{leaf}.n{k}").alias(c) for k, c in enumerate(levels)), F.col(epoch).cast("int").alias("epoch"), F.col(used).alias("cut_at"))
    return inside.unionByName(edge).withColumn(out, mix).drop(mine, leaf, epoch, used)


def mix_tokens(text: Column, out: str = "mix") -> Column:
    """Tokens used of a chosen row of ``select_mix``: all, or up to where the leaf's prefix ends."""
    return F.coalesce(f"{out}.cut_at", token_count(text))


def mix_sql(domain_sql: str, weights: Mapping[str, Mapping[str, int]], share: str, max_epochs: int, seed: int) -> str:
    """The same selection for a table ``documents`` as one SQL query, in row order without buckets."""
    part = Fraction(share)

    def weight(level: str) -> str:
        cases = " ".join(f"WHEN c.{level} = '{n}' THEN {w}" for n, w in weights.get(level, {}).items())
        return f"CAST(CASE {cases} ELSE 1 END AS BIGINT)" if cases else "CAST(1 AS BIGINT)"

    levels = ("domain", "lang", "source")
    cte = [
        f"""rws AS (SELECT doc_id, text, {domain_sql} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS tokens FROM documents)""",
        f"leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * {max_epochs} AS BIGINT) AS cap FROM rws GROUP BY ALL HAVING sum(tokens) > 0)",
        f"""b0 AS (SELECT 0 AS root_, least(CAST((sum(tokens)::HUGEINT * {part.numerator}) // {part.denominator} AS BIGINT), CAST(sum(cap) AS BIGINT)) AS given FROM leaf)""",
    ]
    for k, level in enumerate(levels, 1):
        path, up = ", ".join(levels[:k]), "".join(f", {x}" for x in levels[: k - 1])
        fam = f"PARTITION BY root_{up}"
        on = " AND ".join(["TRUE", *(f"c.{x} = p.{x}" for x in levels[: k - 1])])
        cte.append(f"""n{k} AS (SELECT 0 AS root_, {", ".join("c." + x for x in levels[:k])}, c.cap, {weight(level)} AS weight, p.given AS budget
        FROM (SELECT {path}, CAST(sum(cap) AS BIGINT) AS cap FROM leaf GROUP BY ALL) c JOIN b{k - 1} p ON {on})""")
        cte += [
            f"""o{k} AS (SELECT *, budget - (sum(cap) OVER w - cap) AS left_, sum(weight) OVER ({fam}) - sum(weight) OVER w + weight AS weights_ FROM n{k}
        WINDOW w AS ({fam} ORDER BY cap::DOUBLE / weight, {level} ROWS UNBOUNDED PRECEDING))""",
            f"f{k} AS (SELECT *, cap * weights_ <= weight * left_ AS full_ FROM o{k})",
            f"""g{k} AS (SELECT *, budget - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ({fam}) AS pool_, sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER ({fam}) AS open_ FROM f{k})""",
            f"""h{k} AS (SELECT *, CASE WHEN full_ THEN cap ELSE (pool_ * weight) // open_ END AS base_, CASE WHEN full_ THEN -1 ELSE (pool_ * weight) % open_ END AS rest_ FROM g{k})""",
            f"""i{k} AS (SELECT *, least(budget, sum(cap) OVER ({fam})) - sum(base_) OVER ({fam}) AS spare_, row_number() OVER ({fam} ORDER BY rest_ DESC, {level}) AS place_ FROM h{k})""",
            f"b{k} AS (SELECT root_, {path}, CAST(base_ + CASE WHEN rest_ >= 0 AND place_ <= spare_ THEN 1 ELSE 0 END AS BIGINT) AS given FROM i{k})",
        ]
    cte += [
        "plan AS (SELECT l.*, b.given // l.tokens AS whole, b.given % l.tokens AS rest FROM leaf l JOIN b3 b ON l.domain = b.domain AND l.lang = b.lang AND l.source = b.source)",
        "j AS (SELECT r.*, p.whole, p.rest, unnest(range(p.whole + 1)) AS epoch FROM rws r JOIN plan p ON r.domain = p.domain AND r.lang = p.lang AND r.source = p.source)",
        f"""k AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source, epoch
        ORDER BY md5('{seed}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), text ROWS UNBOUNDED PRECEDING) - tokens AS before FROM j)""",
    ]
    return (
        "WITH " + ",\n".join(cte) + "\nSELECT doc_id, domain, lang, source, CAST(epoch AS INTEGER) AS epoch, tokens AS n_tokens, "
        "CAST(CASE WHEN epoch < whole THEN tokens ELSE least(tokens, rest - before) END AS BIGINT) AS n_used "
        "FROM k WHERE epoch < whole OR before < rest"
    )
