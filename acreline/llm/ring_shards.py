"""Sharding on a consistent-hash ring with virtual nodes and bounded loads. DataFrame functions only.

The ring has ``2^k`` places. Every shard owns ``vnodes`` virtual nodes at hashed places; a row belongs
to the first virtual node at or after the place of its key, clockwise. A shard takes rows up to its
capacity, in ring order; rows beyond it go on clockwise to the next virtual node whose shard has room.
With ``load_factor`` 1 the capacities add up to the number of rows, so shard sizes differ by one row
at most; above 1 fewer rows leave their home shard.

Only counts per ring place decide. They form a table of ``2^k`` rows, whose size depends on the shards
and virtual nodes and not on the data; the clockwise walk is one fold over the virtual nodes. A row
then needs its rank within its place, which is a small window, and a look-up of that rank. Places
that hold a crowd (one key on a third of the rows) are ranked in ``SALTS`` pieces.

Defined results: a null key is a key of its own; rows with one key start at one place and overflow like
others, in the order of the tie columns; in a crowded place that order holds within each piece only;
an empty table gives an empty table. Equal texts are not kept together: under ``rows`` a group of
copies above a shard's capacity has to spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acreline.llm.common import checkpointed, claim, free_name, written

SALTS = 64
#: A place is crowded above so many times the mean.
CROWD = 16


def ring(spark: SparkSession, shards: int, vnodes: int, seed: int = 4) -> DataFrame:
    """(place, node, shard): for every place the virtual node that serves it."""
    places = 1 << (16 * shards * vnodes - 1).bit_length()
    nodes = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(places)).alias("node")
    )
    nodes = nodes.groupBy("node").agg(F.min("shard").alias("shard"))  # two nodes on one place: the smaller shard
    twice = nodes.union(nodes.select(F.col("node") + places, "shard"))  # one more turn, so that the last places find a node
    laid = spark.range(2 * places).withColumnRenamed("id", "place").join(twice, F.col("place") == F.col("node"), "left")
    onward = W.orderBy(F.desc("place")).rowsBetween(W.unboundedPreceding, W.currentRow)
    served = laid.select(
        "place", *(F.last(c, ignorenulls=True).over(onward).alias(c) for c in ("node", "shard"))
    )
    return served.filter(F.col("place") < places).withColumn("node", F.col("node") % places)


def _clockwise(arcs: DataFrame) -> DataFrame:
    """(shard, lo, hi): which stretch of the queue of overflowing rows each virtual node takes in.

    ``arcs(node, shard, extra, spare)``: rows that overflow at a node, and the room its shard has left.
    One fold goes round the ring twice: the second turn only places what the first left over.
    """
    spares = arcs.groupBy("shard").agg(F.max("spare").alias("spare"))
    spares = spares.agg(F.map_from_entries(F.collect_list(F.struct("shard", "spare"))).alias("room"))
    steps = arcs.select("node", "shard", "extra").agg(F.sort_array(F.collect_list(F.struct("node", "shard", "extra"))).alias("arcs"))
    both = steps.withColumn("k", F.lit(0)).join(spares.withColumn("k", F.lit(0)), "k")  # one row each
    zero = F.lit(0).cast("bigint")
    again = F.transform("arcs", lambda x: F.struct(x["node"].alias("node"), x["shard"].alias("shard"), zero.alias("extra")))
    piece = "array<struct<shard:int,lo:bigint,hi:bigint>>"
    start = F.struct(zero.alias("waiting"), zero.alias("placed"), F.col("room").alias("room"), F.array().cast(piece).alias("out"))

    def step(s: Column, x: Column) -> Column:
        take = F.least(s["waiting"] + x["extra"], F.coalesce(F.element_at(s["room"], x["shard"]), zero))
        end = s["placed"] + take
        part = F.array(F.struct(x["shard"].alias("shard"), s["placed"].alias("lo"), end.alias("hi")))
        return F.struct(
            (s["waiting"] + x["extra"] - take).alias("waiting"),
            end.alias("placed"),
            F.when(take > 0, F.transform_values(s["room"], lambda k, v: F.when(k == x["shard"], v - take).otherwise(v)))
            .otherwise(s["room"])
            .alias("room"),
            F.when(take > 0, F.concat(s["out"], part)).otherwise(s["out"]).alias("out"),
        )

    return both.select(F.inline(F.aggregate(F.concat("arcs", again), start, step)["out"]))


def placement(counts: DataFrame, shards: int, vnodes: int, load_factor: float = 1.0, seed: int = 4) -> DataFrame:
    """(place, lo, hi, shard, base, home): rows ``lo <= rank < hi`` of a place go to ``shard``, to its
    slots from ``base`` on. ``counts(place, c)`` has the number of rows of each place."""
    n = counts.agg(F.sum("c")).first()[0] or 0
    if load_factor == 1.0:
        room = F.lit(n // shards) + (F.col("shard") < n % shards).cast("bigint")
    else:
        room = F.lit(-(-int(n * load_factor) // shards)).cast("bigint")
    laid = ring(counts.sparkSession, shards, vnodes, seed).join(counts, "place", "left").na.fill(0, ["c"])
    own = W.partitionBy("shard").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    laid = laid.withColumn("stay", F.greatest(F.lit(0), F.least("c", room - F.sum("c").over(own) + F.col("c"))))
    laid = laid.withColumn("spare", room - F.sum("stay").over(W.partitionBy("shard")))
    laid = checkpointed(laid.withColumn("extra", F.col("c") - F.col("stay")))

    arcs = laid.groupBy("node", "shard").agg(F.sum("extra").alias("extra"), F.max("spare").alias("spare"))
    taken = _clockwise(arcs)
    line = W.orderBy("node", "place").rowsBetween(W.unboundedPreceding, W.currentRow)
    queue = laid.filter("extra > 0").withColumn("at", F.sum("extra").over(line) - F.col("extra"))
    # places and takers both cut the queue [0, total) into stretches; overlay the two
    none = lambda kind: F.lit(None).cast(kind)
    cuts = queue.select("at", "place", (F.col("stay") - F.col("at")).alias("shift"), none("int").alias("shard")).union(
        taken.select("lo", none("bigint"), none("bigint"), "shard")
    )
    cuts = cuts.groupBy("at").agg(*(F.max(c).alias(c) for c in ("place", "shift", "shard")))
    along = W.orderBy("at")
    total = queue.agg(F.max(F.col("at") + F.col("extra")).alias("total")).withColumn("k", F.lit(0))
    moved = cuts.withColumn("k", F.lit(0)).join(total, "k").select(
        "at",
        (F.coalesce(F.lead("at").over(along), F.col("total"))).alias("until"),
        *(F.last(c, ignorenulls=True).over(along).alias(c) for c in ("place", "shift", "shard")),
    )
    moved = moved.select("place", (F.col("at") + F.col("shift")).alias("lo"), (F.col("until") + F.col("shift")).alias("hi"), "shard")
    stayed = laid.filter("stay > 0").select("place", F.lit(0).cast("bigint").alias("lo"), F.col("stay").alias("hi"), "shard")
    pieces = stayed.union(moved).join(laid.select("place", F.col("shard").alias("home")), "place")
    filled = W.partitionBy("shard").orderBy("place", "lo").rowsBetween(W.unboundedPreceding, W.currentRow)
    size = F.col("hi") - F.col("lo")
    return pieces.withColumn("base", F.sum(size).over(filled) - size)


def assign_shards(
    docs: DataFrame,
    shards: int = 40,
    key: str = "doc_id",
    ties: tuple[str, ...] = (),
    vnodes: int = 64,
    load_factor: float = 1.0,
    seed: int = 4,
    salts: int = SALTS,
    crowd: int = CROWD,
) -> DataFrame:
    """The rows plus shard (0 to shards - 1), slot (gapless from 0 in each shard) and home_shard.

    All columns of ``docs`` travel through one shuffle: give only those the result needs. ``ties``
    orders rows of one key. A column of ``docs`` with the name of a result column is an error.
    """
    claim(docs, "shard", "slot", "home_shard")
    place, tie, salt, rank, many = (free_name(docs, f"__{x}") for x in ("place", "tie", "salt", "rank", "many"))
    places = 1 << (16 * shards * vnodes - 1).bit_length()
    text_key = F.coalesce(F.col(key).cast("string"), F.lit("\u0000"))
    keyed = docs.withColumn(place, F.pmod(F.xxhash64(text_key, F.lit(seed)), F.lit(places)))
    keyed = written(keyed.withColumn(tie, F.pmod(F.monotonically_increasing_id(), F.lit(salts))), "ring")
    counts = checkpointed(keyed.groupBy(F.col(place).alias("place")).agg(F.count("*").alias("c")))
    pieces = checkpointed(placement(counts, shards, vnodes, load_factor, seed))

    total = counts.agg(F.sum("c")).first()[0] or 0
    crowded = counts.filter(F.col("c") > max(64, crowd * total // places)).select(F.col("place").alias(many))
    order = [F.xxhash64(text_key), *(F.col(c) for c in ties)]
    if crowded.isEmpty():
        ranked = keyed.withColumn(rank, F.row_number().over(W.partitionBy(place).orderBy(*order)) - 1)
    else:
        salted = keyed.join(crowded, F.col(place) == F.col(many), "left")
        salted = salted.withColumn(salt, F.when(F.col(many).isNotNull(), F.col(tie)).otherwise(0))
        sizes = salted.filter(F.col(many).isNotNull()).groupBy(F.col(place).alias("p"), F.col(salt).alias("s")).count()
        before = W.partitionBy("p").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
        sizes = sizes.select(F.struct("p", "s", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")).alias(tie))
        ranked = salted.withColumn(rank, F.row_number().over(W.partitionBy(place, salt).orderBy(*order)) - 1).drop(tie)
        ranked = ranked.join(sizes, (F.col(place) == F.col(f"{tie}.p")) & (F.col(salt) == F.col(f"{tie}.s")), "left")
        ranked = ranked.withColumn(rank, F.col(rank) + F.coalesce(f"{tie}.offset", F.lit(0)))
    piece = free_name(docs, "__piece")
    pieces = pieces.select(F.struct("place", "lo", "hi", "shard", "base", "home").alias(piece))
    at = {c: F.col(f"{piece}.{c}") for c in ("place", "lo", "hi", "shard", "base", "home")}
    found = ranked.join(pieces, (F.col(place) == at["place"]) & (F.col(rank) >= at["lo"]) & (F.col(rank) < at["hi"]))
    slot = (at["base"] + F.col(rank) - at["lo"]).alias("slot")
    return found.select(*docs.columns, at["shard"].alias("shard"), slot, at["home"].alias("home_shard"))
