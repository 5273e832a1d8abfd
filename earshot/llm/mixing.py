"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm.text import n_words, set_aside, whole
from earshot.operators.sizing import broadcast_within, measured

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
BLOCK_WORDS = 16
"""Words in a block: a source is off its target by a block at most. One that the limit of three repeats binds meets it to the word."""
RING_BLOCKS = 64
"""Blocks of words that a shard has at least on average, so that its rounding does not show."""


def cycled_weights(rank: Column, weights: tuple[float, ...] = WEIGHTS) -> Column:
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target`` to a table of ``source``, ``source_size``, ``weight``.

    All words are shared by weight; a source gets at most ``max_repeats`` times
    its size, and the excess goes to the others by weight until none is above.
    The fixed point is min(limit, level * weight). Sources are ordered by limit
    per weight, and the level is the first one at which no later source is
    above its limit. A weight of 0 gets nothing. The table has one row for each source.
    """
    limit = (max_repeats * F.col("source_size")).cast("double")
    fill = sizes.withColumn("_limit", limit).withColumn("_ratio", F.col("_limit") / F.col("weight"))
    order = W.orderBy(F.asc_nulls_last("_ratio"), F.asc_nulls_last("source"))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    total = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # Whether a source is limited, if all before it in the order are.
    left = F.sum("source_size").over(total) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    weight = F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    fill = fill.withColumns({"_left": left, "_weight": weight})
    fill = fill.withColumn("_level", F.col("_left") / F.nullif(F.col("_weight"), F.lit(0.0)))
    free = F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))
    level = F.first(free, ignorenulls=True).over(total)
    target = F.least(F.col("_limit"), F.coalesce(level * F.col("weight"), F.col("_limit")))
    target = F.when(F.col("weight") > 0, target).otherwise(0.0)
    return fill.withColumn("target", target).drop("_limit", "_ratio", "_left", "_weight", "_level")


def sainte_lague(parties: DataFrame, keys: list[str], votes: str, seats: Column, limit: Column, order: list[str], out: str) -> DataFrame:
    """Seats of each party by the highest quotients votes / 1, 3, 5, ... within each group of ``keys``.

    ``seats`` is the number of seats of the group, ``limit`` the most that a
    party can fill; ties go by ``order``. Rounding votes at a divisor that is
    surely too large leaves at most one seat for each party, and one that is
    surely too small bounds what any party can win; only the quotients between
    the two are ranked, about two for each party.
    """
    group = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    counted = parties.withColumns(
        {"_seats": seats, "_limit": limit, "_votes": F.sum(votes).over(group), "_parties": F.count("*").over(group)}
    )
    # Rounding changes the sum by at most half a seat for each party.
    few = F.col("_seats") - F.col("_parties") / 2
    many = F.col("_seats") + F.col("_parties") / 2
    share = F.col(votes) / F.nullif(F.col("_votes"), F.lit(0.0))
    sure = F.greatest(F.floor(share * few + 0.5), F.lit(0))
    most = F.greatest(F.floor(share * many + 0.5) + 1, F.lit(0))
    counted = counted.withColumns({"_sure": F.coalesce(sure, F.lit(0)), "_most": F.coalesce(most, F.lit(0))})
    counted = counted.withColumns({"_sure": F.least("_sure", "_limit"), "_most": F.least("_most", "_limit")})
    rest = F.col("_seats") - F.sum("_sure").over(group)
    seat = F.explode_outer(F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure") + 1, F.col("_most"))))
    offers = counted.withColumn("_rest", rest).withColumn("_seat", seat)
    offers = offers.withColumn("_quotient", F.col(votes) / (2 * F.col("_seat") - 1))
    ranked = group.orderBy(F.desc_nulls_last("_quotient"), *[F.asc_nulls_last(c) for c in order])
    won = F.col("_seat").isNotNull() & (F.row_number().over(ranked) <= F.col("_rest"))
    offers = offers.withColumn("_won", F.when(won, 1).otherwise(0))
    firsts = [F.first(c).alias(c) for c in parties.columns if c not in [*keys, *order]]
    seated = offers.groupBy(*keys, *order).agg(*firsts, (F.first("_sure") + F.sum("_won")).cast("bigint").alias(out))
    return seated


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS,
    max_repeats: int = MAX_REPEATS,
    seed: int = 17,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``: the words of each row that the mix takes.

    Sources, ordered by code point with null last, have the given weights in
    turn. Targets follow ``source_targets``. They become whole numbers of blocks
    by Sainte-Laguë, over the sources and then over the shards of each source. A
    source has as many shards as the square root of its rows, so neither the
    shards of a source nor the rows of a shard are many, but fewer if they would
    hold less than 64 blocks of words each. The rows of a shard,
    in seeded order, are one ring of words; its blocks are laid on the ring one
    after the other from a seeded start, round again where the quota exceeds the
    ring, at most ``max_repeats`` times. A source that the limit binds gives each
    word so many times. So what a row gives follows from its
    place by arithmetic, and no block is ever a row.

    A null text has size 0; a source without words has target 0; an empty table
    gives no rows. Repeated rows count as rows of their own. Reruns agree.
    Columns of ``docs`` with the names above are replaced.
    """

    def work(docs: DataFrame) -> DataFrame:
        return _mixed(docs, id_col, text_col, source_col, weights, block_words, max_repeats, seed)

    return set_aside(docs, work, [id_col, text_col, source_col])


def _mixed(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    source_col: str,
    weights: tuple[float, ...],
    block_words: int,
    max_repeats: int,
    seed: int,
) -> DataFrame:
    added = ["size", "source_size", "target", "taken"]
    docs = docs.drop(*added)
    identity = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    sized = docs.withColumns({"size": n_words(whole(text_col)), "_place": identity, "_source": F.col(source_col).cast("string")})
    rows = sized.select("_source", "size")
    per_source = rows.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    by_name = W.orderBy(F.asc_nulls_last("_source"))
    per_source = per_source.withColumn("weight", cycled_weights(F.row_number().over(by_name), weights))
    goals = source_targets(per_source.withColumnRenamed("_source", "source"), max_repeats)
    spread = F.ceil(F.sqrt("_rows")).cast("bigint")
    large = F.floor(F.col("source_size") / (RING_BLOCKS * block_words)).cast("bigint")
    goals = goals.withColumns({"_spread": spread, "_shards": F.least(spread, F.greatest(F.lit(1).cast("bigint"), large))})
    # A source at its limit gives all its words so many times, whatever the blocks.
    goals = goals.withColumns({"_full": F.col("target") >= max_repeats * F.col("source_size"), "_one": F.lit(1)})
    total = F.round(F.sum("target").over(W.partitionBy("_one")) / block_words).cast("bigint")
    room = F.ceil(max_repeats * F.col("source_size") / block_words).cast("bigint")
    goals = sainte_lague(goals, ["_one"], "target", total, room, ["source"], "_blocks").withColumnRenamed("source", "_source")
    goals, n_sources = measured(goals.drop("_one", "weight", "_rows"))

    same = sized["_source"].eqNullSafe(goals["_source"])
    placed = sized.join(broadcast_within(goals, n_sources), same).drop(goals["_source"])
    # Rows without words are on no ring; they are spread by their number alone.
    drawn = F.xxhash64(F.lit(seed + 1), F.col("_place"))
    shard = F.when(F.col("size") > 0, F.pmod(drawn, F.col("_shards"))).otherwise(-1 - F.pmod(drawn, F.col("_spread")))
    placed = placed.withColumn("_shard", shard.cast("int"))
    shards = placed.groupBy("_source", "_shard").agg(
        F.sum("size").alias("_ring"), F.first("_blocks").alias("_blocks"), F.first("_full").alias("_full")
    )
    shard_room = F.ceil(max_repeats * F.col("_ring") / block_words).cast("bigint")
    shards = sainte_lague(shards, ["_source"], "_ring", F.col("_blocks"), shard_room, ["_shard"], "_quota")
    most = max_repeats * F.col("_ring")
    quota = F.when(F.col("_full"), most).otherwise(F.least(F.col("_quota") * block_words, most))
    shards, n_shards = measured(shards.select("_source", "_shard", "_ring", quota.alias("_quota")))

    in_order = W.partitionBy("_source", "_shard").orderBy("_place", F.col(id_col), "size")
    ends = placed.withColumn("_end", F.sum("size").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
    shards = shards.withColumnsRenamed({"_source": "_s", "_shard": "_k"})
    ends = ends.join(broadcast_within(shards, n_shards), F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_k")))
    ring = F.col("_ring")
    first = F.when(ring > 0, F.pmod(F.xxhash64(F.lit(seed + 2), "_source", "_shard"), ring)).otherwise(0)
    rounds, part = F.floor(F.col("_quota") / ring).cast("bigint"), F.col("_quota") % ring

    def before(x: Column) -> Column:
        """Words ahead of ``x`` on the ring that lie in the last, unfinished round."""
        straight = F.greatest(F.lit(0), F.least(x, first + part) - F.least(x, first))
        around = F.least(x, F.greatest(F.lit(0), first + part - ring))
        return straight + around

    taken = F.col("size") * rounds + before(F.col("_end")) - before(F.col("_end") - F.col("size"))
    out = ends.withColumn("taken", F.when(ring > 0, taken).otherwise(0).cast("bigint"))
    return out.select(*docs.columns, *added)
