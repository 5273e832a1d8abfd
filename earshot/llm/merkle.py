"""Merkle manifest of a table: places of leaves by bitmap ranks, levels by keyed slot arrays.

Every row is a leaf. Leaves of a group stand in the order of their ids, yet are
never sorted: the ids of a group are a sparse bitmap of 64-bit words (``bit_or``,
combined before the shuffle), a directory holds the rows before each word, and
the place of a leaf is the directory's entry plus the bits below its own. A block
gathers 512 places into an array of slots and reduces three levels at once, so a
tree of a billion leaves needs four shuffles, each 1/512 of the one before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.operators.ordered import MAX_ROWS, row_numbers
from earshot.operators.sizing import broadcast_within, measured, scratch_path, staged

FAN = 8
LEVELS = 3
"""Levels that a block reduces; it has ``FAN ** LEVELS`` slots."""
SLOTS = FAN**LEVELS
CHILDREN = 10
"""Bits of a level of the directory: a window sums at most 1024 entries."""

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "struct<left:string,right:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256, in hex, of the values in order: ``-`` for null, else bytes, ``:``, value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(v) for v in values]), 256)


# --- places ---------------------------------------------------------------------------


def _rows_before(counts: DataFrame, low: int, high: int) -> DataFrame:
    """``grp``, ``key``, ``before``: the rows of smaller keys of the group; keys lie in ``low`` .. ``high``."""
    tall = high - low >= 1 << CHILDREN
    up = F.shiftright("key", CHILDREN) if tall else F.lit(0)
    earlier = W.partitionBy("grp", "up").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    inside = counts.withColumn("up", up).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    if not tall:
        return inside.select("grp", "key", "before")
    parents = counts.groupBy("grp", up.alias("key")).agg(F.sum("n").alias("n"))
    above = _rows_before(parents, low >> CHILDREN, high >> CHILDREN)
    above = above.select(F.col("grp").alias("g"), F.col("key").alias("k"), F.col("before").alias("base"))
    joined = inside.join(above, (F.col("grp") == F.col("g")) & (F.col("up") == F.col("k")))
    return joined.select("grp", "key", (F.col("before") + F.col("base")).alias("before"))


def _numbered_ties(leaves: DataFrame, several: DataFrame, max_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of words with repeated ids, with their number among equal ids, and the surplus of each id by word.

    Equal ids stand in the order of their digests; a heavy id is numbered in slices.
    """
    at = (F.col("grp") == F.col("g")) & F.col("word").eqNullSafe(F.col("k"))
    some = several.select(F.col("grp").alias("g"), F.col("word").alias("k"))
    tied = staged(leaves.join(some, at, "left_semi"), scratch_path(leaves.sparkSession, "ties"))
    named = tied.withColumn("same", F.concat("grp", F.lit("\0"), F.coalesce(F.col("id").cast("string"), F.lit("-"))))
    numbered = row_numbers(named, "same", "leaf", [], "tie", max_rows=max_rows).withColumn("tie", F.col("tie") - 1)
    copies = tied.where("id IS NOT NULL").groupBy("grp", "word", "id").agg(F.count("*").alias("n")).where("n > 1")
    surplus = copies.groupBy(F.col("grp").alias("sg"), F.col("word").alias("sw")).agg(
        F.collect_list(F.struct(F.expr("int(id & 63)").alias("bit"), (F.col("n") - 1).alias("more"))).alias("surplus")
    )
    return numbered.drop("same"), surplus


def placed(leaves: DataFrame, max_rows: int = MAX_ROWS) -> tuple[DataFrame, DataFrame]:
    """The leaves (``grp``, ``id``, ``leaf`` and others) with ``place``, and the size ``n`` of each group.

    Null ids come first; equal ids are in the order of their digests.
    """
    leaves = leaves.withColumn("word", F.shiftright("id", 6))
    bits = F.bit_or(F.expr("shiftleft(1L, int(id & 63))")).alias("bits")
    made = leaves.groupBy("grp", "word").agg(bits, F.count("*").alias("n"))
    words = staged(made, scratch_path(leaves.sparkSession, "bitmaps"))
    nulls = F.sum(F.when(F.col("word").isNull(), F.col("n")).otherwise(0)).alias("nulls")
    sizes, n_groups = measured(words.groupBy("grp").agg(F.sum("n").alias("n"), nulls))
    several, n_several = measured(words.where("n > coalesce(bit_count(bits), 1)").select("grp", "word"))

    low, high = words.agg(F.min("word"), F.max("word")).first()
    directory = _rows_before(words.where("word IS NOT NULL").select("grp", F.col("word").alias("key"), "n"), low or 0, high or 0)
    directory = directory.select(F.col("grp").alias("dg"), F.col("key").alias("dw"), "before")
    ranks = words.join(directory, (F.col("grp") == F.col("dg")) & (F.col("word") == F.col("dw"))).select("dg", "dw", "bits", "before")
    nothing = F.array().cast("array<struct<bit:int,more:bigint>>")
    rest = leaves.withColumn("tie", F.lit(0).cast("bigint"))
    if n_several:
        tied, surplus = _numbered_ties(leaves, several, max_rows)
        few = broadcast_within(several.select(F.col("grp").alias("g"), F.col("word").alias("k")), n_several)
        rest = rest.join(few, (F.col("grp") == F.col("g")) & F.col("word").eqNullSafe(F.col("k")), "left_anti").unionByName(tied)
        ranks = ranks.join(surplus, (F.col("dg") == F.col("sg")) & (F.col("dw") == F.col("sw")), "left").drop("sg", "sw")
        ranks = ranks.withColumn("surplus", F.coalesce("surplus", nothing))
    else:
        ranks = ranks.withColumn("surplus", nothing)
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, int(id & 63))"))
    more = F.aggregate(
        F.filter("surplus", lambda s: s["bit"] < F.expr("int(id & 63)")), F.lit(0).cast("bigint"), lambda total, s: total + s["more"]
    )
    ranked = rest.join(ranks, (F.col("grp") == F.col("dg")) & (F.col("word") == F.col("dw")), "left").drop("dg", "dw")
    groups = broadcast_within(sizes.select(F.col("grp").alias("g"), "nulls"), n_groups)
    ranked = ranked.join(groups, F.col("grp") == F.col("g"))
    place = F.when(F.col("id").isNull(), F.col("tie")).otherwise(F.col("nulls") + F.col("before") + below + more + F.col("tie"))
    placed = ranked.withColumn("place", place)
    return placed.drop("word", "tie", "bits", "before", "surplus", "g", "nulls"), sizes.select("grp", "n")


# --- levels ----------------------------------------------------------------------------


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), ""), 256))


def _reduced(nodes: Column, depth: Column) -> Column:
    """``levels``, the nodes of the lowest ``depth`` levels of a block, and ``top``, the node above them."""
    return let(
        nodes,
        lambda a: let(
            _parents(a),
            lambda b: let(
                _parents(b),
                lambda c: F.struct(
                    F.slice(F.array(a, b, c), F.lit(1), depth).alias("levels"),
                    F.element_at(F.array(a[0], b[0], c[0], _parents(c)[0]), depth + 1).alias("top"),
                ),
            ),
        ),
    )


def _depth(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves: the octal digits of n - 1."""
    return F.when(n <= 1, 0).otherwise(F.length(F.conv((n - 1).cast("string"), 10, FAN)))


def tree(nodes: DataFrame, sizes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of each round, lowest first, and the ``top`` of each group.

    ``nodes`` has ``grp``, ``place`` and a struct ``node`` with a field ``leaf``;
    ``sizes`` has ``grp`` and ``n``.
    """
    spark = nodes.sparkSession
    sizes, n_groups = measured(sizes.select(F.col("grp").alias("g"), _depth(F.col("n")).alias("depth")))
    deepest = sizes.agg(F.max("depth")).first()[0] or 0
    rounds: list[DataFrame] = []
    tops = None
    while not rounds or deepest > LEVELS * len(rounds):
        done = LEVELS * len(rounds)
        at = F.floor(F.col("place") / SLOTS).alias("block")
        slot = F.struct((F.col("place") % SLOTS).cast("int").alias("slot"), F.col("node"))
        blocks = nodes.groupBy("grp", at).agg(F.array_sort(F.collect_list(slot)).alias("slots"))
        left = sizes.withColumn("left", F.col("depth") - done)
        blocks = blocks.join(broadcast_within(left, n_groups), F.col("grp") == F.col("g"))
        made = _reduced(F.transform("slots", lambda s: s["node"]["leaf"]), F.least(F.lit(LEVELS), F.col("left")))
        whole = blocks.withColumn("made", made).select(
            "grp", "block", F.transform("slots", lambda s: s["node"]).alias("slots"), "made.levels", "made.top", (F.col("left") <= LEVELS).alias("last")
        )
        if rounds:
            whole = whole.drop("slots")
        blocks = staged(whole, scratch_path(spark, "blocks"))
        rounds.append(blocks)
        ended = blocks.where("last").select("grp", "top")
        tops = ended if tops is None else tops.unionByName(ended)
        nodes = blocks.where("NOT last").select("grp", F.col("block").alias("place"), F.struct(F.col("top").alias("leaf")).alias("node"))
    return rounds, tops


def _siblings(levels: Column, i: Column) -> Column:
    """The nodes on either side of slot ``i``'s ancestor in its run, level by level."""

    def of(nodes: Column, level: Column) -> Column:
        return let(
            F.call_function("shiftright", i, level * 3),
            lambda j: F.struct(
                F.array_join(F.slice(nodes, j - j % FAN + 1, j % FAN), "").alias("left"),
                F.array_join(F.slice(nodes, j + 2, FAN - 1 - j % FAN), "").alias("right"),
            ),
        )

    return F.transform(levels, of)


def with_paths(rounds: list[DataFrame], seeds: DataFrame) -> DataFrame:
    """The lowest blocks with ``path``, the siblings of all levels above the block, and the columns of ``seeds``.

    ``seeds`` has ``grp``, the ``path`` above the group's top, and any others.
    """
    seeds, n_seeds = measured(seeds)
    others = [c for c in seeds.columns if c not in ("grp", "path")]
    seed = broadcast_within(seeds.withColumnRenamed("grp", "sg"), n_seeds)
    above = None
    for number, blocks in reversed(list(enumerate(rounds))):
        topmost = blocks.where("last").join(seed, F.col("grp") == F.col("sg")).drop("sg")
        if above is not None:
            parents = above.select(F.col("grp").alias("pg"), F.col("place").alias("pb"), "path", *others)
            at = (F.col("grp") == F.col("pg")) & (F.col("block") == F.col("pb"))
            topmost = topmost.unionByName(blocks.where("NOT last").join(parents, at).drop("pg", "pb"))
        if not number:
            return topmost
        slots = F.sequence(F.lit(0), F.size(F.get("levels", F.lit(0))) - 1)
        each = topmost.select("grp", "block", "path", *others, F.transform(slots, lambda i: F.struct(i.alias("slot"), _siblings(F.col("levels"), i).alias("own"))).alias("each"))
        above = each.select("grp", "block", "path", *others, F.inline("each"))
        above = above.select("grp", (F.col("block") * SLOTS + F.col("slot")).alias("place"), F.concat("own", "path").alias("path"), *others)
    raise ValueError("a tree has at least one round")


def folded(path: Column, leaf: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: Sequence[str] = COLUMNS,
    found: Mapping[str, Column] | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per document with its leaf, its proof, and whether what is found now still folds to the root.

    ``id_col`` and ``group_col`` as they are, ``leaf``, ``subroot`` (of the
    group), ``root``, ``proof_sha256`` (of all siblings, level by level, left to
    right), ``folded_root`` and ``verified``. ``found`` replaces columns by what a
    later reader finds there, such as a changed text; the root is folded from that
    leaf and the siblings of the manifest.

    A group's leaves ascend by id (an integer), null ids first, equal ids by
    digest; repeated rows are leaves of their own. Groups ascend by their UTF-8
    bytes, null first; an empty name is a group, too. Runs of eight nodes are
    hashed until one node is left; a group with one row has its leaf as subroot.
    Null values count as ``-``, texts of any length are hashed whole. An empty
    table gives no rows. Columns not named in ``columns`` are not looked at, so
    none clashes. Jobs run while the plan is built; what they write stays in the
    scratch folder, as the result reads it.
    """
    spark = docs.sparkSession
    as_found = {**{c: F.col(f"`{c}`") for c in columns}, **(found or {})}
    changed = [F.lit(None).cast("string")] if found is None else [leaf_digest([as_found[c] for c in columns])]
    leaves = docs.select(
        # '=' marks a name, so that null sorts before all names, the empty one included.
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("")).alias("grp"),
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        leaf_digest([F.col(f"`{c}`") for c in columns]).alias("leaf"),
        changed[0].alias("now"),
    )
    leaves = leaves.withColumn("now", F.when(F.col("now") != F.col("leaf"), F.col("now")))
    leaves = staged(leaves, scratch_path(spark, "leaves"))
    at_places, sizes = placed(leaves, max_rows)
    # The leaf comes first in the struct; 'now' is null where nothing has changed.
    nodes = at_places.select("grp", "place", F.struct("leaf", "now", "id").alias("node"))
    rounds, subroots = tree(nodes, sizes)

    named = subroots.withColumn("all", F.lit(0))
    ordered = row_numbers(named, "all", "grp", [], "number", max_rows=max_rows)
    groups = ordered.select(F.lit("").alias("grp"), (F.col("number") - 1).alias("place"), F.struct(F.col("top").alias("leaf"), F.col("grp").alias("of")).alias("node"))
    upper, roots = tree(groups, groups.groupBy("grp").agg(F.count("*").alias("n")))
    no_path = F.array().cast(f"array<{NODE}>").alias("path")
    upper = with_paths(upper, roots.select("grp", no_path, F.col("top").alias("root")))
    inner = F.transform("slots", lambda s, i: F.struct(s["of"].alias("grp"), s["leaf"].alias("subroot"), F.concat(_siblings(F.col("levels"), i), F.col("path")).alias("path")))
    seeds = upper.select("root", F.inline(inner))

    lowest = with_paths(rounds, seeds)

    def proved(node: Column, i: Column) -> Column:
        def of(path: Column) -> Column:
            joined = F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")
            return F.struct(
                node["id"].alias("id"),
                node["leaf"].alias("leaf"),
                F.sha2(joined, 256).alias("proof_sha256"),
                folded(path, F.coalesce(node["now"], node["leaf"])).alias("folded_root"),
            )

        return let(F.concat(_siblings(F.col("levels"), i), F.col("path")), of)

    rows = lowest.select("grp", "subroot", "root", F.inline(F.transform("slots", proved)))
    return rows.select(
        F.col("id").alias(id_col),
        F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias(group_col),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered_text(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text as a tampered copy holds it: in a third of the documents its A-Z are lower-cased."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(text_col, UPPER, LOWER)).otherwise(F.col(text_col))
