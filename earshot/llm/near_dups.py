"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.components import components
from earshot.llm.text import set_aside
from earshot.llm.words import constants, mix, ngram_hashes, text_words
from earshot.operators.sizing import broadcast_within, measured, scratch_path, staged

SHINGLE = 5
RANKS = 128
"""Length of a signature; the ranks are 16 bits wide, four of them make a band."""
BANDS = RANKS // 4
SLICE = 1 << 15
"""Shingles that are ranked at once."""
LIKELY = 0.6
"""Estimate below which a pair is not verified: four standard deviations below 0.75."""
BLOCK = 256
"""Documents of a bucket that are compared in one block."""
HASH_BYTES = 6
"""Bytes of a shingle's hash in a stored set: the upper ones, so that sets stay sorted."""
STEPS = constants(RANKS, 5)
SKETCH_ROWS = 2000
"""Texts whose sets a task holds at once."""


def shingles(words: np.ndarray) -> np.ndarray:
    """The distinct shingles of a text, hashed and sorted; fewer than five words make one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return ngram_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(ngram_hashes(words, SHINGLE))


def super_minhash(elements: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """The SuperMinHash signature of a set of hashes.

    Each element walks through a random permutation of the places: in step j it
    offers j plus a random fraction to its next place, and each place keeps its
    smallest offer. The steps are taken for all elements at once; they stop when
    no place could still be improved, which for large sets is after one or two.
    """
    best = np.full(ranks, np.inf)
    for low in range(0, len(elements), SLICE):
        part = elements[low : low + SLICE]
        order = None
        for j in range(ranks):
            if best.max() < j:
                break
            draws = mix(part + STEPS[j])
            offers = j + (draws >> np.uint64(11)).astype(np.float64) * 2.0**-53
            place = j + (mix(draws) % np.uint64(ranks - j)).astype(np.int64)
            if j == 0:
                first = place
                np.minimum.at(best, place, offers)
                continue
            rows = np.arange(len(part))
            if order is None:
                order = np.tile(np.arange(ranks, dtype=np.int16), (len(part), 1))
                order[rows, 0], order[rows, first] = first, 0
            taken = order[rows, place]
            order[rows, place] = order[rows, j]
            np.minimum.at(best, taken.astype(np.int64), offers)
    return best


def bands(signature: np.ndarray) -> np.ndarray:
    """Four ranks of 16 bits as one number, for each band."""
    ranks = mix(signature.view(np.uint64)).astype(np.uint16)
    return ranks.view(np.int64)


SKETCHED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("shingles", T.BinaryType()),
    ]
)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, node (hash of the whole set), bands and set of each text; the last column is the text."""
    salt = constants(1, 3)
    for batch in (b.slice(low, SKETCH_ROWS) for b in batches for low in range(0, b.num_rows, SKETCH_ROWS)):
        sizes, nodes, keys, sets = [], [], [], []
        for _, words, edges in text_words(batch.column(batch.num_columns - 1)):
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                found = shingles(words[low:high])
                sizes.append(len(found))
                if not len(found):
                    nodes.append(None)
                    keys.append(None)
                    sets.append(None)
                    continue
                total = np.bitwise_xor.reduce(mix(found + salt)) + np.uint64(len(found)) * salt
                nodes.append(int(mix(total).view(np.int64)[0]))
                keys.append(bands(super_minhash(found)))
                sets.append(found.view(np.uint8).reshape(-1, 8)[:, -HASH_BYTES:].tobytes())
        made = [
            pa.array(sizes, pa.int64()),
            pa.array(nodes, pa.int64()),
            pa.array(keys, pa.list_(pa.int64())),
            pa.array(sets, pa.binary()),
        ]
        names = batch.schema.names[:-1] + SKETCHED.names
        yield pa.RecordBatch.from_arrays(batch.columns[:-1] + made, names=names)


def unpack(stored: bytes) -> np.ndarray:
    wide = np.zeros((len(stored) // HASH_BYTES, 8), np.uint8)
    wide[:, -HASH_BYTES:] = np.frombuffer(stored, np.uint8).reshape(-1, HASH_BYTES)
    return wide.view(np.uint64).ravel()


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose full sets overlap enough."""
    for batch in batches:
        keep = []
        columns = (batch.column("left"), batch.column("right"))
        for left, right in zip(*(c.to_pylist() for c in columns), strict=True):
            a, b = unpack(left), unpack(right)
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= 75 * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets (``node``, ``shingles``) have a similarity of 0.75 or more."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(verify, "a bigint, b bigint")


def crossing_links(block: pa.Table) -> list[tuple[int, int]]:
    """Links between the rows of one block that are set apart and its rows of other components.

    The signatures tell whether a row has any likely partner in the block; then
    its overlaps with all sets of the block are counted at once. One link for
    each row and component is enough.
    """
    node, root = block.column("node").to_numpy(), block.column("root").to_numpy()
    lists = block.column("bands").combine_chunks()
    ranks = np.ascontiguousarray(lists.flatten().to_numpy()).view(np.uint16).reshape(-1, RANKS)
    sets = [unpack(x) for x in block.column("shingles").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    joined, starts = np.concatenate(sets), np.append(0, np.cumsum(sizes)[:-1])
    found = []
    for i in np.flatnonzero(block.column("apart").to_numpy()):
        other = root != root[i]
        if not (((ranks == ranks[i]).sum(axis=1) >= LIKELY * RANKS) & other).any():
            continue
        place = np.searchsorted(sets[i], joined)
        place[place == sizes[i]] = 0
        common = np.add.reduceat(sets[i][place] == joined, starts, dtype=np.int64)
        hits = np.flatnonzero(other & (100 * common >= 75 * (sizes + sizes[i] - common)))
        for k in np.unique(root[hits], return_index=True)[1]:
            found.append((int(node[i]), int(node[hits[k]])))
    return found


def confirm_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each block; rows come sorted by block, and one that runs on into the next batch is kept back."""
    kept: pa.Table | None = None

    def links(table: pa.Table) -> pa.RecordBatch:
        block = table.column("block").to_numpy()
        cuts = np.append(np.flatnonzero(np.diff(block)) + 1, len(block))
        found = []
        for low, high in zip(np.append(0, cuts[:-1]), cuts, strict=True):
            found += crossing_links(table.slice(low, high - low))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table])
        block = table.column("block").to_numpy()
        cut = int(np.argmax(block == block[-1]))
        if cut:
            yield links(table.slice(0, cut))
        kept = table.slice(cut)
    if kept is not None:
        yield links(kept)


def _dealt(rows: DataFrame, *more: DataFrame) -> DataFrame:
    """The classes of each region (``region``, ``node``, ``root``) with each ``block`` that they are compared in, and what ``more`` says of them.

    All classes of a region are cut into parts of about ``BLOCK``, those set
    apart also into parts of their own; each pair of such parts is a block. So a
    class is sent as often as the classes set apart fill parts, and one set
    apart also as often as the region does.
    """
    outside = F.col("root") != F.col("region")
    counted = rows.groupBy("region").agg(F.count("*").alias("n"), F.count_if(outside).alias("n_apart"))
    cuts = counted.select("region", *[F.ceil(F.col(n) / BLOCK).cast("int").alias(f"{n}_cuts") for n in ("n", "n_apart")])

    def own(cuts: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(cuts)).cast("int")

    def places(apart: bool) -> Column:
        across = F.sequence(F.lit(0), F.col("n_cuts" if apart else "n_apart_cuts") - 1)
        u, v = (lambda k: own("n_apart_cuts"), lambda k: k) if apart else (lambda k: k, lambda k: own("n_cuts"))
        return F.transform(across, lambda k: F.struct(u(k).alias("u"), v(k).alias("v"), F.lit(apart).alias("apart")))

    copies = F.explode(F.when(outside, F.concat(places(True), places(False))).otherwise(places(False)))
    dealt = reduce(lambda d, table: d.join(table, "node"), more, rows.join(cuts, "region"))
    carried = [c for table in more for c in table.columns if c != "node"]
    dealt = dealt.select("region", "node", "root", *carried, copies.alias("c"))
    return dealt.select(F.xxhash64("region", "c.u", "c.v").alias("block"), "node", "root", "c.apart", *carried)


def _crossing(buckets: DataFrame, classes: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Links between different components that share a bucket.

    In each bucket the largest component is set aside. All buckets with the same
    largest component make a region; its classes outside that component are
    compared with all its classes, in blocks of bounded size that hold the full
    sets, so that only links leave the tasks. A class of the largest component
    goes to as many blocks as the classes set apart fill, not to one for each
    part of the region.
    """
    spark = buckets.sparkSession
    rooted = buckets.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    rooted = staged(rooted, scratch_path(spark, "rooted"))
    parts = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max(F.struct("n", "root"))["root"].alias("region"))
    mixed = staged(sizes.where("parts > 1").select("bucket", "region"), scratch_path(spark, "mixed"))
    rows = rooted.join(mixed, "bucket").select("region", "node", "root").distinct()
    rows = staged(rows, scratch_path(spark, "regions"))
    blocks = _dealt(rows, classes.select("node", "bands"), sets)
    blocks = blocks.repartition("block").sortWithinPartitions("block")
    return blocks.mapInArrow(confirm_blocks, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of near-duplicate texts: ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for each row.

    Texts are linked if the sets of their distinct five-word shingles have a
    similarity of 0.75 or more. Equal sets are one class and become one node.
    Bands of the signatures put classes into buckets; each class is compared
    with the smallest class of each of its buckets, links are confirmed on the
    full sets, and union-find joins them. A second round compares the classes of
    a bucket that are still apart with all its others, in blocks. So a group is
    never paired off in full, and a class that is linked to any other of its
    bucket is found.

    ``component_id`` is the smallest id that can be reached; null ids count as
    larger than all others. A null text, or one without words, has no shingles,
    is linked with nothing and kept. Repeated rows are one class. Other columns
    of ``docs`` play no part. An empty table gives no rows.

    The steps are written to the shared folder, and the components are computed
    while the plan is built.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *SKETCHED])
    base = staged(rows.mapInArrow(sketch, schema), scratch_path(spark, "sketch"))

    classes = base.where("node IS NOT NULL").select("node", "bands").dropDuplicates(["node"])
    classes = staged(classes, scratch_path(spark, "classes"))
    keyed = classes.select("node", F.posexplode("bands").alias("band", "key"))
    keyed = keyed.select(F.xxhash64("band", "key").alias("bucket"), "node")
    leaders = keyed.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    buckets = keyed.join(leaders.select("bucket", "leader"), "bucket")
    buckets = staged(buckets, scratch_path(spark, "buckets"))

    known, n_known = measured(buckets.select("node").distinct())
    sets = base.select("node", "shingles").join(broadcast_within(known, n_known), "node", "left_semi")
    sets = sets.dropDuplicates(["node"])
    sets = staged(sets, scratch_path(spark, "sets"))

    stars = buckets.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    ranks_a = classes.select(F.col("node").alias("a"), F.col("bands").alias("bands_a"))
    ranks_b = classes.select(F.col("node").alias("b"), F.col("bands").alias("bands_b"))
    stars = stars.join(ranks_a, "a").join(ranks_b, "b").mapInArrow(estimate, "a bigint, b bigint")
    first = staged(linked(stars, sets), scratch_path(spark, "links"))
    roots = components(first)
    second = _crossing(buckets.select("bucket", "node"), classes, sets, roots)
    joined = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(second))

    members = base.select("doc_id", "n_shingles", "node").join(joined, "node", "left")
    members = members.select("doc_id", "n_shingles", F.coalesce("root", "node").alias("root"))
    grouped = members.where("root IS NOT NULL")
    ids = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = grouped.join(ids, "root").select("doc_id", "n_shingles", "component_id")
    alone = members.where("root IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose signatures agree in enough places."""
    for batch in batches:
        ranks = [
            np.ascontiguousarray(batch.column(c).flatten().to_numpy()).view(np.uint16).reshape(-1, RANKS)
            for c in ("bands_a", "bands_b")
        ]
        keep = (ranks[0] == ranks[1]).sum(axis=1) >= LIKELY * RANKS
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, all its columns unchanged.

    Of rows that repeat the id of a kept document one stays, the first by its
    text. A group in which every id is null keeps its rows. Null and empty texts
    are in no group; an empty table gives no rows.
    """
    return set_aside(docs, lambda d: _one_of_each(d, id_col, text_col), [id_col, text_col])


def _one_of_each(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kept = near_duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_kept_id"))
    counts, n = measured(kept.groupBy("_kept_id").agg(F.count("*").alias("_copies")))
    chosen = docs.join(counts, F.col(id_col).cast("bigint").eqNullSafe(F.col("_kept_id")))
    single = chosen.where("_copies = 1 OR _kept_id IS NULL")
    again = chosen.where("_copies > 1 AND _kept_id IS NOT NULL").dropDuplicates(["_kept_id"])
    return single.unionByName(again).drop("_kept_id", "_copies")
