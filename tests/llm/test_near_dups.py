import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm.components import components
from earshot.llm.near_dups import RANKS, _dealt, drop_near_duplicates, near_duplicates, super_minhash
from llm_words import words


def shingle_set(text):
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute_force(docs):
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(docs)), 2):
        common, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if common and 100 * common >= 75 * union:
            root[find(a)] = find(b)
    groups = {}
    for i, (doc_id, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(doc_id)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(
        ((d, len(sets[i]), d if not sets[i] else low[find(i)]) for i, (d, _) in enumerate(docs)), key=str
    )


def made(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in docs.collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(docs_of, seed):
    """Groups of edited copies around the threshold, chains, exact copies, short and empty texts, nulls, repeated rows."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(8):
        base = draw.choices(vocabulary, k=draw.randint(30, 150))
        for _ in range(draw.randint(1, 14)):
            copy = list(base)
            for _ in range(draw.randint(0, 5)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            docs.append(" ".join(copy))
    docs += ["", " \n", None, "one two", "ONE  two", "one two three four five", "one two", "é ü", "x" * 5000]
    docs = list(enumerate(docs)) + [(None, docs[0]), (3, docs[3])]
    assert made(near_duplicates(docs_of(docs))) == brute_force(docs)


def test_large_group_around_the_threshold(docs_of):
    """One bucket of many copies of which only some are linked, so that blocks are compared."""
    draw = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    docs = []
    for i in range(400):
        copy = list(base)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(60)] = f"x{i}-{draw.randrange(1000)}"
        docs.append((i, " ".join(copy)))
    assert made(near_duplicates(docs_of(docs))) == brute_force(docs)


def test_rows_sent_follow_the_group(spark):
    """A region of twice the classes, as many of them apart, sends about twice the rows; each pair to compare meets."""

    def dealt(n):
        return _dealt(spark.range(n).selectExpr("1L AS region", "id AS node", "IF(id % 50 = 7, id, 1) AS root"))

    sent = [dealt(n).count() for n in (2000, 4000, 8000)]
    assert sent[1] <= 2.5 * sent[0] and sent[2] <= 2.5 * sent[1] and sent[2] <= 3 * 8000
    rows = dealt(2000)
    ours = rows.where("apart").select("block", F.col("node").alias("a"))
    met = ours.join(rows.where("NOT apart").select("block", F.col("node").alias("b")), "block")
    assert met.count() == 40 * 2000 and met.select("a", "b").distinct().count() == 40 * 2000


def test_one_of_each_group_stays(docs_of):
    copies = "a b c d e f g h i j k l m n"
    docs = docs_of([(5, copies), (2, copies), (2, copies), (7, "other text of five words"), (8, None)], "1 AS _kept_id2")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 8]


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([(1, "a")]).where("false")).count() == 0


def sequential(elements, m):
    """SuperMinHash element by element, for the same random draws."""
    from earshot.llm.near_dups import STEPS
    from earshot.llm.words import mix

    best = [float("inf")] * m
    for e in elements:
        order = list(range(m))
        for j in range(m):
            draw = mix(np.array([e], np.uint64) + STEPS[j])
            k = j + int((mix(draw) % np.uint64(m - j))[0])
            order[j], order[k] = order[k], order[j]
            offer = j + float((draw >> np.uint64(11))[0]) * 2.0**-53
            best[order[j]] = min(best[order[j]], offer)
    return best


@pytest.mark.parametrize("n", [1, 7, 300])
def test_signature_equals_the_sequential_algorithm(n):
    elements = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert super_minhash(elements).tolist() == sequential(elements, RANKS)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (500, 499)]
    found = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}, 499: 499, 500: 499}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
