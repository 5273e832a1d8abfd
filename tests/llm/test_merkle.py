import hashlib
import random
import zlib

import pytest

from earshot.llm.merkle import COLUMNS, lowered_text, merkle_manifest

NAMES = ("doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = nodes[i - i % 8 :][:8]
        out.append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        i //= 8
    return out


def brute_force(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = {g: levels([leaf_of(r) for r in members]) for g, members in groups.items()}
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path = siblings(trees[g], i) + siblings(top, k)
            now = dict(r)
            if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                now["text"] = r["text"].translate({c: c + 32 for c in range(65, 91)})
            node = leaf_of(now)
            for left, right in path:
                node = digest(left + node + right)
            proof = digest("".join(left + right for left, right in path))
            out.append((r["doc_id"], g, leaf_of(r), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def made(docs, **options):
    out = merkle_manifest(docs, found={"text": lowered_text()}, **options)
    return sorted([tuple(r[n] for n in NAMES) for r in out.collect()], key=repr)


def checked(docs, **options):
    assert made(docs, **options) == brute_force([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("max_rows", [10_000_000, 50])
def test_nulls_ties_repeats_and_ids_of_any_size(spark, max_rows):
    draw = random.Random(3)
    ids = [None, 5, 7, 7, -3, 2**62, -(2**63), 2**63 - 1]
    texts, langs = [None, "", "Ab", "x" * 50, "é"], [None, "", "en", "é", "Z"]
    rows = [
        (draw.choice([*ids, draw.randrange(-200, 200)]), draw.choice(texts), draw.choice(langs), draw.choice([None, "s"]), draw.choice([None, 1]))
        for _ in range(1500)
    ]
    checked(spark.createDataFrame(rows, SCHEMA), max_rows=max_rows)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 513, 4100])
def test_sizes_of_a_tree(spark, n):
    rows = [(3 * i, f"Text {i}", "en", "s", i) for i in range(n)] + [(i, "B", f"l{i}", "s", 0) for i in range(min(n, 20))]
    checked(spark.createDataFrame(rows, SCHEMA))


def test_long_texts_and_clashing_columns(spark):
    rows = [(i, "Long WORDS " * 100_000, "en", "s", i) for i in range(3)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"1 AS {c}" for c in ("grp", "id", "leaf", "place", "node", "root", "now")])
    checked(docs)


def test_what_is_not_changed_verifies(spark):
    docs = spark.createDataFrame([(i, f"T{i}", "en", "s", i) for i in range(70)], SCHEMA)
    assert {r.verified for r in merkle_manifest(docs).collect()} == {True}
    other = docs.selectExpr("doc_id", "CASE WHEN doc_id = 9 THEN 'x' ELSE text END AS text", "lang", "source", "n_chars")
    roots = {r.root for d in (docs, other) for r in merkle_manifest(d).collect()}
    assert len(roots) == 2
