import random
import re
import zlib
from collections import Counter

import pytest

from earshot.llm import fm_index, spelling
from earshot.llm.fm_index import WordIndex, one_edit, sorted_rotations
from earshot.llm.spelling import near_words, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def edits(word, letters):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + word[i + 1 :]} if i < len(word) else set()
        out |= {word[:i] + c + word[i:] for c in letters}
        out |= {word[:i] + c + word[i + 1 :] for c in letters if i < len(word)}
    return out - {word}


def brute_force(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    letters = {c for w in n for c in w}
    near = {w: [x for x in edits(w, letters) if x in n] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def made(docs):
    out = spelling_variants(docs)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("few", [0, 1, 8])
def test_search_equals_comparing_all_words(monkeypatch, few):
    monkeypatch.setattr(fm_index, "FEW", few)
    for seed in range(15):
        draw = random.Random(seed)
        letters = "abé"[: draw.randint(1, 3)]
        words = sorted({"".join(draw.choices(letters, k=draw.randint(1, 9))) for _ in range(draw.choice([1, 2, 30, 150]))})
        queries = words + ["".join(draw.choices(letters + "z", k=draw.randint(2, 9))) for _ in range(20)]
        exact = [len(q) // 2 for q in queries]
        found = list(WordIndex(words).near(queries, exact))
        want = {(i, k) for i, q in enumerate(queries) for k, t in enumerate(words) if t in edits(q, "abéz") and t.startswith(q[: exact[i]])}
        assert set(found) == want and len(found) == len(want)


def test_rotations_and_edits():
    import numpy as np

    draw = random.Random(2)
    for n in (1, 2, 50, 400):
        text = [0] + [draw.randint(1, 2) for _ in range(n)]
        rotations = sorted(range(len(text)), key=lambda i: text[i:] + text[:i])
        assert sorted_rotations(np.array(text)).tolist() == rotations
    for _ in range(500):
        a, b = ("".join(draw.choices("ab", k=draw.randint(0, 5))) for _ in range(2))
        assert one_edit(a, b) == (b in edits(a, "ab"))


@pytest.mark.parametrize("block", [200_000, 60])
def test_equals_brute_force(spark, monkeypatch, block):
    """Chains of variants, ties, words of the same beginning, accents, noise; blocks of a few words, too."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    draw = random.Random(block)
    stems = ["".join(draw.choices("abcdeé", k=draw.randint(5, 9))) for _ in range(25)] + ["commonstart" + c for c in "abcdef"]
    pool = []
    for stem in stems:
        pool += [stem] * draw.choice([1, 8, 60])
        for variant in draw.sample(sorted(edits(stem, "abé")), 4):
            pool += [variant] * draw.choice([1, 2, 10])
    rows = [(i, " ".join(draw.choices(pool, k=60)).replace("ab", "AB")) for i in range(150)]
    rows += [(None, "ÉCOLES écoles Écoles × ÷÷÷÷÷÷ Ünïcödé ünïcödé"), (7, None), (8, ""), (9, "12 _ ﬁ"), rows[0], rows[0]]
    assert made(frame(spark, rows)) == brute_force(rows)


def test_noise_and_thresholds(spark):
    rows = [(i, "marvellous marvellous elephants elephant") for i in range(400)] + [(1000 + i, "rarest short") for i in range(4)]
    found = made(frame(spark, rows))
    assert found == brute_force(rows)
    by_word = {r[0]: r for r in found}
    assert "rarest" not in by_word and "short" not in by_word
    assert by_word["elephant"][4] >= 1 and by_word["elephants"][1] is None


def test_very_long_runs_and_empty_tables(spark):
    rows = [(i, "a" * 30_000 + " " + "a" * 30_001 + " x") for i in range(5)]
    found = made(frame(spark, rows))
    assert [(len(r[0]), r[4]) for r in found] == [(30_000, 1), (30_001, 1)] or found == brute_force(rows)
    assert spelling_variants(frame(spark, rows).where("false")).count() == 0
    assert spelling_variants(frame(spark, [(1, None)])).count() == 0


def test_other_columns_do_not_clash(spark):
    rows = [(i, "letters lettres letter") for i in range(9)]
    docs = frame(spark, rows).selectExpr("*", *[f"'x' AS {c}" for c in ("id", "word", "n", "s", "block", "near", "root")])
    assert made(docs) == brute_force(rows)


def test_each_pair_once(spark):
    words = spark.createDataFrame([(w, 9) for w in ("aaaaaa", "aaaaaaa", "aaaaab", "baaaaa", "caaaaa", "aaacaaa")], "word string, n bigint")
    pairs = [(r.word, r.near) for r in near_words(words).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a, b in pairs if one_edit(a, b)}
    assert {("aaaaaa", "baaaaa"), ("baaaaa", "aaaaaa"), ("aaaaaa", "aaacaaa"), ("baaaaa", "caaaaa")} <= set(pairs)
