import re
from collections import Counter

import pytest

from earshot.llm.clean_lines import clean_lines
from earshot.llm.mixing import mix_sources

WORD = re.compile(r"[^\x20\x09-\x0D]+")
GOOD = "The first sentence of a plain text stands here and goes on for a while, so that it counts. Then another one ends it."
MORE = "Other words follow in this place, which say something else and are all new. They end here."
TEXTS = [
    GOOD,
    GOOD + "\nHome | News | Sports | Shop | About\n" + MORE,
    "Home | News | Sports | Shop | About | Contact | Help | More | Jobs | Press\n" * 3 + GOOD,
    "WOW!! BUY!! NOW!! " * 12,
    "x*** y### z$$$ " * 15,
    GOOD + "\nAll rights reserved.\n" + GOOD + "\n \n" + GOOD,
    "again and again the same eight words come back " * 9,
    None,
    "",
    " \n\t\n",
    "é💡 # * % " + "w " * 30,
    "word " * 30000,
    GOOD,
]


def base(text):
    w = WORD.findall(text or "")
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts_equal_plain_python(docs_of):
    docs = docs_of(TEXTS, "'mine' AS n_words")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in clean_lines(docs).collect():
        assert tuple(r[n] for n in names) == base(TEXTS[r.doc_id]), r.doc_id


def test_lines_and_verdict(docs_of):
    found = {r.doc_id: r for r in clean_lines(docs_of(TEXTS)).collect()}
    assert {i for i, r in found.items() if r.kept} == {0, 1, 12}
    assert found[1].line_faults == {"navigation": 1} and "|" not in found[1].clean_text
    assert found[5].line_faults == {"boilerplate": 1} and "reserved" not in found[5].clean_text
    assert found[3].line_faults == {"punctuation": 1} and found[4].line_faults == {"symbols": 1}
    assert found[7].clean_text == "" and not found[7].kept


def test_a_filter_on_the_verdict_repeats_no_expression(docs_of):
    plan = clean_lines(docs_of(TEXTS)).where("kept").select("doc_id", "clean_text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 2


def test_no_rows(docs_of):
    none = docs_of(TEXTS).where("false")
    assert clean_lines(none).count() == 0 and mix_sources(none).count() == 0


def expected_targets(sizes, most=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    left = total
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("block", [1, 16])
def test_mix_meets_targets(docs_of, block):
    rows = []
    for source, n, length in (("a", 200, 90), ("b", 40, 30), ("c", 5, 20), ("é", 60, 200), (None, 30, 50), ("void", 3, 0)):
        rows += [(len(rows) + i, " ".join(["w"] * (length + i % 7 if length else 0)), source) for i in range(n)]
    rows += [(None, "x y z", "a"), (1, "x y", "a"), (1, "x y", "a"), (9999, None, "b")]
    docs = docs_of(rows, "7 AS taken")
    mixed = mix_sources(docs, block_words=block)
    out = mixed.collect()
    assert len(out) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in out)
    assert Counter((r.doc_id, r["size"]) for r in out) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    want = expected_targets({s: sizes[s] for s in {r.source for r in out}})
    shards = {s: 1 + sum(r.source == s for r in out) ** 0.5 for s in sizes}
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert abs(taken[r.source] - want[r.source]) <= block * (1 + shards[r.source])
    assert sorted(map(str, mix_sources(docs.repartition(7), block_words=block).collect())) == sorted(map(str, out))


def test_seats_go_to_the_highest_quotients(spark):
    from pyspark.sql import functions as F

    from earshot.llm.mixing import sainte_lague

    votes = {"a": 53000.0, "b": 24000.0, "c": 23000.0, "d": 0.0}
    parties = spark.createDataFrame([(k, v, 1) for k, v in votes.items()], "p string, v double, g int")
    for seats in (0, 1, 7, 40):
        quotients = sorted(((-v / (2 * s + 1), k) for k, v in votes.items() for s in range(seats)))[:seats]
        want = Counter(k for _, k in quotients)
        got = sainte_lague(parties, ["g"], "v", F.lit(seats), F.lit(10**9), ["p"], "n").collect()
        assert {r.p: r.n for r in got} == {k: want[k] for k in votes}


def test_sources_of_small_documents_meet_their_targets(docs_of):
    """A hundred documents of one word, four hundred of two, a single one of five, one of empty texts, a large source."""
    docs = [(i, "w", "a") for i in range(100)] + [(1000 + i, "w " * 40, "b") for i in range(900)]
    docs += [(3000 + i, "w w", "c") for i in range(400)] + [(5000, "one two three four five", "d")]
    docs += [(6000 + i, None, "e") for i in range(50)] + [(7000 + i, "w " * (i % 7), "f") for i in range(3000)]
    out = mix_sources(docs_of(docs)).collect()
    sources, taken, target = {r.doc_id: r.source for r in out}, {}, {}
    for r in out:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert len(sources) == len(docs) and taken["d"] == 15 and taken["e"] == 0
    assert {s: abs(taken[s] - target[s]) <= 16 for s in taken} == dict.fromkeys(taken, True)
