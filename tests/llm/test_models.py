import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from llm_words import words

from earshot.llm import decontaminate, lm_score, token_counts
from earshot.llm.lm_score import lm_scores

needs_vocabulary = pytest.mark.skipif(not Path(token_counts.VOCABULARY).exists(), reason="no vocabulary file")


# --- decontamination


def smith_waterman(item, passage):
    best, above = 0, [0] * (len(passage) + 1)
    for x in item:
        row = [0]
        for j, y in enumerate(passage):
            row.append(max(0, above[j] + (1 if x == y else -1), above[j + 1] - 1, row[-1] - 1))
            best = max(best, row[-1])
        above = row
    return best


def test_alignment_equals_plain_python():
    draw = np.random.default_rng(3)
    for _ in range(200):
        a, b = (draw.integers(0, 5, draw.integers(1, 14)).astype(np.uint64) for _ in range(2))
        score, low, high = decontaminate.align(a, b)
        assert score == smith_waterman(a.tolist(), b.tolist())
        assert score == 0 or smith_waterman(a.tolist(), b[low:high].tolist()) == score


def test_copies_and_edited_copies_are_found(spark, docs_of):
    draw = random.Random(2)
    vocabulary = [f"v{i}" for i in range(3000)] + ["the", "of"] * 400
    items = [" ".join(draw.choices(vocabulary, k=30)) for _ in range(20)] + ["too short", None, "v1 v2 v3 v4 v5"]
    texts, leaked = [], set()
    for i in range(300):
        text = draw.choices(vocabulary, k=draw.randint(0, 300))
        if i % 10 == 0:
            k = draw.randrange(20)
            copy = items[k].upper().split()
            for _ in range(i % 4):
                del copy[draw.randrange(len(copy))]
                copy[draw.randrange(len(copy))] = "edited"
            at = draw.randint(0, len(text))
            text[at:at] = copy
            leaked.add((i, k))
        texts.append(" ".join(text))
    texts += [None, "", items[3] + " x " + items[3], items[5]]
    leaked |= {(302, 3), (303, 5)}
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = docs_of(texts + [texts[0]], "1 AS matches")
    leaked |= {(304, k) for i, k in leaked if i == 0}
    found = decontaminate.leaked_pairs(decontaminate.benchmark_matches(docs, bench)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaked
    assert sum(r.doc_id == 302 for r in found) in (1, 2)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == set(range(305)) - {i for i, _ in leaked} and kept.columns == docs.drop("matches").columns


def test_short_items_match_in_full_and_each_copy_counts(spark, docs_of):
    long = " ".join(f"z{i}" for i in range(20))
    items = ["who is the president of the united states", "name one sea", "a b c d e", long]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    texts = ["many of the united states have laws", "Who is the president of the United States ?", "Name one SEA", "please name one sea now", "x a b c y"]
    docs = docs_of([*texts, f"{long} x {long}"])
    found = decontaminate.leaked_pairs(decontaminate.benchmark_matches(docs, bench)).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.end) for r in found) == [(1, 0, 0, 8), (2, 1, 0, 3), (5, 3, 0, 20), (5, 3, 21, 41)]


def test_blocks_of_items_give_the_same(spark, docs_of, monkeypatch):
    items = [f"a{i} b{i} c{i} d{i} e{i} f{i}" for i in range(9)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = docs_of([f"x {t} y" for t in items])
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    found = decontaminate.leaked_pairs(decontaminate.benchmark_matches(docs, bench)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in range(9)}
    none = decontaminate.benchmark_matches(docs.where("false"), bench)
    assert none.count() == 0
    assert decontaminate.benchmark_matches(docs, bench.where("false")).where("size(matches) > 0").count() == 0


# --- language model


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def corpus(n):
    draw = random.Random(4)
    follow = {f"w{i}": [f"w{draw.randrange(300)}" for _ in range(3)] for i in range(300)}
    texts = []
    for _ in range(n):
        word, text = "w0", []
        for _ in range(draw.randint(0, 80)):
            word = draw.choice(follow[word])
            text.append(word.upper() if draw.random() < 0.1 else word)
        texts.append(" ".join(text + [f"rare{draw.randrange(10**6)}"] * draw.randint(0, 2)))
    return texts + [None, "", "unseen " * 3000]


@pytest.mark.parametrize("common", [lm_score.COMMON, 2e-3])
def test_base_scores_are_exact_and_the_model_is_better(docs_of, monkeypatch, common):
    monkeypatch.setattr(lm_score, "COMMON", common)
    texts = [*enumerate(corpus(400)), (None, "w1 w2"), (3, "w1 w2"), (3, "w1 w2")]
    tokens = [[*words(t), "\n"] for _, t in texts]
    counts = Counter(w for (i, _), ws in zip(texts, tokens) if not is_held_out(i) for w in ws)
    total = sum(counts.values())
    log = lambda w: math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1)))
    want = sorted(
        ((str(i), is_held_out(i), len(ws), sum(counts[w] > 0 for w in ws), total, round(sum(map(log, ws)), 6)) for (i, _), ws in zip(texts, tokens))
    )
    out = lm_scores(docs_of(texts, "1 AS score")).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    held = [r for r in out if r.held_out and r.n_tokens < 1000]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def test_pairs_of_rare_words_are_learned(docs_of, monkeypatch):
    """Scores do not depend on what is common; nearly all tokens here are in pairs of words that are not."""
    draw = random.Random(9)
    words = [f"w{i}" for i in range(900)]
    phrases = [" ".join(draw.sample(words, 8)) for _ in range(60)]
    texts = [" ".join(draw.choices(phrases, k=12)) for _ in range(250)]
    want = {r.doc_id: r.score for r in lm_scores(docs_of(texts)).collect()}
    monkeypatch.setattr(lm_score, "COMMON", 1e-2)
    found = {r.doc_id: r.score for r in lm_scores(docs_of(texts)).collect()}
    assert found == pytest.approx(want) and len(found) == 250


def test_levels_come_back_from_the_filter(spark):
    import pyarrow as pa

    keys = lm_score.mix(np.arange(1, 5001, dtype=np.uint64))
    counts = np.random.default_rng(1).zipf(1.5, 5000).clip(1, 10**6)
    shard = (keys % np.uint64(64)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    batch = pa.RecordBatch.from_arrays(
        [pa.array(keys[order].view(np.int64)), pa.array(counts[order]), pa.array(np.ones(5000, bool)), pa.array(shard[order])],
        names=["key", "n", "word", "shard"],
    )
    parts, sizes = [b""] * 64, np.zeros(64, np.int64)
    for out in lm_score.build_filter(1 << 24)(iter([batch.slice(0, 777), batch.slice(777)])):
        for s, bits in zip(out.column("shard").to_pylist(), out.column("bits").to_pylist()):
            parts[s], sizes[s] = bits, 8 * len(bits)
    model = (np.frombuffer(b"".join(parts), np.uint8), np.append(0, np.cumsum(sizes // 8)[:-1]), sizes)
    found, want = lm_score.levels(model, keys), lm_score.level_of(counts)
    assert (found >= want).all() and (found == want).mean() > 0.97
    absent = lm_score.levels(model, lm_score.mix(np.arange(10**6, 10**6 + 20000, dtype=np.uint64)))
    assert (absent > 0).mean() < 0.03


def test_a_filter_too_large_to_send_gives_the_same_scores(docs_of, monkeypatch):
    draw = random.Random(8)
    texts = [" ".join(f"w{int(draw.paretovariate(0.6))}" for _ in range(draw.randint(0, 60))) for _ in range(400)] + [None, ""]
    want = {r.doc_id: r for r in lm_scores(docs_of(texts)).collect()}
    monkeypatch.setattr(lm_score, "MAX_BYTES", 64)
    found = lm_scores(docs_of(texts)).collect()
    assert sorted(r.doc_id for r in found) == sorted(want) and len(found) == len(texts)
    for r in found:
        assert r.score == pytest.approx(want[r.doc_id].score, rel=1e-9) and r.base_score == pytest.approx(want[r.doc_id].base_score, rel=1e-9)


def test_positions_and_levels_equal_plain_probing():
    """Positions are remainders at the edges too; levels are those of one key after the other, whatever is probed together."""
    draw = np.random.default_rng(5)
    bits = np.concatenate([np.full(300, 64), 8 * draw.integers(8, 1 << 18, 300), 8 * draw.integers(1 << 30, 1 << 40, 300)]).astype(np.uint64)
    factor = draw.integers(0, (1 << 56) // bits, dtype=np.uint64) * bits
    top = np.full(len(bits), (1 << 56) - 1, np.uint64)
    for x in (factor, np.maximum(factor, np.uint64(1)) - np.uint64(1), factor + np.uint64(1), top, top // bits * bits, np.zeros_like(bits)):
        assert (lm_score.position(x << np.uint64(8), bits, lm_score.inverse_of(bits)) == (x % bits).astype(np.int64)).all()

    sizes = 64 * draw.integers(0, 40, 128)
    offsets = np.append(0, np.cumsum(sizes // 8)[:-1])
    data = np.packbits(draw.random(int(sizes.sum())) < 0.93)
    keys = np.unique(lm_score.mix(np.arange(1, 70001, dtype=np.uint64)))

    def plain(key):
        start, size, mask = 8 * int(offsets[key % 128]), int(sizes[key % 128]), (1 << 64) - 1
        for level in range(1, lm_score.LEVELS if size else 1):
            probe = lm_score.first_probe(np.array([key], np.uint64), level)
            first, step = int(probe[0]), int(lm_score.step_of(probe)[0])
            at = [start + (((first + k * step) & mask) >> 8) % size for k in range(lm_score.PROBES)]
            if not all(data[x >> 3] >> (x & 7) & 1 for x in at):
                return level - 1
        return lm_score.LEVELS - 1 if size else 0

    found = lm_score.levels((data, offsets, sizes), keys)
    some = draw.integers(0, len(keys), 1500)
    assert found[some].tolist() == [plain(int(k)) for k in keys[some]] and found.max() > lm_score.LEVELS_AT_ONCE


@pytest.mark.parametrize("groups", [64, 256])
def test_counts_travel_in_packets_not_one_by_one(groups):
    """A row for each group and batch meets the shuffle, however many pairs there are; all counts arrive."""
    import pyarrow as pa

    texts = pa.array(corpus(300) + ["w1 w2 " * 500])
    batches = [pa.RecordBatch.from_arrays([x], names=["text"]) for x in (texts, texts.slice(7, 100), texts.slice(0, 0))]
    flat = pa.Table.from_batches(lm_score.count_pairs(iter(batches))).to_pydict()
    want = Counter()
    for key, n in zip(flat["key"], flat["n"]):
        want[key] += n
    made = pa.Table.from_batches(lm_score.packed(groups, lm_score.count_pairs)(iter(batches)))
    assert len(flat["key"]) > 5 * groups >= 5 * made.num_rows
    rows = made.append_column("word", pa.array([False] * made.num_rows)).sort_by("group").to_batches(max_chunksize=50)
    got, order = Counter(), []
    for out in lm_score.unpacked(256)(iter(rows)):
        shard, keys = out.column("shard").to_pylist(), out.column("key").to_pylist()
        assert shard == sorted(shard) == sorted(k & 255 for k in keys) and len({s % groups for s in shard}) == 1
        order.append(shard[0] % groups)
        for key, n in zip(keys, out.column("n").to_pylist()):
            got[key] += n
    assert got == want and len(order) == len(set(order))


def test_rare_tokens_are_those_of_each_text():
    import pyarrow as pa

    draw = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in draw.zipf(1.3, n)) for n in draw.integers(0, 2000, 300)] + [None, ""]
    pieces = list(lm_score.tokens_of(pa.array(texts), 60000))
    assert len(pieces) > 3 and [p[0] for p in pieces] == np.cumsum([0] + [len(p[2]) - 1 for p in pieces])[:-1].tolist()
    assert sum(len(p[2]) - 1 for p in pieces) == len(texts)
    for _, tokens, starts in pieces:
        for rare in (tokens % np.uint64(3) == 0, np.zeros(len(tokens), bool), np.ones(len(tokens), bool)):
            words_, times, sizes = lm_score.rare_tokens(tokens, starts, rare)
            at = 0
            for a, b, size in zip(starts[:-1], starts[1:], sizes, strict=True):
                keys, counts = np.unique(tokens[a:b][rare[a:b]], return_counts=True)
                assert words_[at : at + size].tolist() == keys.view(np.int64).tolist() and times[at : at + size].tolist() == counts.tolist()
                at += size
            assert at == len(words_)


def test_no_rows_and_no_training_texts(docs_of):
    assert lm_scores(docs_of(["a"]).where("false")).count() == 0
    held = next(i for i in range(100) if is_held_out(i))
    [row] = lm_scores(docs_of([(held, "a b")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (3, 0, 0, True)
    assert row.base_score == pytest.approx(0) and row.score <= 0


# --- token counts


@needs_vocabulary
def test_counts_after_edits_equal_full_counts(docs_of):
    count = token_counts.counter(token_counts.read_ranks(token_counts.VOCABULARY))
    draw = random.Random(6)
    parts = ["word", " ", "  ", "\n", "'s", "'", "re", ".", "12", "é", "💡", "中文", "\t", " a b", "x" * 40]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 400))) for _ in range(60)] + [None, "", " ", "long text of words " * 4000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s")]
    counted = token_counts.count_tokens(docs_of(rows, "1 AS n_tokens"))
    edits = {}
    for i, t in enumerate(texts):
        n = len(t or "")
        edits[i] = [(a := draw.randint(-3, n + 3), a + draw.randint(0, 15), draw.choice(parts + [""])) for _ in range(draw.randint(0, 4))]
    edits[0] = None
    spark = counted.sparkSession
    table = spark.createDataFrame([(i, e) for i, e in edits.items()], f"doc_id bigint, edits {token_counts.EDITS}")
    out = token_counts.recount_tokens(counted.join(table, "doc_id")).collect()
    assert len(out) == len(rows)
    for r in out:
        text = texts[r.doc_id] or ""
        asked = [{"start": a, "end": b, "text": c} for a, b, c in edits[r.doc_id] or ()]
        for a, b, new in reversed(token_counts.valid_edits(asked, len(text))):
            text = text[:a] + new + text[b:]
        assert (r.text, r.n_tokens) == (text, count(text))
        assert r.tree.tokens[1] == r.n_tokens and r.tree.chars[1] == len(text)
    long = next(r for r in out if r.doc_id == 63)
    assert long.n_reencoded < 4 * 700


@needs_vocabulary
def test_no_texts(docs_of):
    assert token_counts.count_tokens(docs_of(["a"]).where("false")).count() == 0
