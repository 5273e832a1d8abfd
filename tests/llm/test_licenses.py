import random
import re

from earshot.llm.licenses import BASE, WINDOW, gate, rules, scan_licenses, whole_words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def scan(text):
    """The same rules, all tried at every word, and all pairs of detections compared."""
    w = words_of(text)
    base, found = [], []
    for i in range(len(w)):
        window = " ".join(w[i : i + WINDOW])
        for phrase, label in BASE.items():
            if w[i : i + len(phrase.split())] == phrase.split():
                base.append((i, label))
        for r in rules():
            match = re.match(whole_words(r.pattern), window)
            if match:
                found.append((i, i + len(match[1].split()), r.rank, r.label, r.weight))
                break
    kept = [
        d
        for d in found
        if not any(x[0] < d[0] and x[1] >= d[1] and x[2] <= d[2] or x[0] > d[0] and x[1] <= d[1] and x[2] < d[2] for x in found)
    ]
    labels = {label for _, label in base}
    return (
        len(w),
        len(base),
        base[0][0] if base else None,
        base[-1][0] if base else None,
        ",".join(sorted(labels)),
        [tuple(d) for d in kept],
        ",".join(sorted(labels | {d[3] for d in kept})),
        max([d[4] for d in kept], default=0.0),
    )


TEXTS = [
    None,
    "",
    " \n",
    "Plain words about the law of the land and the rights of people.",
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU GENERAL\npublic_license v2 or (at your option) any later version; GPLv3+, GPL-2.0-or-later, lgpl2.1",
    "Released under the MIT License. Licensed under CC BY-NC 4.0.",
    "CC BY cc-by cc by-sa 3.0, CC0 1.0; https://creativecommons.org/licenses/by-nd/2.5/",
    "SPDX-License-Identifier: Apache-2.0\n// SPDX-License-Identifier: MIT",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse it.",
    "gnugeneral public license, émit license, mit licenseé, 日本 MIT License 日本",
    "mit mit license license apache apache license",
    "The MIT and the BSD: 3-clause BSD, bsd 3 clause license, new bsd license. All rights reserved.",
    "mit license " * 20_000,
    "word " * 100_000 + "Apache License",
    "Released under the MIT License. Licensed under CC BY-NC 4.0.",
]


def made(docs):
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "detections", "labels", "score")
    out = {}
    for r in scan_licenses(docs).collect():
        values = [r[n] for n in names]
        values[5] = [tuple(d) for d in values[5]]
        out[r.doc_id] = tuple(values)
    return out


def test_equals_all_rules_at_all_words(docs_of):
    short = {i: t for i, t in enumerate(TEXTS) if len(t or "") < 1000}
    found = made(docs_of(TEXTS, "'mine' AS labels"))
    assert {i: found[i] for i in short} == {i: scan(t) for i, t in short.items()}


def test_very_long_texts(docs_of):
    found = made(docs_of(TEXTS))
    assert found[15][:5] == (40_000, 20_000, 0, 39_998, "mit") and len(found[15][5]) == 20_000
    assert found[16][:4] == (100_002, 1, 100_000, 100_000)


def test_labels_of_texts(docs_of):
    found = made(docs_of(TEXTS))
    assert found[3][6:] == ("", 0.0)
    assert found[4][6] == "apache,apache-2.0" and found[5][6] == "gpl,gpl-3.0"
    assert found[6][6] == "gpl,gpl-2.0-or-later,gpl-3.0,lgpl-2.1"
    assert found[7][6] == "cc-by,cc-by-nc-4.0,mit"
    assert found[9][6:] == ("apache-2.0,mit", 1.0)
    assert found[12][4] == "mit" and found[12][1] == 1


def sample(node, draw):
    """A text that a parsed pattern matches."""
    out = ""
    for op, arg in node:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "NOT_LITERAL":
            out += "x"
        elif name == "IN":
            kind, value = draw.choice(arg) if str(arg[0][0]) != "NEGATE" else ("LITERAL", ord("x"))
            out += chr(value) if str(kind) == "LITERAL" else chr(draw.randint(*value))
        elif name == "SUBPATTERN":
            out += sample(arg[-1], draw)
        elif name == "BRANCH":
            out += sample(draw.choice(arg[1]), draw)
        else:
            low, high, part = arg
            out += "".join(sample(part, draw) for _ in range(draw.randint(low, min(high, low + 8))))
    return out


def test_every_match_passes_the_gate_and_fits_the_window():
    draw, pattern = random.Random(1), re.compile(gate().replace("\\x{80}-\\x{10FFFF}", "\x80-\U0010ffff"))
    for rule in rules():
        parsed = re._parser.parse(rule.pattern)
        for _ in range(20):
            text = sample(parsed, draw)
            assert re.match(whole_words(rule.pattern), text), (rule, text)
            assert pattern.search(text.upper()) and pattern.search(f"x_{text}-"), (rule, text)
            assert len(text.split()) <= WINDOW and text.split()[0] in rule.keywords
    for plain in ("new rules for open business software", "the university of the public", "accc by mitt gnus"):
        assert not pattern.search(plain)


def test_hundreds_of_rules():
    assert len(rules()) >= 300
    assert len({r.pattern for r in rules()}) >= 0.95 * len(rules())


def test_other_columns_stay_and_empty_tables(docs_of):
    docs = docs_of(["MIT License"], "1 AS words").selectExpr("*", "2 AS found", "3 AS base", "4 AS kept", "5 AS word")
    row = scan_licenses(docs).first()
    assert (row.words, row.found, row.base, row.kept, row.word, row.labels) == (1, 2, 3, 4, 5, "mit")
    assert scan_licenses(docs.where("false")).count() == 0
