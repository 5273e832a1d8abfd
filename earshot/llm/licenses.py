"""License scans by ordered signature rules over the words of a text.

A text is cut into lower-case words. A rule is a pattern over words with one
space between them, and begins with a keyword (or one of a few), so that rules
are tried only where one of their keywords stands, and texts without any keyword
are left after one search. Of several rules that match at a word the first in
rank wins; of two detections of which one lies within the other, the one of
lower rank goes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import whole

# fixed values: words, phrases and their labels
WORD_CHARS = r"0-9A-Za-z\x{80}-\x{10FFFF}"
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

WINDOW = 24
"""Words that a rule may span; each rule's pattern fits into them."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Signatures: label, weight, pattern. LIC stands for the word license in several languages.
LIC = "(?:licen[cs]es?|licen[cs]ed|lizenz|licencia|licenza|licenca)"
RARE = ("domain", "reserved", "hereby", "endorse", "misrepresented", "commons", "unencumbered")
NOTICES = """
mit            0.95 permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
mit            0.95 permission is hereby granted free of charge to any person obtaining a copy
mit-0          0.95 permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal
isc            0.95 permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided
0bsd           0.95 permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
hpnd           0.95 permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? (?:is hereby granted )?without fee
postgresql     0.95 permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
bsd            0.9  redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause   0.9  neither the name of (?:the )?(?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse
bsd-4-clause   0.95 advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
unlicense      0.95 unencumbered software released into the public domain
wtfpl          0.95 wtfpl(?: (?:version|v) ?2)?
wtfpl          0.95 fuck you want to public licen[cs]e
zlib           0.9  altered source versions must be plainly marked as such and must not be misrepresented as being the original
bsl-1.0        0.95 boost software licen[cs]e(?: version)?(?: v?1 0)?
beerware       0.95 (?:beerware|beer ware) licen[cs]e
gpl            0.9  foundation either version [123] of the licen[cs]e
cc0-1.0        0.95 waived all copyright and related or neighbou?ring rights
public-domain  0.9  dedicated(?: this work)? to the public domain
public-domain  0.8  released (?:in)?to the public domain
public-domain  0.8  placed in(?:to)? the public domain
agpl           0.85 affero general public licen[cs]e
proprietary    0.6  proprietary LIC
proprietary    0.6  proprietary (?:and confidential|software)
proprietary    0.6  unauthorized (?:copying|use|reproduction|distribution)(?: or [a-z]+)? of this (?:file|software|document|work)
all-rights-reserved 0.4 rights reserved
"""
NAMES = """
mit            0.9  mit (?:x11 |expat |style )?LIC
mit            0.85 expat LIC
mit            0.85 x11 LIC
mit-0          0.9  mit 0(?: LIC)?
mit-0          0.9  mit no attribution LIC
mit            0.8  (?:licencia|licenza|licence|lizenz) mit
mit            0.8  opensource org licenses mit
bsd-2-clause   0.9  bsd 2 clause(?: LIC)?
bsd-2-clause   0.9  simplified bsd LIC
bsd-2-clause   0.9  freebsd LIC
bsd-3-clause   0.9  bsd 3 clause(?: LIC)?
bsd-3-clause   0.9  (?:new|modified|revised) bsd LIC
bsd-4-clause   0.9  bsd 4 clause(?: LIC)?
bsd-4-clause   0.9  original bsd LIC
bsd-1-clause   0.9  bsd 1 clause(?: LIC)?
0bsd           0.9  0bsd(?: LIC)?
bsd            0.7  bsd (?:style |like )?LIC
isc            0.9  isc LIC
unlicense      0.8  unlicense
zlib           0.9  zlib(?: libpng)? LIC
libpng         0.9  libpng LIC
curl           0.9  curl LIC
ntp            0.9  ntp LIC
x11            0.7  xfree86 LIC
openssl        0.9  openssl LIC
ssleay         0.9  ssleay LIC
ncsa           0.9  (?:ncsa|university of illinois(?: ncsa)?)(?: open source)? LIC
sleepycat      0.9  sleepycat LIC
postgresql     0.9  postgresql LIC
php-3.01       0.9  php LIC(?: version| v)? 3 01
php-3.0        0.9  php LIC(?: version| v)? 3 0
php            0.8  php LIC
ruby           0.9  ruby LIC
vim            0.9  vim LIC
tcl            0.9  tcl(?: tk)? LIC
intel          0.8  intel open source LIC
icu            0.9  icu LIC
unicode        0.9  unicode(?: inc)? LIC
w3c            0.9  w3c software(?: notice)?(?: and)?(?: document)? LIC
nasa           0.9  nasa open source agreement
qpl-1.0        0.9  (?:q|qt) public LIC
ibm-public     0.9  ibm public LIC
sun-public     0.9  sun public LIC
nokia          0.9  nokia open source LIC
netscape       0.9  netscape public LIC
common-public  0.9  common public LIC
academic       0.7  academic free LIC
open-software  0.7  open software LIC
ms-pl          0.9  microsoft public LIC
ms-pl          0.9  ms pl
ms-rl          0.9  microsoft reciprocal LIC
ms-rl          0.9  ms rl
elastic        0.9  elastic LIC
sspl           0.9  server side public LIC
sspl           0.9  sspl
busl           0.9  business source LIC
busl           0.9  busl
commons-clause 0.9  commons clause
openrail       0.9  openrail(?: m| s)?(?: LIC)?
openrail       0.9  creativeml (?:openrail|open rail)(?: m)?
llama          0.8  llama [234] community LIC
gemma          0.7  gemma terms of use
bigscience     0.9  bigscience (?:bloom )?rail
odbl           0.9  open database LIC
odbl           0.9  odbl
odc-by         0.9  open data commons attribution LIC
odc-by         0.9  odc by
pddl           0.9  public domain dedication and LIC
pddl           0.9  pddl
cdla           0.9  cdla (?:permissive|sharing)
ogl            0.9  open government LIC
etalab         0.9  etalab(?: 2 0)?
ofl            0.8  (?:sil )?ofl
ofl            0.85 (?:sil )?open font LIC
ofl            0.85 sil open font LIC
gfdl           0.8  (?:gfdl|gnu fdl)
gfdl           0.8  gnu free documentation LIC
lgpl           0.8  gnu (?:lesser|library)(?: general)? public LIC
lgpl           0.7  (?:lgpl|gnu lgpl)
agpl           0.8  gnu affero(?: general)? public LIC
agpl           0.7  (?:agpl|gnu agpl)
gpl            0.75 gnu general public LIC
gpl            0.7  (?:gpl|gnu gpl)
gpl            0.6  gnu LIC
gpl            0.6  (?:licencia|licenza|licence|lizenz) (?:publica? )?(?:generale? )?gnu
apache         0.75 apache(?: software)?(?: foundation)? LIC
apache         0.6  (?:licencia|licenza|licence|lizenz) apache
apache-2.0     0.95 apache org licenses license 2 0
mpl            0.75 mozilla public LIC
epl            0.75 eclipse public LIC
eupl           0.75 european union public LIC
cddl           0.75 common development and distribution LIC
cecill         0.7  cecill
artistic       0.75 artistic LIC
lppl           0.75 latex project public LIC
lppl           0.75 lppl
psf            0.8  (?:psf|python software foundation) LIC
python         0.7  python LIC
zope           0.8  zope public LIC
cc0-1.0        0.9  (?:cc0|cc zero)(?: 1 0)?
cc0-1.0        0.9  creativecommons org publicdomain zero
cc0-1.0        0.9  creative commons(?: cc0| zero)(?: 1 0)?
cc-pdm         0.9  creativecommons org publicdomain mark
cc             0.6  creative commons(?: [a-z]+)? LIC
cc             0.6  (?:licencia|licenza|licence|lizenz) creative commons
cc             0.6  creativecommons org licenses
copyleft       0.5  copyleft
fair           0.9  fair LIC
public-domain  0.6  public domain
"""

# Families: label, long name, short name, versions; the rules for each version follow from them.
FAMILIES = (
    ("gpl", "gnu general public LIC", "gpl", "1.0 2.0 3.0"),
    ("lgpl", "gnu (?:lesser|library) general public LIC", "lgpl", "2.0 2.1 3.0"),
    ("agpl", "gnu affero general public LIC", "agpl", "1.0 3.0"),
    ("gfdl", "gnu free documentation LIC", "gfdl", "1.1 1.2 1.3"),
    ("apache", "apache(?: software)?(?: foundation)? LIC", "apache asl", "1.0 1.1 2.0"),
    ("mpl", "mozilla public LIC", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse public LIC", "epl", "1.0 2.0"),
    ("eupl", "european union public LIC", "eupl", "1.0 1.1 1.2"),
    ("cddl", "common development and distribution LIC", "cddl", "1.0 1.1"),
    ("osl", "open software LIC", "osl", "1.0 1.1 2.0 2.1 3.0"),
    ("afl", "academic free LIC", "afl", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic LIC", "artistic", "1.0 2.0"),
    ("lppl", "latex project public LIC", "lppl", "1.0 1.1 1.2 1.3"),
    ("ofl", "sil open font LIC", "ofl", "1.0 1.1"),
    ("cecill", "cecill(?: free software)? LIC", "cecill", "1.0 1.1 2.0 2.1"),
    ("zpl", "zope public LIC", "zpl", "1.1 2.0 2.1"),
    ("psf", "python software foundation LIC", "psf", "2.0"),
    ("odbl", "open database LIC", "odbl", "1.0"),
    ("ogl", "open government LIC", "ogl", "1.0 2.0 3.0"),
    ("elastic", "elastic LIC", "elastic", "2.0"),
    ("busl", "business source LIC", "busl", "1.1"),
)
LATER = "(?: or(?: at your option)?(?: any)? later| or newer| plus| and above)"
PUBLISHED = "(?: as)?(?: published by the free software foundation)?(?: either)?"
CC_PARTS = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s(?: works)?", "nc": "non ?commercial"}
CC_KINDS = ("by-nc-sa", "by-nc-nd", "by-nc", "by-sa", "by-nd", "by")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


@dataclass(frozen=True)
class Rule:
    """A signature: its rank (the lower wins), its label and weight, and its pattern over words."""

    rank: int
    label: str
    weight: float
    pattern: str

    @property
    def keywords(self) -> list[str]:
        """The words with which a match can begin."""
        return first_words(self.pattern)


def _split(text: str) -> list[str]:
    """The alternatives of a pattern, those within groups left as they are."""
    out, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def first_words(pattern: str) -> list[str]:
    """The words that begin a pattern: one, or those of a leading group, which may be optional.

    They must be plain, since only these words lead to the rule.
    """
    if not pattern.startswith("(?:"):
        return [re.match(r"[0-9a-z]+(?=$| |\(\?: )", pattern)[0]]
    end = next(i for i in range(len(pattern)) if pattern[: i + 1].count("(") == pattern[: i + 1].count(")"))
    words = [w for part in _split(pattern[3:end]) for w in first_words(part)]
    return words + (first_words(pattern[end + 2 :]) if pattern[end + 1 : end + 2] == "?" else [])


def _version(version: str) -> str:
    """A version as words; a trailing zero may be missing."""
    major, minor = version.split(".")
    return f"v?{major}(?: 0)?" if minor == "0" else f"v?{major} {minor}"


def _short(names: str, version: str) -> str:
    """A short name with a version, apart or as one word."""
    tail = _version(version).removeprefix(f"v?{version[0]}")
    return "(?:" + "|".join(f"{n}(?: version)? v?{version[0]}{tail}|{n}v{version[0]}{tail}|{n}{version[0]}{tail}" for n in names.split()) + ")"


def _table(text: str) -> list[tuple[str, float, str]]:
    return [(a, float(b), c) for a, b, c in (line.split(None, 2) for line in text.strip().split("\n"))]


def _family_rules() -> list[tuple[str, float, str]]:
    out = []
    for label, name, short, versions in FAMILIES:
        for v in sorted(versions.split(), reverse=True):
            number = _version(v)
            forms = (f"{name}{PUBLISHED}(?: version)? {number}", _short(short, v))
            for form in forms:
                if label.endswith("gpl"):
                    out.append((f"{label}-{v}-or-later", 0.95, form + LATER))
                out.append((f"{label}-{v}", 0.9, form))
    return out


def _cc_rules() -> list[tuple[str, float, str]]:
    out = []
    for version in (*CC_VERSIONS, None):
        number = f" {_version(version)}" if version else ""
        for kind in CC_KINDS:
            parts = kind.split("-")
            label = f"cc-{kind}-{version}" if version else f"cc-{kind}"
            weight = 0.9 if version else 0.75
            out.append((label, weight + 0.05, f"creativecommons org licenses {' '.join(parts)}{number}"))
            out.append((label, weight, f"cc {' '.join(parts)}{number}"))
            out.append((label, weight, f"creative commons {' '.join(CC_PARTS[p] for p in parts)}{number}"))
    return out


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in rank order: identifier tags, notices, versions, names."""
    named = [*_family_rules(), *_cc_rules(), *_table(NAMES)]
    labels = dict.fromkeys(label for label, _, _ in [*_table(NOTICES), *named])
    # A longer identifier comes before one that it begins with.
    tags = [(x, 1.0, f"spdx license identifier {' '.join(re.findall('[0-9a-z]+', x))}") for x in sorted(labels, reverse=True)]
    listed = [*tags, *_table(NOTICES), *named]
    return tuple(Rule(i, label, weight, pattern.replace("LIC", LIC)) for i, (label, weight, pattern) in enumerate(listed))


@cache
def keywords() -> dict[str, list[Rule]]:
    """The rules by the words they can begin with, in rank order; the words of the base phrases are there, too."""
    out: dict[str, list[Rule]] = {phrase.split()[0]: [] for phrase in BASE}
    for rule in rules():
        for word in dict.fromkeys(rule.keywords):
            out.setdefault(word, []).append(rule)
    return out


def _rule_map() -> Column:
    """The rules by keyword, as a constant map."""

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def entry(rule: Rule) -> str:
        return (
            f"named_struct('rank', {rule.rank}, 'label', {quoted(rule.label)}, 'weight', {rule.weight}D, "
            f"'pattern', {quoted(whole_words(rule.pattern))})"
        )

    pairs = [f"{quoted(word)}, array({', '.join(map(entry, found))})" for word, found in keywords().items()]
    return F.expr(f"map({', '.join(pairs)})")


def whole_words(pattern: str) -> str:
    return f"^({pattern})(?: |$)"


def _outside(rule: Rule) -> str:
    """The pattern without its groups; the word license stays."""
    text = rule.pattern.replace(LIC, "licen[cs]e")
    while "(" in text:
        text = re.sub(r"\([^()]*\)\??(\{[0-9,]+\})?", "", text)
    return text


def _triggers(rule: Rule) -> list[str]:
    """Words of which each match of the rule has one: a rare word if the pattern asks for it, else the first words."""
    rare = [w for w in RARE if re.search(rf"(?:^| ){w}(?: |$)", _outside(rule))]
    return rare[:1] or rule.keywords


def _any_of(words: list[str]) -> str:
    """A pattern for any of the words that decides letter by letter, so that most places fail at the first."""
    if words == [""]:
        return ""
    by_letter: dict[str, list[str]] = {}
    for word in sorted(w for w in words if w):
        by_letter.setdefault(word[0], []).append(word[1:])
    parts = [c + _any_of(rest) for c, rest in by_letter.items()]
    return parts[0] if len(parts) == 1 and "" not in words else f"(?:{'|'.join(parts)})" + ("?" if "" in words else "")


@cache
def gate() -> str:
    """A pattern that every text has in which a rule or a base phrase matches."""
    edge = f"[{WORD_CHARS}]"
    words = [w for r in rules() if "licen[cs]e" not in _outside(r) for w in _triggers(r)]
    alone = [phrase.split()[0] for phrase in BASE if "license" not in phrase]
    return f"(?i:licen[cs]|lizenz)|(?<!{edge})(?i:{_any_of(sorted({*words, *alone}))})(?!{edge})"


DETECTION = "struct<start:int,end:int,rank:int,label:string,weight:double>"
PLACE = f"struct<word:int,base:string,found:{DETECTION}>"


def _places(words: Column) -> Column:
    """What stands at each keyword: a base label, and the detection of the best rule."""
    listed = F.sequence(F.lit(0), F.size(words) - 1)
    at = F.filter(listed, lambda i: F.get(words, i).isin(*keywords()))

    def place(i: Column) -> Column:
        def judged(window: Column) -> Column:
            base = F.lit(None).cast("string")
            for phrase, label in BASE.items():
                base = F.when(window.rlike(f"^{phrase}( |$)"), F.lit(label)).otherwise(base)
            tried = F.transform(
                F.element_at(_rule_map(), F.get(words, i)),
                lambda r: F.struct(r.alias("r"), F.call_function("regexp_extract", window, r["pattern"], F.lit(1)).alias("match")),
            )
            best = F.get(F.filter(tried, lambda t: t["match"] != ""), F.lit(0))
            detection = F.struct(
                i.alias("start"),
                (i + F.size(F.split(best["match"], " "))).alias("end"),
                best["r"]["rank"].alias("rank"),
                best["r"]["label"].alias("label"),
                best["r"]["weight"].alias("weight"),
            )
            return F.struct(i.alias("word"), base.alias("base"), F.when(best.isNotNull(), detection).alias("found"))

        return F.transform(F.array(F.array_join(F.slice(words, i + 1, F.lit(WINDOW)), " ")), judged)[0]

    return F.transform(at, place)


def _resolved(found: Column) -> Column:
    """Detections that no other one suppresses; ``found`` is in order of start, with one for each start.

    A detection goes if it lies within an earlier one of the same or a better
    rank, or if one of a better rank lies within it. All detections count,
    whether they go themselves or not. None spans more than ``WINDOW`` words, so
    only so many neighbours can meet it.
    """
    near = WINDOW - 1

    def stays(d: Column, k: Column) -> Column:
        before = F.slice(found, F.greatest(F.lit(1), k + 1 - near), F.least(k, F.lit(near)))
        after = F.slice(found, k + 2, F.lit(near))
        within = F.exists(before, lambda x: (x["end"] >= d["end"]) & (x["rank"] <= d["rank"]))
        around = F.exists(after, lambda x: (x["end"] <= d["end"]) & (x["rank"] < d["rank"]))
        return ~within & ~around

    return F.filter(found, stays)


ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "detections", "labels", "score")


def scan_licenses(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words``, the base phrases, ``detections``, ``labels`` and ``score``.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` tell where the
    words of a base phrase stand in a row. ``detections`` are the matches of the
    rules that are left: ``start`` and ``end`` (words, the end exclusive),
    ``rank``, ``label``, ``weight``. ``labels`` are those of both, distinct,
    sorted, joined by commas. ``score`` is the largest weight, 0 without one.

    Only the row's own text is looked at, once to find keywords and word counts;
    the rules run at keywords only, each on a window of 24 words, so the work
    grows with the text. A null or empty text has no words, no labels and null
    places; repeated rows get equal results; columns with the names above are
    replaced, all others stay.
    """
    text = whole(f"`{text_col}`")
    lowered = F.translate(text, UPPER, LOWER)
    words = F.regexp_extract_all(lowered, F.lit(f"([{WORD_CHARS}]+)"), F.lit(1))
    places = F.transform(F.array(words), _places)[0]
    nothing = F.array().cast(f"array<{PLACE}>")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    made = F.struct(
        F.regexp_count(text, F.lit(f"[{WORD_CHARS}]+")).cast("bigint").alias("n_words"),
        F.when(text.rlike(gate()), places).otherwise(nothing).alias("detections"),
    )
    # Above a generator the places are computed once, however many columns read them.
    once = docs.select(*others, F.inline(F.array(made)))
    base = F.filter("detections", lambda p: p["base"].isNotNull())
    found = F.transform(F.filter("detections", lambda p: p["found"].isNotNull()), lambda p: p["found"])
    kept = F.transform(F.array(found), _resolved)[0]
    parts = F.struct(base.alias("base"), kept.alias("kept"))
    final = F.transform(
        F.array(parts),
        lambda x: F.struct(
            F.size(x["base"]).cast("bigint").alias("n_base"),
            F.get(x["base"], F.lit(0))["word"].cast("bigint").alias("first_word"),
            F.get(x["base"], F.size(x["base"]) - 1)["word"].cast("bigint").alias("last_word"),
            _joined(F.transform(x["base"], lambda p: p["base"])).alias("base_labels"),
            x["kept"].alias("detections"),
            _joined(F.concat(F.transform(x["base"], lambda p: p["base"]), F.transform(x["kept"], lambda d: d["label"]))).alias("labels"),
            F.coalesce(F.array_max(F.transform(x["kept"], lambda d: d["weight"])), F.lit(0.0)).alias("score"),
        ),
    )
    return once.select(*others, "n_words", F.inline(final))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
