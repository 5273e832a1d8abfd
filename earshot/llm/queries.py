"""The registered queries of these operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm.clean_lines import BOILERPLATE, clean_lines
from earshot.llm.decontaminate import benchmark_matches, leaked_pairs
from earshot.llm.licenses import BASE, WINDOW, keywords, scan_licenses, whole_words
from earshot.llm.lm_score import lm_scores
from earshot.llm.merkle import lowered_text, merkle_manifest
from earshot.llm.mixing import mix_sources
from earshot.llm.near_dups import near_duplicates
from earshot.llm.page_text import extract_text
from earshot.llm.privacy import find_personal_data, personal_data_digest
from earshot.llm.secrets import find_secrets, secrets_digest
from earshot.llm.spelling import spelling_variants
from earshot.llm.token_counts import count_tokens, recount_tokens, sample_edits
from earshot.llm.warc import captured_pages, captures, read_warc, write_warc
from earshot.operators.sizing import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_transactions(spark, d):
    path = scratch_path(spark, "warc")
    write_warc(table(spark, d, "pages"), path)
    return captured_pages(captures(read_warc(spark, path)))


def op2_super_minhash(spark, d):
    return near_duplicates(table(spark, d, "documents"))


def op3_sainte_lague(spark, d):
    mixed = mix_sources(table(spark, d, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_line_first(spark, d):
    cleaned = clean_lines(table(spark, d, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return cleaned.select("doc_id", *counts, "base_failed", "kept", "n_clean_words")


def op5_page_differencing(spark, d):
    return extract_text(table(spark, d, "pages"))


def op6_disclosure(spark, d):
    return personal_data_digest(find_personal_data(table(spark, d, "documents")))


def op7_bloom_lm(spark, d):
    return lm_scores(table(spark, d, "documents"))


def op8_edit_aware(spark, d):
    """Every document is counted, gets three edits at places that follow from its length, and is counted on."""
    counted = count_tokens(table(spark, d, "documents").select("doc_id", "text", "source", "lang"))
    length = F.length(F.coalesce("text", F.lit(""))).cast("bigint")
    edits = sample_edits(length, F.concat(F.lit(" seen in "), F.coalesce("source", F.lit("?"))), F.coalesce("lang", F.lit("?")))
    before = counted.withColumns({"edits": edits, "n_tokens_before": F.col("n_tokens"), "n_chars_before": length})
    after = recount_tokens(before)
    return after.select("doc_id", "n_chars_before", "n_tokens_before", F.length("text").cast("bigint").alias("n_chars"), "n_tokens", "n_reencoded")


def op9_smith_waterman(spark, d):
    return leaked_pairs(benchmark_matches(table(spark, d, "documents"), table(spark, d, "benchmark")))


def op10_linked_credentials(spark, d):
    return secrets_digest(find_secrets(table(spark, d, "documents")))


def op11_merkle(spark, d):
    return merkle_manifest(table(spark, d, "documents"), found={"text": lowered_text()})


def op12_license_rules(spark, d):
    scanned = scan_licenses(table(spark, d, "documents"))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op13_spelling_variants(spark, d):
    return spelling_variants(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_transactions": op1_transactions,
        "op2_super_minhash": op2_super_minhash,
        "op3_sainte_lague": op3_sainte_lague,
        "op4_line_first": op4_line_first,
        "op5_page_differencing": op5_page_differencing,
        "op6_disclosure": op6_disclosure,
        "op7_bloom_lm": op7_bloom_lm,
        "op8_edit_aware": op8_edit_aware,
        "op9_smith_waterman": op9_smith_waterman,
        "op10_linked_credentials": op10_linked_credentials,
        "op11_merkle": op11_merkle,
        "op12_license_rules": op12_license_rules,
        "op13_spelling_variants": op13_spelling_variants,
        "pipeline": corpus_pipeline.run,
    }


LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"

OP2 = f"""
WITH RECURSIVE cut AS (SELECT doc_id, {WORDS.format(f"coalesce({LOWER}, '')")} AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM cut
),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM each AS a JOIN each AS b USING (x)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM sets LEFT JOIN low ON a = doc_id"""

OP4 = f"""
WITH cut AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w, coalesce(text, '') AS t FROM documents),
lined AS (SELECT *, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS l FROM cut),
windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest([array_to_string(w[i:i + 7], ' ') FOR i IN range(1, len(w) - 6)]) AS x
    FROM cut WHERE len(w) >= 8
),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
steps AS (SELECT doc_id, least(8, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - 8)) AS k FROM twice),
repeated AS (SELECT doc_id, sum(k)::BIGINT AS n FROM steps GROUP BY doc_id),
judged AS (
    SELECT doc_id, unnest(l) AS x FROM lined
),
parts AS (
    SELECT *, len({WORDS.format("x")}) AS words, len(regexp_extract_all(x, '[|»›•·→>]')) AS cuts,
           len(regexp_extract_all(x, '[#*$%&|<>]')) AS signs, len(regexp_extract_all(x, '[!?]{{2,}}')) AS marks FROM judged
),
lost AS (
    SELECT doc_id, sum(words)::BIGINT AS n FROM parts
    WHERE (cuts >= 3 AND 4 * cuts >= words) OR (signs > 0 AND 10 * signs >= length(x))
       OR NOT regexp_matches(x, '[.!?…。！？]["'')\\]»”’]*([\\x20\\x09-\\x0D]|$)') OR (marks > 0 AND 4 * marks >= words)
       OR (length(x) <= 200 AND regexp_matches(x, '{{BOILERPLATE}}'))
    GROUP BY doc_id
),
counted AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
           coalesce(repeated.n, 0) AS n_repeat_words, len(w) - coalesce(lost.n, 0) AS n_clean_words
    FROM lined LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_clean_words <= 0.3 * n_words AS kept
FROM counted"""


# CRC-32 of the UTF-8 bytes of a short text, bit by bit.
CRC32 = (
    "xor(list_reduce([('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT FOR i IN range(strlen({0}))], "
    "lambda c, x: list_reduce(range(8), lambda r, k: "
    "CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END, xor(c, x)), 4294967295::BIGINT), 4294967295::BIGINT)"
)


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(parts)})"


OP11 = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("text")} AS leaf,
           CASE WHEN {CRC32.format("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(LOWER)} ELSE {_leaf("text")} END AS now
    FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
nodes AS (
    SELECT g, 0 AS l, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM placed
    UNION ALL
    SELECT g, l + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM nodes WHERE n > 1 GROUP BY g, l, i // 8
),
tops AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS i FROM nodes WHERE n = 1),
upper AS (
    SELECT 0 AS l, i, subroot AS h, count(*) OVER () AS n FROM tops
    UNION ALL
    SELECT l + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM upper WHERE n > 1 GROUP BY l, i // 8
),
runs AS (
    SELECT g, l, i, string_agg(h, '') OVER (PARTITION BY g, l, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a,
           string_agg(h, '') OVER (PARTITION BY g, l, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b
    FROM (SELECT g, l, i, h FROM nodes WHERE n > 1 UNION ALL SELECT NULL, l, i, h FROM upper WHERE n > 1)
),
steps AS (SELECT g, l, i, coalesce(a, '') || '|' || coalesce(b, '') AS s FROM runs),
paths AS (
    SELECT doc_id, p.g, p.i, any_value(leaf) AS leaf, any_value(now) AS now, any_value(subroot) AS subroot,
           coalesce(list(s ORDER BY steps.g IS NULL, l) FILTER (s IS NOT NULL), []) AS path
    FROM placed AS p JOIN tops AS t USING (g)
    LEFT JOIN steps ON (steps.g = p.g AND steps.i = p.i >> (3 * l)) OR (steps.g IS NULL AND steps.i = t.i >> (3 * l))
    GROUP BY doc_id, p.g, p.i
)
SELECT doc_id, CASE WHEN g <> '' THEN substr(g, 2) END AS lang, leaf, subroot, root,
       sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
       list_reduce(path, lambda n, s: sha256(split_part(s, '|', 1) || n || split_part(s, '|', 2)), now) AS folded_root,
       folded_root = root AS verified
FROM paths, (SELECT h AS root FROM upper WHERE n = 1)"""


def _op12() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    rows = {(w, r.rank, r.label, r.weight, whole_words(r.pattern)) for w, found in keywords().items() for r in found}
    table = ", ".join(f"({quoted(w)}, {k}, {quoted(label)}, {weight}::DOUBLE, {quoted(p)})" for w, k, label, weight, p in sorted(rows))
    phrases = " ".join(f"WHEN regexp_matches(x, '^{p}( |$)') THEN '{label}'" for p, label in BASE.items())
    return f"""
WITH rules(keyword, rank, label, weight, pattern) AS (VALUES {table}),
cut AS (
    SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
places AS (SELECT doc_id, i, w[i + 1] AS k, array_to_string(w[i + 1:i + {WINDOW}], ' ') AS x FROM cut, unnest(range(len(w))) AS u(i)),
base AS (SELECT doc_id, i, CASE {phrases} END AS label FROM places WHERE k IN ({", ".join(quoted(p.split()[0]) for p in BASE)})),
found AS (
    SELECT doc_id, i AS a, i + len(string_split(regexp_extract(x, pattern, 1), ' ')) AS b, rank, label, weight
    FROM places JOIN rules ON k = keyword AND regexp_matches(x, pattern)
    QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY rank) = 1
),
kept AS (
    SELECT doc_id, label, weight FROM found AS d WHERE NOT EXISTS (
        FROM found AS o WHERE o.doc_id = d.doc_id AND ((o.a < d.a AND o.b >= d.b AND o.rank <= d.rank) OR (o.a > d.a AND o.b <= d.b AND o.rank < d.rank))
    )
),
named AS (SELECT doc_id, label FROM base WHERE label IS NOT NULL UNION SELECT doc_id, label FROM kept),
per_base AS (
    SELECT doc_id, count(*) AS n, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM base WHERE label IS NOT NULL GROUP BY doc_id
),
per_doc AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM named GROUP BY doc_id),
best AS (SELECT doc_id, max(weight) AS score FROM kept GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word, coalesce(per_base.labels, '') AS base_labels,
       coalesce(per_doc.labels, '') AS labels, coalesce(score, 0) AS score
FROM cut LEFT JOIN per_base USING (doc_id) LEFT JOIN per_doc USING (doc_id) LEFT JOIN best USING (doc_id)"""


OP13 = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, r, count(*) AS k FROM (
        SELECT doc_id, unnest(regexp_extract_all(coalesce({LOWER}, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents
    ) WHERE length(r) >= 6 GROUP BY doc_id, r
),
hashed AS (SELECT r, k, {CRC32.format("(doc_id || ':' || r)")} AS h FROM runs),
words AS (
    SELECT w, sum(k)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS w, k FROM hashed
    ) WHERE length(w) >= 6 GROUP BY w HAVING sum(k) >= 5
),
cuts AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d FROM words, unnest(range(1, length(w) + 1)) AS u(i)),
shorter AS (SELECT DISTINCT a.w AS a, a.n AS an, b.w AS b, b.n AS bn FROM cuts AS a JOIN words AS b ON a.d = b.w),
near AS (
    SELECT a.w AS a, b.w AS b, b.n AS n FROM cuts AS a JOIN cuts AS b USING (i, d) WHERE a.w <> b.w
    UNION ALL SELECT a, b, bn FROM shorter UNION ALL SELECT b, a, an FROM shorter
),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, encode(b)) AS b, max(n) AS bn FROM near GROUP BY a),
forms AS (
    SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 5 * n THEN b END AS form, CASE WHEN bn >= 5 * n THEN bn END AS form_n
    FROM words LEFT JOIN best ON a = w
),
steps AS (
    SELECT w, coalesce(form, w) AS root, form IS NOT NULL AS more FROM forms
    UNION ALL SELECT steps.w, coalesce(form, root), form IS NOT NULL FROM steps JOIN forms ON forms.w = root WHERE more
)
SELECT w AS word, form, root, n, n_near, form_n FROM forms JOIN (SELECT w, root FROM steps WHERE NOT more) USING (w)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_super_minhash": OP2, "op4_line_first": OP4.replace("{BOILERPLATE}", BOILERPLATE), "op11_merkle": OP11, "op12_license_rules": _op12(), "op13_spelling_variants": OP13}
