import math
import random

import pytest
from fixtures import ARTIST, USER_SHA, rows

from earshot import schemas as S
from earshot.operators.validation import REASONS, Rule, RuleSet, not_blank, not_null, rejected_rows, valid_rows
from earshot.plans.rules import ARTIST_RULES, LISTEN_RULES, TIME_RULES, USER_RULES

O = "_ordinal"


def frame(spark, data, schema):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(data)], f"{schema}, {O} bigint")


def both(df, rules):
    valid, rejected = valid_rows(df, rules, O), rejected_rows(df, rules, O)
    reasons = {r[O]: list(r[REASONS]) for r in rejected.collect()}
    kept = sorted(r[O] for r in valid.collect())
    assert sorted([*kept, *reasons]) == list(range(df.count()))
    return kept, reasons


def test_users(spark):
    schema = "user_name string, user_id string"
    assert both(frame(spark, [(None, USER_SHA)], schema), USER_RULES) == ([], {0: ["user_name: null"]})
    kept, reasons = both(frame(spark, [("TEST NAME", "1"), ("NichoBI", "1")], schema), USER_RULES)
    assert (kept, reasons) == ([0], {1: ["user_id: duplicate"]})
    kept, reasons = both(frame(spark, [("  \t", "1"), (" ", "2"), (" x ", "3")], schema), USER_RULES)
    assert (kept, reasons) == ([2], {0: ["user_name: blank"], 1: ["user_name: blank"]})


def test_artists(spark):
    df = frame(spark, [(None, "Withered Hand")], "artist_id string, artist_name string")
    assert both(df, ARTIST_RULES)[0] == []


def test_time_with_missing_columns_and_a_null_month(spark):
    data = [
        (1555286560, 2019, 4.0, 15, "Monday", 0),
        (1555286560, 2019, 4.0, 14, "Sunday", 23),
        (1555286137, 2019, math.nan, 14, "Sunday", 23),
    ]
    df = frame(spark, data, "listen_time bigint, year int, month double, day int, day_name string, hour int")
    kept, reasons = both(df, TIME_RULES)
    assert (kept, reasons) == ([0], {1: ["listen_time: duplicate"], 2: ["month: null"]})
    assert TIME_RULES.skipped(df) == ["timestamp: null", "date: null"]
    assert valid_rows(df, TIME_RULES, O).schema["month"].dataType == S.T.IntegerType()


LISTEN = "listen_id string, listen_time bigint, song_name string, album_name string, artist_id string, user_id string"


def test_listens(spark):
    data = [
        ("a", 1, "s", "b", ARTIST, USER_SHA),
        ("a", 2, "s", "b", ARTIST, USER_SHA),
        ("c", 3, "s", "b", None, USER_SHA),
    ]
    assert both(frame(spark, data, LISTEN), LISTEN_RULES)[0] == [0]


def test_failing_first_row_does_not_make_room(spark):
    data = [("a", 1, "s", "b", None, USER_SHA), ("a", 2, "s", "b", ARTIST, USER_SHA)]
    kept, reasons = both(frame(spark, data, LISTEN), LISTEN_RULES)
    assert (kept, reasons) == ([], {0: ["artist_id: null"], 1: ["listen_id: duplicate"]})


def test_null_song(spark):
    df = frame(spark, [("a", 1, None, "b", ARTIST, USER_SHA)], LISTEN)
    assert both(df, LISTEN_RULES)[0] == []
    assert both(df, LISTEN_RULES.allow_null("song_name", "album_name"))[0] == [0]


def test_types_are_conformed_and_values_kept_in_rejects(spark):
    df = frame(spark, [("7", "a"), ("x", "b"), ("8", None), (None, "c")], "n string, t string")
    rules = RuleSet("r", "n", S.T.StructType([S.T.StructField("n", S.T.IntegerType())]), (not_null("n"), not_null("t")))
    kept, reasons = both(df, rules)
    assert kept == [0]
    # a value that does not fit is null for the other rules, the key included
    assert reasons[1] == ["n: null", "n: not int"]
    assert reasons[2] == ["t: null"]
    assert rows(rejected_rows(df, rules, O).select("n"))[0] == ("8",)
    assert ("x",) in rows(rejected_rows(df, rules, O).select("n"))


def test_fractions_do_not_fit_whole_numbers(spark):
    rules = RuleSet("r", "k", S.T.StructType([S.T.StructField("n", S.T.IntegerType())]), (not_null("n"),))
    df = frame(spark, [(0, 1.0), (1, 1.5), (2, 1e12), (3, None)], "k int, n double")
    assert both(df, rules) == ([0], {1: ["n: not int"], 2: ["n: null", "n: not int"], 3: ["n: null"]})


def test_custom_rule(spark):
    rules = RuleSet("r", "k", S.T.StructType([]), (Rule("n", "odd", lambda c: c % 2 == 0),))
    assert both(frame(spark, [(0, 2), (1, 3)], "k int, n int"), rules) == ([0], {1: ["n: odd"]})


@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_model(spark, seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, "", " ", "a", "b", "\t c "])
    data = [(rng.choice(["k1", "k2", "k3", "k4", None]), pick(), rng.choice([None, 1, 2])) for _ in range(60)]
    rules = RuleSet("r", "k", S.T.StructType([]), (not_null("k"), not_null("t"), not_blank("t"), not_null("n")))
    seen, expected = set(), []
    for i, (k, t, n) in enumerate(data):
        if k not in seen and None not in (k, t, n) and t.strip():
            expected.append(i)
        seen.add(k)
    assert both(frame(spark, data, "k string, t string, n int"), rules)[0] == expected


def test_one_key_in_most_rows_is_combined_before_the_shuffle(spark):
    df = frame(spark, [("a", 1)], "k string, n int")
    rules = RuleSet("r", "k", S.T.StructType([]), (not_null("k"), not_null("n")))
    plan = valid_rows(df, rules, O)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
