import base64
import datetime as dt
import json

import pytest
from fixtures import EVENT, rows

from earshot import schemas as S
from earshot.streaming.enrich import (
    enrich_events,
    enrich_payload,
    process_envelopes,
    rejected_envelopes,
    rejected_events,
)

ZONE = "Europe/Berlin"  # two hours ahead of UTC at the time of the fixture


def events(spark, *texts):
    texts = [t if t is None or isinstance(t, str) else json.dumps(t) for t in texts]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")


def encoded(event) -> str:
    return base64.b64encode(json.dumps(event).encode()).decode()


def envelopes(spark, *data):
    return spark.createDataFrame([(f"r{i}", d) for i, d in enumerate(data)], S.ENVELOPE)


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    "name, kind, subkind",
    [
        ("payment:order:completed", "payment", "order"),
        ("a:b:c:d", "a", "b"),
        ("account:created", "account", ""),
        ("plain", "", ""),
        ("", "", ""),
        ("odd:", "odd", ""),
        ("::", "", ""),
        (":sub:", "", "sub"),
    ],
)
def test_lake_columns(spark, name, kind, subkind, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = enrich_events(events(spark, EVENT | {"event_name": name}), ZONE)
        micros = df.selectExpr("unix_micros(created_at)").first()[0]
        row = df.drop("created_at").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == 1712511721022075
    assert tuple(row) == (EVENT["event_uuid"], name, "2024-04-07T19:42:01", kind, subkind, 2024, 4, 7, 19)
    assert df.schema.names == [*S.LAKE_EVENT.names, *S.PARTITION_KEYS]


def test_zone_is_utc_by_default(spark):
    assert enrich_events(events(spark, EVENT)).first()["hour"] == 17


def test_time_in_the_hour_the_session_zone_skips(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = dt.datetime(2024, 3, 10, 2, 30, tzinfo=dt.timezone.utc).timestamp()
        row = enrich_events(events(spark, EVENT | {"created_at": seconds})).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row["created_datetime"], row["hour"]) == ("2024-03-10T02:30:00", 2)


@pytest.mark.parametrize(
    "created_at, text",
    [
        (1712511721, "2024-04-07T17:42:01"),
        ("1712511721", "2024-04-07T17:42:01"),
        (1712511721.999999, "2024-04-07T17:42:01"),
        (1.712511721e9, "2024-04-07T17:42:01"),
        (0, "1970-01-01T00:00:00"),
        (-1.5, "1969-12-31T23:59:59"),
    ],
)
def test_created_at_forms(spark, created_at, text):
    assert enrich_events(events(spark, EVENT | {"created_at": created_at})).first()["created_datetime"] == text


BAD = [
    (None, "no text"),
    ("", "not a JSON object"),
    ("{bad", "not a JSON object"),
    ("[1]", "not a JSON object"),
    ("7", "not a JSON object"),
    ("null", "not a JSON object"),
    (json.dumps(EVENT) + "}", "not a JSON object"),
    (json.dumps(EVENT) + ' {"a":1}', "not a JSON object"),
    (json.dumps(EVENT) + ',{"a":1}', "not a JSON object"),
    (json.dumps(EVENT) + "]", "not a JSON object"),
    (json.dumps(EVENT) + '] {"a":[1]}', "not a JSON object"),
    ("[" + json.dumps(EVENT) + "]", "not a JSON object"),
    ({"created_at": 1}, "event_name is not a text"),
    (EVENT | {"event_name": None}, "event_name is not a text"),
    (EVENT | {"event_name": 5}, "event_name is not a text"),
    ({"event_name": "a:b"}, "created_at is not a time"),
    (EVENT | {"created_at": None}, "created_at is not a time"),
    (EVENT | {"created_at": "soon"}, "created_at is not a time"),
    (EVENT | {"created_at": "1.5"}, "created_at is not a time"),
    (EVENT | {"created_at": 1e20}, "created_at is not a time"),
    (EVENT | {"created_at": [1]}, "created_at is not a time"),
]


def test_bad_events_are_set_apart_and_others_go_on(spark):
    df = events(spark, EVENT, *[b for b, _ in BAD], EVENT)
    found = {r["id"]: r["reason"] for r in rejected_events(df).collect()}
    assert found == {i + 1: reason for i, (_, reason) in enumerate(BAD)}
    assert enrich_events(df).count() == 2


def test_valid_forms_are_kept(spark):
    spaced = " \t" + json.dumps(EVENT | {"list": [{"a": 1}, {"b": [{}]}]}, indent=1) + "\n "
    minimal = '{"event_name":"a:b","created_at":5}'
    assert enrich_events(events(spark, spaced, minimal)).count() == 2


def test_payload_keeps_unknown_keys(spark):
    event = EVENT | {"nested": {"y": [1, {"z": None}]}, "text": 'quo"te \\ {é} }', "n": None}
    row = enrich_payload(events(spark, event), ZONE).first()
    added = {"created_datetime": "2024-04-07T19:42:01", "event_type": "payment", "event_subtype": "order"}
    assert json.loads(row["enriched"]) == event | added
    assert "1712511721.022075" in row["enriched"]


def test_payload_overwrites_its_own_fields(spark):
    event = EVENT | {"event_type": "old", "x": {"event_type": "inner"}}
    row = enrich_payload(events(spark, event, EVENT | {"event_subtype": None})).orderBy("id").collect()
    assert json.loads(row[0]["enriched"])["event_type"] == "payment"
    assert json.loads(row[0]["enriched"])["x"] == {"event_type": "inner"}
    assert row[0]["enriched"].count('"event_type"') == 2
    assert json.loads(row[1]["enriched"])["event_subtype"] == "order"


def test_payload_overwrites_an_escaped_name(spark):
    text = json.dumps(EVENT)[:-1] + ',"event\\u005ftype":"old"}'
    enriched = enrich_payload(events(spark, text)).first()["enriched"]
    assert json.loads(enriched, object_pairs_hook=list).count(("event_type", "payment")) == 1
    assert len(json.loads(enriched, object_pairs_hook=list)) == 6


def test_envelopes(spark):
    long_event = EVENT | {"text": "é" * 500}
    out = process_envelopes(envelopes(spark, encoded(EVENT), encoded(long_event)), ZONE).orderBy("recordId").collect()
    assert [(r["recordId"], r["result"]) for r in out] == [("r0", "Ok"), ("r1", "Ok")]
    assert out[0]["metadata"]["partitionKeys"].asDict() == {"year": 2024, "month": 4, "day": 7, "hour": 19}
    payload = json.loads(base64.b64decode(out[0]["data"], validate=True))
    assert payload["created_datetime"] == "2024-04-07T19:42:01"
    assert payload["event_type"] == "payment" and payload["event_subtype"] == "order"
    assert json.loads(base64.b64decode(out[1]["data"], validate=True))["text"] == "é" * 500


def test_bad_envelopes(spark):
    df = envelopes(spark, encoded(EVENT), "///", base64.b64encode(b"\xff\xfe").decode(), encoded([1]), None)
    assert rows(rejected_envelopes(df).select("recordId", "reason")) == [
        ("r1", "not base64 of UTF-8 text"),
        ("r2", "not base64 of UTF-8 text"),
        ("r3", "not a JSON object"),
        ("r4", "no text"),
    ]
    assert process_envelopes(df).count() == 1


def test_each_event_is_parsed_once(spark):
    plan = enrich_events(events(spark, EVENT))._jdf.queryExecution().optimizedPlan().toString()
    # the second parse is the one that only doubtful text needs
    assert plan.count("parseJson") == 2
