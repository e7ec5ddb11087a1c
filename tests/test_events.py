"""JSON messages to events: every case of the projection, by hand."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.payload import REASONS, SessionPath
from millrace.functions.payload import texts as texts_of
from millrace.operators import events

# text -> (eid, sessionId, userId) or a reason
CASES = [
    ('{"eid":"x","passport":{"sid":"s"},"userId":"u"}', ("x", "s", "u")),
    ('{"passport":{}}', (None, "", None)),
    ('{"eid":"x"}', ("x", "", None)),
    ("{}", (None, "", None)),
    ('{"eid":null,"passport":{"sid":null}}', (None, None, None)),
    ('{"eid":"d1","eid":"d2"}', ("d2", "", None)),
    ('{"EID":"up"}', (None, "", None)),
    ('{"eid":"5"}', ("5", "", None)),
    ('{"eid":"a\\"b"}', ('a"b', "", None)),
    ('{"eid":"x"} z', "MALFORMED_JSON"),
    ('{"eid":"x"} {"eid":"y"}', "MALFORMED_JSON"),
    ('{"eid":"x"},{"eid":"y"}', "MALFORMED_JSON"),
    ('{"eid":"x"},"y"', "MALFORMED_JSON"),
    ('{"eid":"x"},', "MALFORMED_JSON"),
    ('{"eid":"x"}]', "MALFORMED_JSON"),
    ('{"eid":"x"}] [', "MALFORMED_JSON"),
    ('{"eid":"x"}}', "MALFORMED_JSON"),
    ('{"eid":"x"}] z', "MALFORMED_JSON"),
    ('{"eid":"x"},"k":1', "MALFORMED_JSON"),
    ('{"eid":"x"}],"m":[{"eid":"y"}', "MALFORMED_JSON"),
    ('{"eid":"x"}]}', "MALFORMED_JSON"),
    ('{"passport":{"sid":"s","sid":"t"}} z', "MALFORMED_JSON"),
    ('{"eid":"x"} \n\t ', ("x", "", None)),
    ('{"passport":null}', "PASSPORT_NULL"),
    ('{"passport":"str"}', "PASSPORT_NOT_OBJECT"),
    ('{"passport":[1]}', "PASSPORT_NOT_OBJECT"),
    ('{"eid":5}', "EID_NOT_STRING"),
    ('{"eid":true}', "EID_NOT_STRING"),
    ('{"eid":{"k":1}}', "EID_NOT_STRING"),
    ('{"eid":["x"]}', "EID_NOT_STRING"),
    ('{"passport":{"sid":7}}', "SID_NOT_STRING"),
    ('{"passport":{"sid":{}}}', "SID_NOT_STRING"),
    ('{"userId":7}', "USERID_NOT_STRING"),
    ("not json", "MALFORMED_JSON"),
    ('{"eid":"x"', "MALFORMED_JSON"),
    ("", "MALFORMED_JSON"),
    ("  ", "MALFORMED_JSON"),
    ("{'eid':'x'}", "MALFORMED_JSON"),
    ('{"eid":"x","n":NaN}', "MALFORMED_JSON"),
    ("[1]", "ROOT_NOT_OBJECT"),
    ('[{"eid":"x"}]', "ROOT_NOT_OBJECT"),
    ('"s"', "ROOT_NOT_OBJECT"),
    ("null", "ROOT_NOT_OBJECT"),
    (None, "NULL_MESSAGE"),
    # the last of a repeated key counts, at every level
    ('{"eid":5,"eid":"x"}', ("x", "", None)),
    ('{"eid":"x","eid":5}', "EID_NOT_STRING"),
    ('{"passport":{"sid":"a","sid":"b"}}', (None, "b", None)),
    ('{"passport":{"x":{"k":1,"k":2},"sid":"a"},"eid":"e"}', ("e", "a", None)),
    ('{"passport":{"sid":"a","sid":7}}', "SID_NOT_STRING"),
    ('{"passport":{"x":1,"x":2}}', (None, "", None)),
    ('{"eid":"x","other":{"k":1,"k":2}}', ("x", "", None)),
    # what the producers' parser takes
    ('{"eid":"a\tb"}', ("a\tb", "", None)),
    ('{"eid":"x","n":007}', ("x", "", None)),
    ('{"eid":"\\u00e9\\n"}', ("é\n", "", None)),
    # two faults: the first rule names the reason
    ('{"eid":5,"passport":null}', "EID_NOT_STRING"),
    ('{"passport":null,"userId":7}', "PASSPORT_NULL"),
]


def _classified(make_messages, texts, **kwargs):
    rows = [("RawEvents", 0, i, i, text) for i, text in enumerate(texts)]
    texts = [column.alias(name) for name, column in texts_of(F.col("fields")).items()]
    out = events.classify(make_messages(rows), **kwargs)
    # A field of a rejected message is no text; only events are asked for theirs.
    good = {r["offset"]: r.asDict() for r in out.where("reason IS NULL").select("offset", "reason", *texts).collect()}
    bad = {r["offset"]: r.asDict() for r in out.where("reason IS NOT NULL").select("offset", "reason").collect()}
    assert not good.keys() & bad.keys()
    return {**good, **bad}


def test_every_case(make_messages):
    got = _classified(make_messages, [text for text, _ in CASES])
    assert len(got) == len(CASES)
    for i, (text, expected) in enumerate(CASES):
        row = got[i]
        if isinstance(expected, str):
            assert row["reason"] == expected, text
        else:
            assert (row["reason"], row["eid"], row["sessionId"], row["userId"]) == (None, *expected), text


def test_flat_form(make_messages):
    got = _classified(
        make_messages,
        ['{"sid":"s","eid":"e"}', '{"eid":"e"}', '{"sid":null}', '{"sid":3}', '{"passport":null,"sid":"s"}'],
        sid_path="sid",
    )
    assert [got[i]["sessionId"] for i in (0, 1, 2, 4)] == ["s", "", None, "s"]
    assert [got[i]["reason"] for i in range(5)] == [None, None, None, "SID_NOT_STRING", None]


def test_each_message_is_event_or_reject(make_messages):
    messages = make_messages([("RawEvents", 0, i, i, text) for i, (text, _) in enumerate(CASES)])
    good = {r["offset"] for r in events.to_events(messages).collect()}
    bad = {r["offset"]: r["reason"] for r in events.quarantine(messages).collect()}
    assert good | set(bad) == set(range(len(CASES))) and not good & set(bad)
    assert set(bad.values()) == set(REASONS)


def test_event_row_layout(make_messages):
    out = events.to_events(make_messages([("RawEvents", 0, 0, 0, "{}")]), lineage=False)
    assert out.columns == list(events.EVENT_COLUMNS)
    assert {t for _, t in out.dtypes} == {"string"}


def test_tags_and_kinds(make_messages):
    rows = [
        (topic, 0, i, i, '{"eid":"%s"}' % eid if eid else "{}")
        for i, (topic, eid) in enumerate(
            [("RawEvents", "upsert_session"), ("PassportEvents", "track_event"), ("SessionsRes", None), ("Other", "z")]
        )
    ]
    tagged = events.tag_type(events.to_events(make_messages(rows), event_type="old"))
    assert [r["type"] for r in tagged.orderBy("offset").collect()] == ["rawEvent", "passportEvent", "sessionRes", "old"]
    assert [r["offset"] for r in events.of_kind(tagged, "track_event").collect()] == [1]
    assert events.of_kind(tagged, ["track_event", "upsert_session"]).count() == 2


def test_rendering(make_messages):
    value = '{"eid":"a\\"b","passport":{"sid":"s"}}'
    rows = events.to_events(make_messages([("RawEvents", 0, 0, 0, value)]), event_type="t")
    compat = events.render_event(rows, compat=True).first()["line"]
    assert compat == '{"eid":"a"b","sessionId":"s","name":"null","type":"t","userId":"null"}'
    line = json.loads(events.render_event(rows).first()["line"])
    assert line == {"eid": 'a"b', "sessionId": "s", "name": None, "type": "t", "userId": None}
    assert list(line) == ["eid", "sessionId", "name", "type", "userId"]


def test_session_path():
    assert SessionPath.of("passport.sid") == SessionPath("passport", "sid")
    assert SessionPath.of("sid") == SessionPath(None, "sid")
    with pytest.raises(ValueError):
        SessionPath.of("a.b.c")


_json = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text(max_size=4),
    lambda inner: st.lists(inner, max_size=2) | st.dictionaries(st.text(max_size=3), inner, max_size=2),
    max_leaves=4,
)
_message = st.fixed_dictionaries(
    {}, optional={"eid": _json, "passport": st.fixed_dictionaries({}, optional={"sid": _json}) | _json, "userId": _json}
)


def _model(doc):
    """The projection in plain Python, or None for a message that is no event."""
    absent = object()
    eid, user, passport = doc.get("eid"), doc.get("userId"), doc.get("passport", absent)
    if passport is absent:
        sid = ""
    elif not isinstance(passport, dict):
        return None
    else:
        sid = passport.get("sid", "")
    if all(x is None or isinstance(x, str) for x in (eid, sid, user)):
        return eid, sid, user
    return None


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_message, min_size=20, max_size=60))
def test_projection_against_model(make_messages, docs):
    got = _classified(make_messages, [json.dumps(d) for d in docs])
    for i, doc in enumerate(docs):
        row = got[i]
        actual = None if row["reason"] else (row["eid"], row["sessionId"], row["userId"])
        assert actual == _model(doc), doc
