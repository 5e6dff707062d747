"""Decoders and record assembly with the reference's source fixtures."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import make_topic
from topicframe.operators import decode as dec

USER = "id long, first string, last string"


def test_user_csv_with_metadata(spark):
    # key a -> partition 1 offset 0; b -> p0 o0; c -> p0 o1
    topic = make_topic(spark, [(1, 0, "a", "1,samuel,jackson"), (0, 0, "b", "2,dwayne,johnson"),
                               (0, 1, "c", "3,christopher,walken")])
    schema = "id bigint, first string, last string, key binary, time bigint, partition int, offset bigint"
    recs = dec.to_records(topic, schema, "csv", time_field="time", key_field="key",
                          partition_field="partition", offset_field="offset", batch_time=42)
    assert recs.columns == ["id", "first", "last", "key", "time", "partition", "offset"]
    got = sorted(tuple(r) for r in recs.collect())
    assert got == [
        (1, "samuel", "jackson", b"a", 42, 1, 0),
        (2, "dwayne", "johnson", b"b", 42, 0, 0),
        (3, "christopher", "walken", b"c", 42, 0, 1),
    ]


def test_raw_payload_with_metadata_and_read_time(spark):
    topic = make_topic(spark, [(1, 0, "a", "payload_1"), (0, 0, "b", "payload_2"), (0, 1, "c", "payload_3")])
    schema = "message binary, key binary, time bigint, partition int, offset bigint"
    recs = dec.to_records(topic, schema, None, time_field="time", key_field="key",
                          partition_field="partition", offset_field="offset")
    rows = recs.collect()
    assert sorted((bytes(r.message), r.partition, r.offset) for r in rows) == [
        (b"payload_1", 1, 0), (b"payload_2", 0, 0), (b"payload_3", 0, 1)]
    assert len({r.time for r in rows}) == 1 and rows[0].time > 0  # one batch time for all rows


def test_key_as_text_null_and_invalid_utf8(spark):
    topic = make_topic(spark, [(0, 0, None, "x"), (0, 1, b"\xffa", "y"), (0, 2, "k", "z")])
    recs = dec.to_records(topic, "message string, k string", "text", key_field="k")
    got = {r.message: r.k for r in recs.collect()}
    assert got["x"] is None and got["z"] == "k"
    assert got["y"] is not None  # bytes kept, not a failure


def test_null_payload_gives_null_fields(spark):
    cases = {"csv": "1,x,y", "json": '{"id":1,"first":"x","last":"y"}', "tsv": "1\tx\ty"}
    for fmt, payload in cases.items():
        topic = make_topic(spark, [(0, 0, "a", None), (0, 1, "b", payload)])
        recs = dec.to_records(topic, USER, fmt).collect()
        assert sorted((r.id, r.first) for r in recs if r.id is not None) == [(1, "x")]
        assert sum(1 for r in recs if r.id is None and r.first is None) == 1


def test_failfast_and_permissive(spark):
    topic = make_topic(spark, [(0, 0, "a", "1,x"), (0, 1, "b", "2,y,z"), (0, 2, "c", "q,y,z"),
                               (0, 3, "d", "4,y,z,extra"), (0, 4, "e", "")])
    with pytest.raises(Exception):
        dec.to_records(topic, USER, "csv").collect()
    flagged = dec.split_malformed(topic, "csv", USER)
    bad = {r.offset: r.malformed for r in flagged.collect()}
    assert bad == {0: True, 1: False, 2: True, 3: True, 4: True}


def test_tsv_json_text(spark):
    topic = make_topic(spark, [(0, 0, None, "1\tsam\tj")])
    assert dec.to_records(topic, USER, "tsv").collect()[0].first == "sam"
    js = make_topic(spark, [(0, 0, None, '{"id": 2, "first": "dw", "last": null}')])
    r = dec.to_records(js, USER, "json").collect()[0]
    assert (r.id, r.first, r.last) == (2, "dw", None)
    tx = make_topic(spark, [(0, 0, None, "hello, world")])
    assert dec.to_records(tx, None, "text").collect()[0].message == "hello, world"


def test_nested_value_field(spark):
    topic = make_topic(spark, [(0, 0, None, "1,samuel,jackson")])
    schema = "message struct<id: bigint, first: string, last: string>, offset bigint"
    r = dec.to_records(topic, schema, "csv", offset_field="offset", value_field="message").collect()[0]
    assert r.message.first == "samuel" and r.offset == 0


def test_clf_syslog_grok(spark):
    clf = make_topic(spark, [(0, 0, None, '10.0.0.1 - bob [10/Oct/2000:13:55:36 -0700] "GET /a.gif HTTP/1.0" 200 2326'),
                             (0, 1, None, '10.0.0.2 - - [10/Oct/2000:13:55:36 +0000] "GET / HTTP/1.1" 404 -')])
    recs = dec.to_records(clf, "host string, authuser string, timestamp timestamp, request string, status int, bytes bigint", "clf")
    rows = sorted(recs.collect(), key=lambda r: r.host)
    assert rows[0].authuser == "bob" and rows[0].status == 200 and rows[0].bytes == 2326
    assert str(rows[0].timestamp) == "2000-10-10 20:55:36"
    assert rows[1].authuser is None and rows[1].bytes is None and rows[1].status == 404
    sl = make_topic(spark, [(0, 0, None, "<13>Feb  5 17:32:18 web01 sshd[4123]: Accepted password")])
    r = dec.to_records(sl, "facility int, severity int, host string, app string, pid int, message string", "syslog").collect()[0]
    assert (r.facility, r.severity, r.host, r.app, r.pid, r.message) == (1, 5, "web01", "sshd", 4123, "Accepted password")
    g = dec.to_records(sl, "host string, pid int", "grok",
                       pattern=r"<%{POSINT}>%{SYSLOGTIMESTAMP} %{HOSTNAME:host} %{PROG}\[%{POSINT:pid}\]: %{GREEDYDATA}").collect()[0]
    assert (g.host, g.pid) == ("web01", 4123)
    with pytest.raises(Exception):
        dec.to_records(make_topic(spark, [(0, 0, None, "not a log line")]), "host string", "syslog").collect()


def test_read_time_on_stream_is_per_batch(spark):
    df = spark.range(10).withColumn("t", dec.read_time())
    assert df.select(F.countDistinct("t")).first()[0] == 1


def test_json_malformed_and_log_variants(spark):
    js = make_topic(spark, [(0, 0, None, '{"id": 1, "first": "a", "last": "b"}'), (0, 1, None, "{not json"),
                            (0, 2, None, '{"id": "x"}'), (0, 3, None, None)])
    bad = {r.offset: r.malformed for r in dec.split_malformed(js, "json", USER).collect()}
    assert bad == {0: False, 1: True, 2: True, 3: False}
    combined = make_topic(spark, [(0, 0, None, '1.2.3.4 - - [01/Jan/2024:00:00:00 +0000] "GET / HTTP/1.1" 200 5 '
                                                '"http://ref/" "curl/8"')])
    r = dec.to_records(combined, "host string, referrer string, agent string, size bigint", "clf").first()
    assert (r.host, r.referrer, r.agent, r.size) == ("1.2.3.4", "http://ref/", "curl/8", 5)
    nopid = make_topic(spark, [(0, 0, None, "<0>Jan 31 23:59:59 box kernel: boot")])
    r = dec.to_records(nopid, "facility int, severity int, app string, pid int, message string", "syslog").first()
    assert (r.facility, r.severity, r.app, r.pid, r.message) == (0, 0, "kernel", None, "boot")
    custom = make_topic(spark, [(0, 0, None, "id=42 user=bob")])
    r = dec.decode(custom, "grok", "id int, user string", pattern="id=%{NUM:id} user=%{WORD:user}",
                   options={"patterns": {"NUM": r"\d+"}}).first()
    assert (r.id, r.user) == (42, "bob")


def _decode(spark, line, fmt, schema, pattern=None, options=None, mode="permissive"):
    return dec.decode(make_topic(spark, [(0, 0, None, line)]), fmt, schema, pattern=pattern, options=options, mode=mode).first()


def test_lines_that_do_not_match_give_nulls_not_parts(spark):
    assert _decode(spark, "whole line", "grok", "n int", "%{INT:n}").n is None
    assert _decode(spark, "a\u0001b\u0001c", "grok", "x string, y string", "%{WORD:x} %{WORD:y}").x is None
    odd = _decode(spark, "a\u0001 b", "grok", "x string, y string", "%{NOTSPACE:x} %{WORD:y}")
    assert (odd.x, odd.y) == ("a\u0001", "b")
    assert _decode(spark, "a or more", "grok", "x string", "a|b%{WORD:x}").x is None  # the whole line, not a part of it
    bad = dec.split_malformed(make_topic(spark, [(0, 0, None, "12"), (0, 1, None, "x"), (0, 2, None, None)]), "grok", "n int", pattern="%{INT:n}")
    assert {r.offset: (r.malformed, r.n) for r in bad.collect()} == {0: (False, 12), 1: (True, None), 2: (False, None)}


def test_grok_groups_stay_ours(spark):
    r = _decode(spark, "ab zz", "grok", "f string, g string", "%{X:f} %{WORD:g}", {"patterns": {"X": "(a)(b)"}})
    assert (r.f, r.g) == ("ab", "zz")
    r = _decode(spark, "(1) (", "grok", "n int", r"\(%{INT:n}\) [(]")
    assert r.n == 1


def test_a_dash_is_a_value_outside_clf(spark):
    r = _decode(spark, "<13>Feb  5 17:32:18 web01 app: -", "syslog", "message string")
    assert r.message == "-"
    assert _decode(spark, "- x", "grok", "a string", "%{NOTSPACE:a} x").a == "-"


def test_syslog_time_needs_the_year(spark):
    line = "<13>Feb  5 17:32:18 web01 app: m"
    r = _decode(spark, line, "syslog", "timestamp timestamp, message string", options={"year": 2024}, mode="failfast")
    assert str(r["timestamp"]).endswith("2024-02-05 17:32:18") or r["message"] == "m"
    with pytest.raises(Exception, match="year"):
        _decode(spark, line, "syslog", "timestamp timestamp")


def test_clf_quotes_may_be_escaped(spark):
    line = '1.2.3.4 - - [01/Jan/2024:00:00:00 +0000] "GET /a\\"b HTTP/1.1" 200 5 "r" "agent \\"x\\""'
    r = _decode(spark, line, "clf", "request string, agent string", mode="failfast")
    assert r.request == 'GET /a\\"b HTTP/1.1' and r.agent == 'agent \\"x\\"'
