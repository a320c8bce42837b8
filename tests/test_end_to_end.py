"""The engine, its HTTP answers and continuous ingest over a store of its own."""

import json

import pytest

from tidefold.plans.engine import Engine
from tidefold.server import answer
from tidefold.sources.tail import tail
from tidefold.streaming.follow import follow


def line(kind, uuid, account="a1", **props):
    return json.dumps({"#type": kind, "#uuid": uuid, "#time": "t", "#event_name": "buy", "#account_id": account, "properties": props})


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    e = Engine(spark, str(tmp_path_factory.mktemp("store")))
    got = e.upload([line("track", "u1", n=1), line("track", "u2", "a2", n=2.5, tags=["x"]), line("user_set", "s1", age=3), "bad", ""])
    assert got.to_dict() == {"lines": 4, "events": 2, "users": 1, "filtered": 0, "dead_letters": 1, "filter_errors": 0, "write_errors": 0}
    return e


def call(engine, path, method="POST", **body):
    return answer(engine, method, path, json.dumps(body).encode())


def test_http_answers(engine):
    assert answer(None, "GET", "/healthz", b"") == (200, {"status": "ok"})
    assert answer(None, "POST", "/sql", b"{}")[0] == 503 and answer(engine, "GET", "/sql", b"")[0] == 405
    assert answer(engine, "POST", "/sql", b"[]")[0] == 400 and answer(engine, "POST", "/x", b"{}")[0] == 404
    assert call(engine, "/sql")[0] == 400 and call(engine, "/config", mode="x", method="GET")[0] == 404


def test_sql_sees_properties(engine):
    status, got = call(engine, "/sql", sql="SELECT `#user_id` AS u, n, tags FROM event WHERE n > 2 AND `#event_name` = 'buy'")
    assert status == 200 and got["rows"] == [{"u": 2, "n": 2.5, "tags": ["x"]}]
    assert call(engine, "/sql", sql="SELECT error FROM dead_letter")[1]["rows"] == [{"error": "invalid JSON"}]


def test_documents_change(engine):
    find = lambda **q: engine.ejson({"action": "find", "collection": "user", "filter": q})["documents"]
    assert [(d["#user_id"], d["age"]) for d in find(**{"#user_id": 1})] == [(1, 3)]
    update = {"action": "updateOne", "collection": "user", "filter": {"age": 3}, "update": {"$set": {"age": 4}}}
    assert engine.ejson(update) == {"matchedCount": 1, "modifiedCount": 1}
    assert engine.ejson(update) == {"matchedCount": 0, "modifiedCount": 0}
    assert engine.sql("UPDATE user SET age = age + 1 WHERE `#user_id` = 1").to_dict() == {"matchedCount": 1, "modifiedCount": 1}
    group = [{"$group": {"_id": None, "total": {"$sum": "$age"}}}]
    assert engine.ejson({"action": "aggregate", "collection": "user", "pipeline": group})["documents"][0]["total"] == 5
    raw = engine.store.read("user").first()
    assert raw["user_id"] == 1 and raw["doc"]["age"] == "5" and raw["doc"]["#type"] == '"user_set"'
    assert engine.ejson({"action": "deleteOne", "collection": "user", "filter": {"age": 5}}) == {"deletedCount": 1}
    assert find() == []


def test_config_filters_and_follow(engine, spark, tmp_path):
    assert call(engine, "/config", filter={"exclude": ['#event_name == "buy" && n == 9']}) == (200, {"version": 1})
    log = tmp_path / "a.log"
    log.write_text(line("track", "f1", n=9) + "\n" + line("track", "f2", n=8) + "\n" + line("track", "f3")[:20])
    results = {}
    query = follow(engine, tail(spark, [f"{tmp_path}/*.log"]), str(tmp_path / "cp"), on_result=lambda k, r: results.update({k: r}))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert [(r.lines, r.events, r.filtered) for r in results.values() if r.lines] == [(2, 1, 1)]
    assert {r["uuid"] for r in engine.store.read("event").select("uuid").collect()} == {"u1", "u2", "f2"}


def numbers(engine, table, key):
    return sorted(r[0] for r in engine.store.read(table).select(key).collect())


def test_two_uploads_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    engines = [Engine(spark, str(tmp_path / "store")) for _ in range(2)]
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(engines[k % 2].upload, [line("track", f"p{k}-{i}", f"a{i}") for i in range(5)] + ["bad"]) for k in range(4)]
        assert [j.result().events for j in jobs] == [5] * 4
    assert numbers(engines[0], "event", "uuid") == sorted(f"p{k}-{i}" for k in range(4) for i in range(5))
    assert numbers(engines[0], "dead_letter", "_ts") == sorted(set(numbers(engines[0], "dead_letter", "_ts"))) and engines[0].store.read("dead_letter").count() == 4
    users = engines[0].documents.read("id_mapping")
    assert sorted((r["user_id"], r["account_id"]) for r in users.collect()) == [(i + 1, f"a{i}") for i in range(5)]


def test_a_writer_between_goes_first(spark, tmp_path):
    """Two writers that don't share a lock: what the later one read is read again, and an unrelated commit is built upon."""
    engine = Engine(spark, str(tmp_path / "store"))
    engine.upload([line("user_add", "x0", n=1)])
    other = Engine(spark, str(tmp_path / "store" / ".." / "store"))
    calls = []

    def change(tx):
        rows = tx.read("user").count()
        if not calls:
            other.upload([line("user_add", "x1", "a2", n=1)])
        calls.append(rows)
        tx.replace("copy", tx.read("user"))

    engine.store.update(change)
    assert calls == [1, 2] and engine.store.read("copy").count() == 2

    def unrelated(tx):
        other.upload([line("user_add", "x2", "a3", n=1)])
        tx.append("notes", spark.createDataFrame([("n",)], "text string"))

    engine.store.update(unrelated)
    assert engine.store.read("notes").count() == 1 and engine.store.read("user").count() == 3


def test_uploads_by_command_line_go_on(spark, tmp_path, monkeypatch, capsys):
    import io
    import sys

    from tidefold import __main__

    def run(function, text, *more):
        monkeypatch.setattr(sys, "stdin", io.StringIO(text))
        assert __main__.main([function, "--root", str(tmp_path / "store"), *more]) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    for v in (4, 99):
        assert run("upload", line("user_set", f"v{v}", v=v) + "\n\n" + line("track", f"t{v}") + "\n")["users"] == 1
    request = '{"action":"findOne","collection":"user","filter":{"#user_id":{"$numberLong":"1"}}}'
    assert run("ejson", request)["document"]["v"] == 99
    assert run("sql", "SELECT COUNT(*) AS n FROM event")["rows"] == [{"n": 2}]
    assert run("config", '{"filter":{"include":["#event_name == \\"x\\""]}}')["version"] == 1 and run("configget", "")["version"] == 1


def test_a_new_checkpoint_on_an_old_store(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "store"))
    for k in range(2):
        log = tmp_path / f"in{k}" / "a.log"
        log.parent.mkdir()
        log.write_text("\n".join([line("user_set", f"s{k}", v=k), line("track", f"t{k}")]) + "\n")
        for _ in range(2):  # the second start finds nothing new
            query = follow(engine, tail(spark, [f"{log}"]), str(tmp_path / f"cp{k}"))
            try:
                query.processAllAvailable()
            finally:
                query.stop()
    assert numbers(engine, "event", "uuid") == ["t0", "t1"]
    assert engine.store.read("user").first()["doc"]["v"] == "1"


def test_replayed_batches_change_nothing(spark, tmp_path):
    from tidefold.sources.files import from_lines

    engine = Engine(spark, str(tmp_path / "store"))
    lines = from_lines(spark, [line("user_add", "r", n=2), line("track", "rt")])
    for _ in range(2):
        engine.run(lines, stream="s", batch=0)
    assert engine.run(lines, stream="other", batch=0).users == 1
    assert engine.store.read("user").first()["doc"]["n"] == "4" and engine.store.read("event").count() == 1


def test_a_small_upload_leaves_other_buckets(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "store"))
    engine.upload([line("user_set", f"b{k}", f"a{k}", n=k) for k in range(60)] + [line("track", f"bt{k}", f"a{k}") for k in range(60)])
    before = engine.store.state().tables
    engine.upload([line("user_set", "again", "a7", n=8), line("track", "bt3", "a3"), line("track_update", "bt4", "a4", z=1), "bad"])
    after = engine.store.state().tables
    moved = lambda t: sum(before[t].parts[b] != after[t].parts.get(b) for b in before[t].parts)
    assert len(before["user"].parts) > 10 and moved("user") == 1 and moved("event") == 1 and moved("id_account") == 0
    assert engine.sql("SELECT n, COUNT(*) AS c FROM user WHERE n = 8 GROUP BY n").to_dict() == {"rows": [{"n": 8, "c": 2}]}
    now, added = engine.watch("event", 1)
    changed = sorted((r["uuid"], r["change"]) for r in added.collect())
    assert now == 2 and changed == [("bt4", "delete"), ("bt4", "insert")] and engine.watch("event", now)[1] is None


def test_appended_folders_are_merged_and_vacuumed(spark, tmp_path, monkeypatch):
    from tidefold.plans import store

    monkeypatch.setattr(store, "FAN", 3)
    s = store.Store(spark, str(tmp_path))
    for k in range(10):
        s.update(lambda tx, k=k: tx.append("log", spark.createDataFrame([(k,)], "k int")))
    (parts,) = s.state().tables["log"].parts.values()
    assert sorted(level for _, level in parts) == [0, 2] and sorted(r[0] for r in s.read("log").collect()) == list(range(10))
    s.vacuum()
    assert len(s.numbers()) == 2 and s.read("log").count() == 10 and len(s.list("data/log")) <= 5


def test_upload_modes(spark, tmp_path, monkeypatch):
    from tidefold.plans import engine as module

    engine = Engine(spark, str(tmp_path / "store"), mode="single")
    assert engine.upload([line("track", "m1"), line("track", "m2")]).events == 2 and engine.store.state().number == 2
    assert engine.upload([line("track", f"w{k}", f"a{k}") for k in range(6)], "pipeline").events == 6
    engine.batch_size = 2
    assert engine.upload([line("track", f"q{k}") for k in range(3)], " Batch ").events == 3 and engine.store.state().number == 5
    with pytest.raises(ValueError, match="unknown mode"):
        engine.upload([], "burst")

    def broken(*_):
        raise OSError("the disk is gone")

    monkeypatch.setattr(module, "ingest", broken)
    assert engine.upload([line("track", "lost")], "pipeline").to_dict()["write_errors"] == 1
    with pytest.raises(OSError):
        engine.upload([line("track", "lost")], "batch")


def test_bad_published_rules_leave_the_last_good_ones(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "store"))
    engine.publish_config({"filter": {"exclude": ["n == 9"]}})
    assert engine.rules() == ([], ["n == 9"])
    engine.config._write({"filter": {"exclude": ["n =="]}}, 2)
    assert engine.rules() == ([], ["n == 9"]) and engine.config_version == 2
    assert engine.upload([line("track", "g1", n=9), line("track", "g2", n=1)]).to_dict()["filtered"] == 1


def test_extended_json_round_trip(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "store"))
    document = {
        "_id": {"$oid": "507f1f77bcf86cd799439011"}, "t": {"$date": "2024-01-02T03:04:05Z"}, "n": {"$numberLong": "9007199254740993"},
        "d": {"$numberDecimal": "1.50"}, "inner": {"x": [1, 2], "when": {"$date": "2024-01-02T03:04:05.678Z"}}, "f": 1.5, "s": "text",
    }
    ask = lambda **r: json.loads(engine.ejson_bytes(json.dumps({"collection": "c", **r}).encode()))
    assert ask(action="insertOne", document=document) == {"insertedId": document["_id"]}
    found = ask(action="findOne", filter={"_id": document["_id"], "t": document["t"], "n": document["n"], "d": document["d"]})["document"]
    assert found == {**document, "n": 9007199254740993, "d": {"$numberDecimal": "1.500000000000000000"}}
    assert ask(action="find", filter={"t": {"$gt": {"$date": "2025-01-01T00:00:00Z"}}}) == {"documents": []}
    assert ask(action="updateOne", filter={"s": "text"}, update={"$set": {"s": "new", "u": {"$date": "2026-01-01T00:00:00Z"}}})["modifiedCount"] == 1
    assert ask(action="find", filter={}, projection={"u": 1, "_id": 0}) == {"documents": [{"u": {"$date": "2026-01-01T00:00:00Z"}}]}
    for bad in ({"action": "find", "filter": {"n": {"$near": 1}}}, {"action": "find", "filter": {"_id": {"$oid": "x"}}}, {"action": "drop"}, {"action": "insertOne"}):
        with pytest.raises(ValueError):
            ask(**bad)


def test_keys_of_documents_are_unique(engine, spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "store"))
    engine.upload([line("track", "k1"), line("user_set", "k2", n=1)])
    insert = lambda **d: engine.ejson({"action": "insertOne", "collection": "event", "document": d})
    assert insert(**{"#uuid": "k3", "n": 5}) == {"insertedId": "k3"}
    with pytest.raises(ValueError, match="duplicate key"):
        insert(**{"#uuid": "k1"})
    assert engine.sql("DELETE FROM event WHERE `#uuid` = 'k3'").to_dict() == {"deletedCount": 1}
    assert numbers(engine, "event", "uuid") == ["k1"]
    with pytest.raises(ValueError, match="read only"):
        engine.sql("INSERT INTO id_mapping VALUES (9, 'x', array())")


def test_reader_stops_at_a_long_line(caplog, monkeypatch):
    import io

    from tidefold.sources import files

    monkeypatch.setattr(files, "MAX_LINE", 10)
    with caplog.at_level("WARNING"):
        assert list(files.read_lines(io.StringIO("short\r\n" + "x" * 11 + "\nafter\n"))) == ["short"]
    assert "line 2 is longer than 10 bytes" in caplog.text
    assert files.normal_path("/mnt/c/logs/x") == files.normal_path("C:\\logs\\x") == "/c/logs/x"
    assert files.discover(["/no such folder/*.log"]) == []


def test_settings_in_yaml():
    from tidefold import settings

    text = """# a comment
store:
  root: /data   # trailing
  buckets: 8
server: {"host": "h"}
filter:
  include:
    - '#event_name == "a"'
    - n > 1
  exclude: ['x', "y"]
log_level: INFO
"""
    got = settings.load(text, {"TIDEFOLD_PORT": "7", "TIDEFOLD_ROOT": "12"})
    assert (got.root, got.buckets, got.host, got.port, got.log_level) == ("12", 8, "h", 7, "INFO")
    assert got.include == ['#event_name == "a"', "n > 1"] and got.exclude == ["x", "y"]
    for bad in ("just text", "- a\n- b", "a: 1\n    b: 2", "nonsense: 1"):
        with pytest.raises(ValueError):
            settings.load(bad, {})


def test_reporter_sums_and_summarises():
    from tidefold.plans.ingest import UploadResult
    from tidefold.streaming.follow import Reporter

    said = []
    reporter = Reporter(0.0, lambda kind, stats: said.append((kind, stats["lines"], stats["batches"])))
    reporter.add(0, UploadResult(lines=3, events=2))
    reporter.add(1, UploadResult(lines=4))
    reporter.close()
    assert said == [("statistics", 3, 1), ("statistics", 7, 2), ("summary", 7, 2)]


def test_users_are_looked_up_and_engines_made_from_settings(spark, tmp_path):
    made = Engine.from_settings(spark, f"store:\n  root: {tmp_path}/store\n  buckets: 4\nfilter:\n  exclude: ['n == 9']\n".encode(), mode="single")
    both = json.dumps({"#type": "track", "#uuid": "1", "#time": "t", "#event_name": "x", "#account_id": "a", "#distinct_id": "d"})
    only = json.dumps({"#type": "track", "#uuid": "2", "#time": "t", "#event_name": "x", "#distinct_id": "e"})
    assert made.upload([both, only, line("track", "3", n=9)]).to_dict()["filtered"] == 1
    assert [made.user_of(*ids) for ids in (("a", ""), ("", "d"), ("", "e"), ("new", "e"), ("a", "e"), ("", "new"))] == [1, 1, 2, 2, 1, None]
    assert made.store.state().tables["event"].buckets == 4
    with pytest.raises(ValueError, match="root"):
        Engine.from_settings(spark, "port: 1")


def test_batches_shrink_as_the_backlog_grows(tmp_path):
    from tidefold.sources.tail import TailReader

    log = tmp_path / "a.log"
    log.write_bytes(b"0123456789abcde\n" * 4096)
    ends = []
    for limit in (64, 2048, 1 << 20):
        reader = TailReader([str(log)], limit)
        ends.append(json.loads(reader.latestOffset()["files"])[str(log)][1])
    assert ends == [16, 512, 4096 * 16]


def test_served_answers(engine):
    import threading
    import urllib.request

    from tidefold.server import serve

    server = serve(engine, port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        body = json.dumps({"sql": "SELECT error FROM dead_letter"}).encode()
        with urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/sql", body) as got:
            assert json.loads(got.read()) == {"rows": [{"error": "invalid JSON"}]}
    finally:
        server.shutdown()
