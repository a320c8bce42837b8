"""Parsing, rules, and the folds and identities against sequential models."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidefold import settings
from tidefold.functions.records import parse_lines
from tidefold.functions.rules import RuleError, keep_record
from tidefold.operators import documents, folds
from tidefold.operators.folds import fold_events, fold_users
from tidefold.operators.identity import assign, bindings, resolve
from tidefold.plans.config_store import ConfigWatcher, merge, union_rules
from tidefold.sources.files import discover, from_files, normal_path, walk_root
from tidefold.sources.tail import flush_threshold


def line(kind, uuid, account="a1", distinct="", name="ev", **props):
    doc = {"#type": kind, "#uuid": uuid, "#time": "2024-01-01", "#event_name": name, "#account_id": account, "#distinct_id": distinct}
    return json.dumps({**{k: v for k, v in doc.items() if v}, "properties": props})


def test_parse_cases(spark):
    good = line("track", "1", x=1)
    cases = [
        good, '{"a":1} xyz', "{'a':1}", '{"a":NaN}', '{"a":1,"a":2}', "[1]", "null", "{}", '{"#type":"track","#uuid":5}',
        json.dumps({"msg": "no", "message": good}), json.dumps({"msg": '{"#type":"bad"}', "log": good}), '{"#type":"track","#uuid":"u","#time":"t","#event_name":"n","#account_id":12345}',
        '{"#type":"track","#uuid":"u","#time":"t","#event_name":"n","#account_id":"r","properties":{"#account_id":"p","#uuid":"w","q":[1,{"z":"é"}]}}',
        '{"#type":"track","#uuid":"u","#time":"t","#event_name":"n","#account_id":"r","properties":7}', "", None,
    ]
    df = spark.createDataFrame(list(enumerate(cases)), "seq long, line string")
    df = df.select("line", "seq")
    got = {r["seq"]: r for r in parse_lines(df).collect()}
    assert sorted(got) == list(range(14))
    assert [got[i]["error"] for i in range(9)] == [None, *["invalid JSON"] * 3, "not a log payload", "invalid JSON", "not a log payload", "not a log payload", "#type and #uuid are required (non-empty)"]
    assert got[9]["error"] is None and got[10]["error"].startswith("#type and #uuid")
    assert "at least one" in got[11]["error"]
    assert got[12]["account_id"] == "r" and got[12]["doc"]["#account_id"] == '"p"' and got[12]["doc"]["#uuid"] == '"u"' and json.loads(got[12]["doc"]["q"]) == [1, {"z": "é"}]
    assert got[13]["doc"]["properties"] == "7"


def test_rules(spark):
    doc = {"#type": '"track"', "level": "5", "name": '"Ann"', "tags": '["a","b"]', "o": '{"k":2}'}
    df = spark.createDataFrame([(doc,)], "doc map<string,string>")
    want = {
        '#type == "track"': (True, False), "level >= 5 && level < 6": (True, False), 'level in [1, 5]': (True, False), 'name in ["x"]': (False, False),
        'missing == "a"': (False, False), 'not (missing == "a")': (True, False), "missing > 3": (False, True), "name > 3": (False, True), "level": (False, True),
        'name contains "n" and name endsWith "n"': (True, False), 'name matches "^A.n$"': (True, False), "missing ?? 5 == 5": (True, False), "o.k + 1 == 3": (True, False),
        '"a" in tags': (True, False), "len(name) == 3 ? true : false": (True, False), "missing == nil": (True, False), "false && missing > 1": (False, False),
        'name not in ["Bob"]': (True, False), "-level == -5": (True, False), "`Ann` == name": (True, False),
    }
    for rule, expected in want.items():
        kept, failed = keep_record([rule], [], F.col("doc"))
        assert tuple(df.select(kept, failed).first()) == expected, rule
    for bad in ("level + 1", "==", "a ==", '"x"', "level @ 2", "(a", "[1]"):
        with pytest.raises(RuleError):
            keep_record([bad], [], F.col("doc"))
    with pytest.raises(RuleError, match=r"exclude\[1\]"):
        keep_record([], ["level > 1", "1 + 1"], F.col("doc"))


def sequential_identity(rows, mapping=None):
    accounts, devices, has = {}, {}, {}
    for u, a, ds in mapping or []:
        if a:
            accounts[a], has[u] = u, a
        devices.update(dict.fromkeys(ds, u))
    top = max((u for u, *_ in mapping or []), default=0)
    out = []
    for a, d in rows:
        if a and a in accounts:
            u = accounts[a]
            if d and d not in devices:
                devices[d] = u
        elif a:
            if d and d in devices and devices[d] not in has:
                u = devices[d]
            else:
                u = top = top + 1
                if d and d not in devices:
                    devices[d] = u
            accounts[a], has[u] = u, a
        elif d in devices:
            u = devices[d]
        else:
            u = top = top + 1
            devices[d] = u
        out.append(u)
    return out


def test_identity_in_two_batches(spark):
    rng = random.Random(4)
    for _ in range(4):
        rows = [(rng.choice(["", "a1", "a2", "a3", "a4"]), rng.choice(["", "d1", "d2", "d3", "d4"])) for _ in range(24)]
        rows = [(a, d) if a or d else ("a1", d) for a, d in rows]
        frame = spark.createDataFrame([(i, a, d) for i, (a, d) in enumerate(rows)], "seq long, account_id string, distinct_id string")
        want = sequential_identity(rows)
        assert [r["user_id"] for r in resolve(frame).orderBy("seq").collect()] == want
        one = bindings(*assign(frame.where("seq < 12")))
        mapping = spark.createDataFrame(one.collect(), "user_id long, account_id string, distinct_ids array<string>")
        two = resolve(frame.where("seq >= 12"), mapping)
        assert [r["user_id"] for r in two.orderBy("seq").collect()] == want[12:]


def sequential_user(ops):
    doc = None
    for _, kind, value, ts in ops:
        if kind == "user_del":
            doc = None
            continue
        if kind == "user_setOnce":
            if doc is None:
                doc = {"p": value, "_ts": ts}
            doc["_ts"] = max(doc["_ts"], ts)
        elif kind == "user_add":
            doc = doc or {"_ts": ts}
            doc["p"] = doc.get("p", 0) + value
            doc["_ts"] = max(doc["_ts"], ts)
        elif doc is None or doc["_ts"] <= ts:
            doc = {**(doc or {}), "_ts": ts}
            if kind == "user_unset":
                doc.pop("p", None)
            else:
                doc["p"] = value
    return doc


def test_user_fold_in_two_batches(spark):
    rng = random.Random(9)
    kinds = ["user_set", "user_setOnce", "user_add", "user_unset", "user_del", "user_other"]
    rows = [(u, s, rng.choice(kinds), rng.randint(1, 9), s + rng.choice([0, 0, -4, -9])) for u in range(25) for s in range(10)]
    frame = spark.createDataFrame(rows, "user_id long, seq long, type string, v int, _ts long").withColumn(
        "doc", F.create_map(F.lit("p"), F.col("v").cast("string"), F.lit("_ts"), F.col("_ts").cast("string"))
    )
    want = {u: sequential_user([r[1:] for r in rows if r[0] == u]) for u in range(25)}
    read = lambda df: {r["user_id"]: {k: int(v) for k, v in r["doc"].items()} for r in df.collect()}
    assert read(fold_users(frame)) == {u: d for u, d in want.items() if d is not None}
    stored = spark.createDataFrame(fold_users(frame.where("seq < 5")).collect(), "user_id long, doc map<string,string>")
    assert read(fold_users(frame.where("seq >= 5"), stored)) == {u: d for u, d in want.items() if d is not None}


def sequential_events(ops):
    doc = None
    for _, kind, value, ts in ops:
        if kind == "track_update" and doc is not None and doc["_ts"] <= ts or kind == "track_update" and doc is None:
            doc = {**(doc or {}), **value, "_ts": ts}
        elif kind == "track_overwrite" and (doc is None or doc["_ts"] <= ts) or kind == "track" and doc is None:
            doc = {**value, "_ts": ts}
    return doc


def test_hot_keys_fold_by_ranges(spark, monkeypatch):
    """Keys of many operations give what the sequential models give, and what the common way gives."""
    rng = random.Random(10)
    kinds = ["user_set", "user_setOnce", "user_add", "user_unset", "user_del", "user_other"]
    rows = [(u, s, rng.choices(kinds, [5, 2, 5, 2, 0.3, 2])[0], rng.randint(1, 9), s + rng.choice([0, 0, -4, -9])) for u in range(6) for s in range(5 if u > 2 else 90)]
    frame = spark.createDataFrame(rows, "user_id long, seq long, type string, v int, _ts long").withColumn(
        "doc", F.create_map(F.lit("p"), F.col("v").cast("string"), F.lit("_ts"), F.col("_ts").cast("string"))
    )
    lists = frame.withColumn("type", F.when(F.col("seq") % 11 == 0, "user_set").when(F.col("seq") % 2 == 0, "user_append").otherwise("user_uniq_append"))
    read = lambda df, key="user_id": {r[key]: r["doc"] for r in df.collect()}
    common = read(fold_users(lists))
    ev = ["track", "track_update", "track_overwrite"]
    events = [(f"k{u}", s, rng.choice(ev), {f"f{rng.randint(0, 2)}": str(s)}, s + rng.choice([0, 0, -3, -8])) for u in range(5) for s in range(4 if u > 1 else 80)]
    event_frame = spark.createDataFrame(events, "uuid string, seq long, type string, doc map<string,string>, _ts long")
    event_frame = event_frame.withColumn("doc", F.map_concat("doc", F.create_map(F.lit("_ts"), F.col("_ts").cast("string"))))
    monkeypatch.setattr(folds, "HOT_ROWS", 20)
    assert set(folds.hot_keys(frame, "user_id", None)) == {0, 1, 2} and folds.hot_keys(frame, "user_id", 20) == {}
    want = {u: sequential_user([r[1:] for r in rows if r[0] == u]) for u in range(6)}
    assert {u: {k: int(v) for k, v in d.items()} for u, d in read(fold_users(frame)).items()} == {u: d for u, d in want.items() if d is not None}
    assert read(fold_users(lists)) == common
    want = {f"k{u}": sequential_events([r[1:] for r in events if r[0] == f"k{u}"]) for u in range(5)}
    assert read(fold_events(event_frame), "uuid") == {k: {**d, "_ts": str(d["_ts"])} for k, d in want.items()}


def test_running_totals_by_ranges(spark, monkeypatch):
    from tidefold.operators import order

    monkeypatch.setattr(order, "RANGE_ROWS", 7)
    rng = random.Random(3)
    for kind in ("long", "string"):
        rows = {f"{rng.randint(0, 10**6):07d}": rng.randint(0, 9) for _ in range(60)}
        df = spark.createDataFrame([(k, v) for k, v in rows.items()], "k string, v int").withColumn("k", F.col("k").cast(kind))
        got = {r["k"]: r["t"] for r in order.running_total(df, "k", F.col("v"), "t").collect()}
        assert got == {(int(k) if kind == "long" else k): sum(v for o, v in rows.items() if o < k) for k in rows}


def test_lists_and_events(spark):
    doc = lambda v: {"t": v}
    ops = [(1, 1, "user_append", doc('["a","a"]'), 1), (1, 2, "user_uniq_append", doc('["b","a","b"]'), 2), (1, 3, "user_append", doc('"b"'), 3)]
    got = fold_users(spark.createDataFrame(ops, "user_id long, seq long, type string, doc map<string,string>, _ts long")).first()
    assert got["doc"]["t"] == '["a","a","b","b"]'
    ops = [("k", 1, "track", {"a": "1", "b": "1"}, 10), ("k", 2, "track", {"a": "9"}, 11), ("k", 3, "track_update", {"a": "2"}, 12), ("k", 4, "track_update", {"a": "3"}, 5)]
    frame = spark.createDataFrame(ops, "uuid string, seq long, type string, doc map<string,string>, _ts long")
    assert fold_events(frame).first()["doc"] == {"a": "2", "b": "1"}


def test_files(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b/x.log").write_text("1\n\n2\n")
    (tmp_path / "a.log").write_text("3\n")
    assert [r["line"] for r in from_files(spark, str(tmp_path), "*.log").orderBy("seq").collect()] == ["3", "1", "2"]
    assert discover([f"{tmp_path}/**/*.log", f"{tmp_path}/a.*"]) == [f"{tmp_path}/a.log", f"{tmp_path}/b/x.log"]
    assert walk_root("/var/log/*/x.log") == "/var/log" and normal_path("C:\\x\\y") == "/c/x/y"


def test_small_things(spark):
    assert union_rules(["a", "a"], ["b", "a", "b"]) == ["a", "a", "b"]
    assert merge({"filter": {"include": ["x"]}, "version": 3}, {"filter": {"exclude": ["y"]}}) == {"filter": {"include": ["x"], "exclude": ["y"]}}
    assert [flush_threshold(10, 100, 1000, b, 100) for b in (0, 50, 100, 25)] == [1000, 100, 10, 550]
    seen, docs = [], iter([{"version": 2}, {"version": 2}, {"version": 1}, {"version": "3"}])
    watcher = ConfigWatcher(lambda: next(docs), seen.append)
    assert [watcher.poll() for _ in range(4)] == [True, False, False, True] and watcher.ready
    s = settings.load("root: /x\nport: 9", {"TIDEFOLD_PORT": "7"}, host="h")
    assert (s.root, s.port, s.host) == ("/x", 7, "h") and settings.load(b'{"root": "/y"}', {}).root == "/y"
    df = spark.createDataFrame([(1, [1, 2], None), (2, [3], "z")], "_id int, xs array<int>, s string")
    count = lambda q: df.where(documents.compile_filter(df, q)).count()
    assert [count(q) for q in ({"xs": 2}, {"s": None}, {"s": {"$ne": "z"}}, {"nothing": None}, {"s": 5}, {"$nor": [{"_id": 1}]}, {"xs": {"$size": 1}}, {"s": {"$regex": "^Z", "$options": "i"}})] == [1, 1, 1, 2, 0, 1, 1, 1]
