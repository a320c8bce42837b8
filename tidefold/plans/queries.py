"""Registered queries over the driver's tables, each with its SQL.

Log lines are made from ``events``: the type of operation goes by event_id, the account is the user,
the device a modulus of event_id.
"""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.extended_json import decode
from ..functions.records import dead_letters, parse_lines
from ..functions.rules import keep_record
from ..operators import documents
from ..operators.folds import fold_events, fold_users
from ..operators.identity import assign, bindings, resolve
from .engine import Engine
from .ingest import classify, statistics
from .sql_api import SqlError
from .store import Transaction

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for a query's own store, in the warehouse, which all executors share; it goes with the process if it is local."""
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidefold-{uuid.uuid4().hex}"
    if root.startswith(("file:", "/")):
        atexit.register(shutil.rmtree, "/" + root.removeprefix("file:").lstrip("/"), ignore_errors=True)
    return root


def _engine(spark: SparkSession, **tables: DataFrame) -> Engine:
    """An engine over a store that holds the given tables."""
    engine = Engine(spark, scratch(spark))

    def fill(tx: Transaction) -> None:
        for name, df in tables.items():
            tx.replace(name, df)

    if tables:
        engine.store.update(fill)
    return engine


def _answer(spark: SparkSession, engine: Engine, schema: str, **request) -> DataFrame:
    """The documents that a request gives."""
    got = engine.ejson(request)
    names = [f.name for f in StructType.fromDDL(schema)]
    documents = got.get("documents", [got["document"]] if "document" in got else [])
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in documents], schema)


def _lines(spark: SparkSession, sf_dir: str, kind: Column, **fields: Column) -> DataFrame:
    """(line, seq, ts): a line of JSON for each event; null fields are left out.

    The rows of a table that is a single small file are dealt to all cores, since parsing is their work.
    """
    e = table(spark, sf_dir, "events")
    if (cores := spark.sparkContext.defaultParallelism) > e.rdd.getNumPartitions():
        e = e.repartition(cores)
    base = {
        "#uuid": F.concat(F.lit("e"), "event_id"), "#type": kind, "#time": F.lit("2024-01-01 00:00:00"),
        "#event_name": F.col("event_type"), "#account_id": F.concat(F.lit("u"), "user_id"),
    }
    props = {"value": F.col("value"), "n": F.col("event_id") % 10}
    line = F.to_json(F.struct(*[v.alias(k) for k, v in {**base, "properties": F.struct(*[v.alias(k) for k, v in props.items()]), **fields}.items()]))
    return e.select(line.alias("line"), F.col("event_id").alias("seq"), "event_id")


@query(
    """SELECT kind, count(*) AS n FROM (SELECT CASE event_id % 8 WHEN 0 THEN 'error' WHEN 1 THEN 'error' WHEN 2 THEN 'user' ELSE 'event' END AS kind
    FROM events) GROUP BY kind"""
)
def parse_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 8
    lines = _lines(spark, sf_dir, F.when(m == 1, "nonsense").when(m == 2, "user_set").otherwise("track"))
    lines = lines.withColumn("line", F.when(m == 0, F.concat("line", F.lit(" trailing"))).otherwise(F.col("line")))
    kind = F.when(F.col("error").isNotNull(), "error").otherwise(F.col("category"))
    return parse_lines(lines).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT error, count(*) AS n FROM (SELECT CASE event_id % 8
      WHEN 0 THEN 'invalid JSON' WHEN 1 THEN 'unsupported #type "nonsense": only user_* and track* are allowed'
      WHEN 2 THEN '#type and #uuid are required (non-empty)' WHEN 3 THEN 'event record: #time is required'
      WHEN 4 THEN 'event record: at least one of #account_id or #distinct_id is required' WHEN 5 THEN 'not a log payload'
      WHEN 6 THEN 'user record: #time is required' END AS error FROM events) WHERE error IS NOT NULL GROUP BY error"""
)
def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 8
    kind = F.when(m == 1, "nonsense").when(m == 6, "user_set").otherwise("track")
    lines = _lines(
        spark, sf_dir, kind,
        **{"#uuid": F.when(m != 2, F.lit("x")), "#time": F.when(~m.isin(3, 6), F.lit("t")), "#account_id": F.when(m != 4, F.lit("a"))},
    )
    bad = F.when(m == 0, F.lit("{'single': 1}")).when(m == 5, F.lit('{"other":1}')).otherwise(F.col("line"))
    parsed = parse_lines(lines.withColumn("line", bad))
    return dead_letters(parsed).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT event_type AS event_name, count(*) AS n, CAST(sum(event_id % 10) AS BIGINT) AS total FROM events WHERE event_id % 4 <> 3 GROUP BY event_type"""
)
def envelope_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, F.lit("track"))
    m = F.col("event_id") % 4
    key = F.when(m == 0, "msg").when(m == 1, "message").when(m == 2, "log").otherwise("other")
    wrapped = lines.withColumn("line", F.to_json(F.create_map(F.lit("level"), F.lit("info"), key, F.col("line"))))
    good = parse_lines(wrapped).where("error is null")
    name = F.get_json_object(F.concat(F.lit("["), F.col("doc")["#event_name"], F.lit("]")), "$[0]")
    return good.groupBy(name.alias("event_name")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("doc")["n"].cast("long")).alias("total"))


@query("""SELECT event_id FROM events WHERE (event_type = 'click' OR event_id % 10 >= 7) AND NOT (event_type = 'click' AND event_id % 10 IN (1, 2))""")
def filter_include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = parse_lines(_lines(spark, sf_dir, F.lit("track")))
    kept, _ = keep_record(['#event_name == "click"', "properties.n >= 7"], ['#event_name startsWith "cli" && n in [1, 2]'], F.col("doc"))
    return records.where(kept).select(F.col("seq").alias("event_id"))


@query(
    """SELECT kept, failed, count(*) AS n FROM (SELECT (event_id % 3 = 0) AS kept, (event_id % 3 <> 0) AS failed FROM events) GROUP BY kept, failed"""
)
def filter_null_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comparison with a missing field fails and doesn't match; inequality with it is true."""
    lines = _lines(spark, sf_dir, F.lit("track"), extra=F.when(F.col("event_id") % 3 == 0, F.lit(5)))
    kept, failed = keep_record(['extra > 3 and not (missing == "a")'], [], F.col("doc"))
    return parse_lines(lines).groupBy(kept.alias("kept"), failed.alias("failed")).agg(F.count(F.lit(1)).alias("n"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with account, device or both: enough of each to meet every rule of resolution."""
    e = table(spark, sf_dir, "events")
    m = F.col("event_id") % 3
    account = F.when(m != 0, F.concat(F.lit("a"), F.col("user_id") % 400)).otherwise("")
    device = F.when(m != 1, F.concat(F.lit("d"), F.col("event_id") % 701)).otherwise("")
    return e.select(F.col("event_id").alias("seq"), account.alias("account_id"), device.alias("distinct_id"))


_IDENTITY = """WITH r AS (SELECT event_id AS seq, CASE WHEN event_id % 3 <> 0 THEN 'a' || (user_id % 400) ELSE '' END AS a,
  CASE WHEN event_id % 3 <> 1 THEN 'd' || (event_id % 701) ELSE '' END AS d FROM events),
fa AS (SELECT a, min(seq) AS s, arg_min(d, seq) AS d1 FROM r WHERE a <> '' GROUP BY a),
fd AS (SELECT d, min(seq) AS s, arg_min(a, seq) AS a1 FROM r WHERE d <> '' GROUP BY d),
ua AS (SELECT fa.a, CASE WHEN fd.a1 = '' AND row_number() OVER (PARTITION BY fd.d ORDER BY fa.s) = 1 THEN fd.s ELSE fa.s END AS u
  FROM fa LEFT JOIN fd ON fa.d1 = fd.d AND fd.a1 = ''),
ud AS (SELECT fd.d, coalesce(ua.u, fd.s) AS u FROM fd LEFT JOIN ua ON fd.a1 = ua.a),
n AS (SELECT u, dense_rank() OVER (ORDER BY u) AS user_id FROM (SELECT u FROM ua UNION SELECT u FROM ud)),
res AS (SELECT r.seq, r.a, r.d, n.user_id FROM r LEFT JOIN ua ON r.a = ua.a LEFT JOIN ud ON r.d = ud.d LEFT JOIN n ON n.u = coalesce(ua.u, ud.u))
"""


@query(_IDENTITY + "SELECT seq, a AS account_id, d AS distinct_id, user_id FROM res")
def identity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve(_records(spark, sf_dir))


@query(
    _IDENTITY
    + """, first_d AS (SELECT d, arg_min(user_id, seq) AS user_id, min(seq) AS seq FROM res WHERE d <> '' GROUP BY d),
  acc AS (SELECT user_id, arg_min(a, seq) AS a FROM res WHERE a <> '' GROUP BY user_id),
  lst AS (SELECT user_id, string_agg(d, ',' ORDER BY seq) AS ds FROM first_d GROUP BY user_id)
  SELECT coalesce(acc.user_id, lst.user_id) AS user_id, a AS account_id, coalesce(ds, '') AS distinct_ids FROM acc FULL JOIN lst ON acc.user_id = lst.user_id"""
)
def identity_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bindings(*assign(_records(spark, sf_dir)))
    return found.withColumn("distinct_ids", F.array_join("distinct_ids", ","))


def _ops(spark: SparkSession, sf_dir: str, kind: Column, value: Column, stale: bool = False) -> DataFrame:
    """Operations on property ``p`` of each user; with ``stale``, every fifth comes with an old ``_ts``."""
    e = table(spark, sf_dir, "events")
    ts = F.col("event_id") - F.when((F.col("event_id") % 5 == 0) & F.lit(stale), 3000).otherwise(0)
    doc = F.create_map(F.lit("p"), value, F.lit("#type"), F.concat(F.lit('"'), kind, F.lit('"')), F.lit("_ts"), ts.cast("string"))
    return e.select("user_id", F.col("event_id").alias("seq"), kind.alias("type"), doc.alias("doc"), ts.alias("_ts"))


def _p(folded: DataFrame, key: str = "user_id") -> DataFrame:
    return folded.select(key, F.try_element_at("doc", F.lit("p")).alias("p"))


@query("SELECT user_id, CAST(arg_max(event_id % 97, event_id) AS VARCHAR) AS p FROM events GROUP BY user_id")
def user_set_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p(fold_users(_ops(spark, sf_dir, F.lit("user_set"), (F.col("event_id") % 97).cast("string"))))


@query(
    """WITH o AS (SELECT user_id, event_id AS seq, event_id - CASE WHEN event_id % 5 = 0 THEN 3000 ELSE 0 END AS ts FROM events),
  g AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM o)
  SELECT user_id, CAST(arg_max(seq % 97, seq) FILTER (prev IS NULL OR ts >= prev) AS VARCHAR) AS p FROM g GROUP BY user_id"""
)
def user_set_stale_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p(fold_users(_ops(spark, sf_dir, F.lit("user_set"), (F.col("event_id") % 97).cast("string"), stale=True)))


@query("SELECT user_id, CAST(arg_min(event_id % 97, event_id) AS VARCHAR) AS p FROM events GROUP BY user_id")
def user_set_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p(fold_users(_ops(spark, sf_dir, F.lit("user_setOnce"), (F.col("event_id") % 97).cast("string"))))


@query(
    """WITH r AS (SELECT user_id, event_id, max(CASE WHEN event_id % 8 = 0 THEN event_id END) OVER (PARTITION BY user_id) AS pos FROM events)
  SELECT user_id, CAST(CAST(sum(event_id % 7) AS BIGINT) AS VARCHAR) AS p FROM r WHERE pos IS NULL OR event_id >= pos GROUP BY user_id"""
)
def user_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 8 == 0, "user_set").otherwise("user_add")
    return _p(fold_users(_ops(spark, sf_dir, kind, (F.col("event_id") % 7).cast("string"))))


@query(
    """SELECT user_id, CASE WHEN max(event_id) % 3 = 0 THEN NULL ELSE CAST(max(event_id) % 97 AS VARCHAR) END AS p FROM events GROUP BY user_id"""
)
def user_unset(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 3 == 0, "user_unset").otherwise("user_set")
    return _p(fold_users(_ops(spark, sf_dir, kind, (F.col("event_id") % 97).cast("string"))))


@query(
    """WITH r AS (SELECT user_id, event_id, max(CASE WHEN event_id % 11 = 0 THEN event_id END) OVER (PARTITION BY user_id) AS pos FROM events)
  SELECT user_id, CAST(CAST(sum(event_id % 7) AS BIGINT) AS VARCHAR) AS p FROM r WHERE pos IS NULL OR event_id > pos GROUP BY user_id"""
)
def user_del(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 11 == 0, "user_del").otherwise("user_add")
    return _p(fold_users(_ops(spark, sf_dir, kind, (F.col("event_id") % 7).cast("string"))))


@query("""SELECT user_id, '[' || string_agg(CAST(event_id % 9 AS VARCHAR), ',' ORDER BY event_id) || ']' AS p FROM events GROUP BY user_id""")
def user_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p(fold_users(_ops(spark, sf_dir, F.lit("user_append"), F.concat(F.lit("["), F.col("event_id") % 9, F.lit("]")))))


@query(
    """SELECT user_id, '[' || string_agg(CAST(x AS VARCHAR), ',' ORDER BY first_id) || ']' AS p
  FROM (SELECT user_id, event_id % 9 AS x, min(event_id) AS first_id FROM events GROUP BY user_id, event_id % 9) GROUP BY user_id"""
)
def user_uniq_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p(fold_users(_ops(spark, sf_dir, F.lit("user_uniq_append"), F.concat(F.lit("["), F.col("event_id") % 9, F.lit("]")))))


def _event_ops(spark: SparkSession, sf_dir: str, kind: Column) -> DataFrame:
    e = table(spark, sf_dir, "events")
    field = F.concat(F.lit("f"), F.col("event_id") % 3)
    doc = F.create_map(F.lit("p"), (F.col("event_id") % 97).cast("string"), field, F.col("event_id").cast("string"))
    return e.select(F.concat(F.lit("k"), F.col("user_id")).alias("uuid"), F.col("event_id").alias("seq"), kind.alias("type"), doc.alias("doc"), F.col("event_id").alias("_ts"))


def _event_fields(folded: DataFrame) -> DataFrame:
    return folded.select("uuid", *[F.try_element_at("doc", F.lit(k)).alias(k) for k in ("p", "f0", "f1", "f2")])


def _event_sql(rows: str) -> str:
    fields = ", ".join(f"CAST(max(event_id) FILTER (event_id % 3 = {k}) AS VARCHAR) AS f{k}" for k in range(3))
    return f"SELECT 'k' || user_id AS uuid, CAST(arg_max(event_id % 97, event_id) AS VARCHAR) AS p, {fields} FROM ({rows}) GROUP BY user_id"


@query(_event_sql("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id"))
def event_track_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_fields(fold_events(_event_ops(spark, sf_dir, F.lit("track"))))


@query(_event_sql("SELECT user_id, event_id FROM events"))
def event_track_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_fields(fold_events(_event_ops(spark, sf_dir, F.lit("track_update"))))


@query(
    _event_sql(
        "SELECT user_id, event_id FROM (SELECT *, max(CASE WHEN event_id % 6 = 0 THEN event_id END) OVER (PARTITION BY user_id) AS pos FROM events) WHERE pos IS NULL OR event_id >= pos"
    )
)
def event_track_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 6 == 0, "track_overwrite").otherwise("track_update")
    return _event_fields(fold_events(_event_ops(spark, sf_dir, kind)))


@query("""SELECT event_id AS seq, 'not a log payload' AS error, '{"id":' || event_id || '}' AS line FROM events WHERE event_id % 10 = 0""")
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, F.lit("track"))
    bad = F.concat(F.lit('{"id":'), "event_id", F.lit("}"))
    lines = lines.withColumn("line", F.when(F.col("event_id") % 10 == 0, bad).otherwise(F.col("line")))
    return dead_letters(parse_lines(lines)).select(F.col("_ts").alias("seq"), "error", "line")


@query(
    """SELECT kind, count(*) AS n, CAST(0 AS BIGINT) AS failed FROM (SELECT CASE WHEN event_id % 8 = 0 THEN 'error' WHEN event_type = 'view' THEN 'filtered'
  WHEN event_id % 8 = 1 THEN 'user' ELSE 'event' END AS kind FROM events) GROUP BY kind"""
)
def upload_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("event_id") % 8
    lines = _lines(spark, sf_dir, F.when(m == 0, "other").when(m == 1, "user_set").otherwise("track"))
    return statistics(classify(lines, exclude=['#event_name == "view"']))


_ORDERS = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IN ('O', 'P') ORDER BY o_orderkey DESC LIMIT 100 OFFSET 10"


@query(_ORDERS)
def ejson_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = _engine(spark, orders=table(spark, sf_dir, "orders"))
    spec = {"o_totalprice": {"$gt": {"$numberLong": "100000"}}, "o_orderstatus": {"$in": ["O", "P"]}}
    return _answer(
        spark, engine, "o_orderkey long, o_totalprice double", action="find", collection="orders", filter=spec,
        projection={"o_orderkey": 1, "o_totalprice": 1, "_id": 0}, sort={"o_orderkey": -1}, skip=10, limit=100,
    )


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 1")
def ejson_find_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = _engine(spark, customer=table(spark, sf_dir, "customer"))
    return _answer(
        spark, engine, "c_custkey long, c_name string", action="findOne", collection="customer", filter={"c_mktsegment": "BUILDING"},
        projection={"c_custkey": 1, "c_name": 1}, sort={"c_custkey": 1},
    )


@query("SELECT l_returnflag AS _id, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY l_returnflag")
def ejson_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = {"$group": {"_id": "$l_returnflag", "n": {"$sum": 1}, "lines": {"$sum": "$l_linenumber"}}}
    out = documents.aggregate(table(spark, sf_dir, "lineitem"), [stage])
    return out.select("_id", F.col("n").cast("long").alias("n"), F.col("lines").cast("long").alias("lines"))


@query(
    """SELECT o_custkey AS _id, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice <= 5000 GROUP BY o_custkey ORDER BY n DESC, _id LIMIT 50"""
)
def ejson_match_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    match = {"$or": [{"o_orderpriority": "1-URGENT"}, {"o_totalprice": {"$lte": 5000}}]}
    stages = [{"$match": match}, {"$group": {"_id": "$o_custkey", "n": {"$sum": 1}}}, {"$sort": {"n": -1, "_id": 1}}, {"$limit": 50}]
    engine = _engine(spark, orders=table(spark, sf_dir, "orders"))
    return _answer(spark, engine, "_id long, n long", action="aggregate", collection="orders", pipeline=stages)


@query(
    """SELECT n_name AS _id, count(*) AS suppliers, round(min(s_acctbal), 2) AS low, round(max(s_acctbal), 2) AS high
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name"""
)
def ejson_lookup_unwind(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = [
        {"$lookup": {"from": "nation", "localField": "s_nationkey", "foreignField": "n_nationkey", "as": "nation"}},
        {"$unwind": "$nation"},
        {"$group": {"_id": "$nation.n_name", "suppliers": {"$sum": 1}, "low": {"$min": "$s_acctbal"}, "high": {"$max": "$s_acctbal"}}},
    ]
    engine = _engine(spark, supplier=table(spark, sf_dir, "supplier"), nation=table(spark, sf_dir, "nation"))
    out = _answer(spark, engine, "_id string, suppliers long, low double, high double", action="aggregate", collection="supplier", pipeline=stages)
    return out.select("_id", "suppliers", F.round("low", 2).alias("low"), F.round("high", 2).alias("high"))


@query(
    """SELECT 'all' AS name, count(*) AS n FROM part UNION ALL SELECT 'small', count(*) FROM part WHERE p_size < 10
  UNION ALL SELECT 'branded', count(*) FROM part WHERE p_brand IS NOT NULL"""
)
def ejson_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """$facet, $count and $exists."""
    count = [{"$count": "n"}]
    facet = {"all": count, "small": [{"$match": {"p_size": {"$lt": 10}}}, *count], "branded": [{"$match": {"p_brand": {"$exists": True}}}, *count]}
    engine = _engine(spark, part=table(spark, sf_dir, "part"))
    (got,) = engine.ejson({"action": "aggregate", "collection": "part", "pipeline": [{"$facet": facet}]})["documents"]
    return spark.createDataFrame([(k, (v or [{"n": 0}])[0]["n"]) for k, v in got.items()], "name string, n long")


_PART = "SELECT p_partkey AS _id, p_brand, p_size FROM part"


def _part(spark: SparkSession, sf_dir: str) -> Engine:
    return _engine(spark, part=table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_id"), "p_brand", "p_size"))


@query(f"SELECT _id, p_brand, CASE WHEN _id = (SELECT min(p_partkey) FROM part WHERE p_size > 40) THEN p_size + 100 ELSE p_size END AS p_size FROM ({_PART})")
def ejson_update_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = _part(spark, sf_dir)
    engine.ejson({"action": "updateOne", "collection": "part", "filter": {"p_size": {"$gt": 40}}, "update": {"$inc": {"p_size": 100}}})
    return engine.documents.read("part")


@query(f"SELECT _id, CASE WHEN _id = 7 THEN 'set' ELSE p_brand END AS p_brand, CASE WHEN _id = 7 THEN NULL ELSE p_size END AS p_size, CASE WHEN _id = 7 THEN 'x,y' END AS tags FROM ({_PART})")
def ejson_update_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """$set, $unset, $push, $addToSet and $max on one document."""
    engine = _part(spark, sf_dir)
    ask = lambda update: engine.ejson({"action": "updateOne", "collection": "part", "filter": {"_id": {"$numberLong": "7"}}, "update": update})
    ask({"$set": {"p_brand": "set", "tags": ["x"]}, "$max": {"p_size": 1000}})
    ask({"$addToSet": {"tags": {"$each": ["x", "y"]}}, "$unset": {"p_size": ""}})
    return engine.documents.read("part").select("_id", "p_brand", F.col("p_size").cast("int").alias("p_size"), F.array_join("tags", ",").alias("tags"))


@query(f"SELECT * FROM ({_PART}) WHERE _id <> (SELECT min(p_partkey) FROM part WHERE p_size > 40)")
def ejson_delete_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = _part(spark, sf_dir)
    engine.ejson({"action": "deleteOne", "collection": "part", "filter": {"p_size": {"$gt": 40}}})
    return engine.documents.read("part")


@query(f"SELECT * FROM ({_PART}) UNION ALL SELECT 0, 'new', NULL UNION ALL SELECT -1, 'up', 5")
def ejson_insert_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert, and an update that inserts for want of a match."""
    engine = _part(spark, sf_dir)
    engine.ejson({"action": "insertOne", "collection": "part", "document": {"_id": 0, "p_brand": "new"}})
    engine.ejson({"action": "updateOne", "collection": "part", "filter": {"_id": -1}, "update": {"$set": {"p_brand": "up"}, "$inc": {"p_size": 5}}, "upsert": True})
    return engine.documents.read("part").select("_id", "p_brand", F.col("p_size").cast("int").alias("p_size"))


@query(
    """SELECT 'found' AS step, 1 AS n UNION ALL SELECT 'events', (SELECT count(*) FROM events WHERE event_id % 4 = 0 AND event_type = 'view') UNION ALL SELECT 'dated', 1
  UNION ALL SELECT 'matched', 1 UNION ALL SELECT 'modified', 1 UNION ALL SELECT 'deleted', 1 UNION ALL SELECT 'refused', 1"""
)
def ejson_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as Extended JSON, on users and events that an upload made."""
    engine = _engine(spark)
    m = F.col("event_id") % 4
    engine.run(_lines(spark, sf_dir, F.when(m == 0, "track").otherwise("user_set")).select("line", "seq"))
    ask = lambda text: decode(engine.ejson_bytes(text.encode()))
    refused = 0
    try:
        ask('{"action":"find","collection":"user","filter":{"#user_id":{"$nonsense":"1"}}}')
    except documents.DocumentError:
        refused = 1
    first = ask('{"action":"findOne","collection":"user","filter":{"#user_id":{"$numberLong":"1"}}}')
    found = ask('{"action":"aggregate","collection":"event","pipeline":[{"$match":{"#event_name":"view"}},{"$group":{"_id":"$#event_name","n":{"$sum":1}}}]}')
    ask('{"action":"insertOne","collection":"event","document":{"#event_name":"login","when":{"$date":"2026-01-01T00:00:00Z"}}}')
    dated = ask('{"action":"find","collection":"event","filter":{"#event_name":"login"}}')["documents"]
    update = ask('{"action":"updateOne","collection":"user","filter":{"#user_id":{"$numberLong":"1"}},"update":{"$set":{"vip":true}},"upsert":true}')
    gone = ask('{"action":"deleteOne","collection":"event","filter":{"#event_name":"login"}}')
    rows = [
        ("found", int(first["document"]["#user_id"] == 1)), ("events", found["documents"][0]["n"] if found["documents"] else 0), ("dated", len(dated)),
        ("matched", update["matchedCount"]), ("modified", update["modifiedCount"]), ("deleted", gone["deletedCount"]), ("refused", refused),
    ]
    return spark.createDataFrame(rows, "step string, n long")


def _select(name: str, text: str, *tables: str) -> None:
    """A query by the SQL interface over tables of its store."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _engine(spark, **{t: table(spark, sf_dir, t) for t in tables}).sql(text).rows

    run.__name__ = name
    QUERIES[name], SQL[name] = run, text


_select("sql_select_where_order_limit", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey = 3 ORDER BY c_acctbal DESC, c_custkey LIMIT 20", "customer")
_select("sql_group_count", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type", "events")
_select("sql_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders", "orders")


@query("SELECT p_brand, p_size FROM part WHERE p_size > 45")
def sql_star_hides_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``*`` in a nested query too leaves out ``_id``; names may be back-quoted."""
    return _part(spark, sf_dir).sql("WITH big AS (SELECT t.* FROM `part` t WHERE `p_size` > 45) SELECT big.* FROM big;").rows


@query("SELECT p_partkey AS _id, p_brand FROM part WHERE p_size > 45")
def sql_names_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part(spark, sf_dir).sql("SELECT _id, p_brand FROM part WHERE p_size > 45").rows


@query("SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'go where, now = then' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def sql_update_const(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = _engine(spark, customer=table(spark, sf_dir, "customer"))
    engine.sql("UPDATE customer SET c_mktsegment = 'go where, now = then' WHERE c_nationkey = 3")
    return engine.sql("SELECT c_custkey, c_mktsegment FROM customer").rows


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN p_size + 1 ELSE p_size END AS p_size FROM part")
def sql_update_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = _engine(spark, part=table(spark, sf_dir, "part"))
    engine.sql("update part set p_size = p_size + 1 where (p_size < 10)")
    return engine.sql("select p_partkey, cast(p_size as int) as p_size from part").rows


@query("SELECT s_suppkey, s_name FROM supplier WHERE NOT coalesce(s_acctbal < 0, FALSE)")
def sql_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = _engine(spark, supplier=table(spark, sf_dir, "supplier"))
    engine.sql("DELETE FROM supplier WHERE s_acctbal < 0")
    return engine.sql("SELECT s_suppkey, s_name FROM supplier").rows


@query("SELECT n_name AS name, n_nationkey AS id FROM nation UNION ALL SELECT r_name, r_regionkey FROM region UNION ALL VALUES ('a, (b)', 100), ('c''d', 101)")
def sql_insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT of a query's rows, and of values with marks inside quotes."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))
    engine = _engine(spark, places=nation, region=table(spark, sf_dir, "region"))
    engine.sql("INSERT INTO places SELECT r_name, r_regionkey FROM region")
    engine.sql("INSERT INTO places (id, `name`) VALUES (100, 'a, (b)'), (101, 'c\\'d');")
    return engine.sql("SELECT name, id FROM places").rows


@query(
    """SELECT 'select' AS kind, 0 AS matched, 0 AS modified, 0 AS deleted, '' AS error UNION ALL SELECT 'update', 0, 0, 0, '' UNION ALL SELECT 'delete', 0, 0, 0, ''
  UNION ALL SELECT 'update', (SELECT count(*) FROM region WHERE r_regionkey > 1), (SELECT count(*) FROM region WHERE r_regionkey = 2), 0, ''
  UNION ALL SELECT 'error', 0, 0, 0, 'parse SQL: syntax error' UNION ALL SELECT 'error', 0, 0, 0, 'unsupported statement type: create' UNION ALL SELECT 'error', 0, 0, 0, 'no such table: nothing'"""
)
def sql_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of results, zero counts and errors."""
    engine = _engine(spark, region=table(spark, sf_dir, "region"))
    rows = []
    for text in (
        "SELECT * FROM region WHERE r_regionkey < 0", "UPDATE region SET r_name = 'x' WHERE r_regionkey < 0", "DELETE FROM region WHERE r_regionkey < 0",
        "UPDATE region SET r_regionkey = greatest(r_regionkey, 3) WHERE r_regionkey > 1", "SELEC nothing", "CREATE TABLE t (x INT)", "DELETE FROM nothing",
    ):
        try:
            got = engine.sql(text)
            rows.append((got.kind, got.matched, got.modified, got.deleted, ""))
        except SqlError as e:
            known = next((k for k in ("parse SQL: syntax error",) if str(e).startswith(k)), str(e))
            rows.append(("error", 0, 0, 0, known))
    return spark.createDataFrame(rows, "kind string, matched long, modified long, deleted int, error string")


@query("SELECT event_type AS event_name, count(*) AS n FROM events WHERE event_id % 8 > 1 GROUP BY event_type")
def ingest_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload lines into a store (parse, identities, folds, commit) and count its events by name: the flagship."""
    m = F.col("event_id") % 8
    engine = _engine(spark)
    engine.run(_lines(spark, sf_dir, F.when(m == 0, "nonsense").when(m == 1, "user_add").otherwise("track")).select("line", "seq"))
    return engine.sql("SELECT `#event_name` AS event_name, COUNT(*) AS n FROM event GROUP BY `#event_name`").rows


@query(
    """WITH o AS (SELECT user_id AS u, event_id AS seq, event_id % 3 AS k FROM events),
  n AS (SELECT u, dense_rank() OVER (ORDER BY min(seq)) AS user_id FROM o GROUP BY u)
  SELECT n.user_id, 'u' || o.u AS account, 'e' || max(o.seq) AS last_uuid, CASE max(o.seq) % 3 WHEN 1 THEN 'user_add' WHEN 2 THEN 'user_other' ELSE 'user_set' END AS last_type,
    CAST(sum(CASE WHEN k = 1 AND o.seq > coalesce(r.pos, -1) THEN o.seq % 10 ELSE 0 END) + max(CASE WHEN o.seq = r.pos THEN o.seq % 10 ELSE 0 END) AS BIGINT) AS n
  FROM o JOIN n USING (u) LEFT JOIN (SELECT u, max(seq) FILTER (k <> 1) AS pos FROM o GROUP BY u) r USING (u) GROUP BY n.user_id, o.u"""
)
def ingest_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users after two uploads, with the meta keys of their last operation; unknown user operations set."""
    m = F.col("event_id") % 3
    lines = _lines(spark, sf_dir, F.when(m == 0, "user_set").when(m == 1, "user_add").otherwise("user_other")).select("line", "seq")
    engine = _engine(spark)
    middle = lines.agg(F.percentile_approx("seq", 0.5)).first()[0]
    engine.run(lines.where(F.col("seq") <= middle))
    engine.run(lines.where(F.col("seq") > middle))
    return engine.sql(
        "SELECT `#user_id` AS user_id, `#account_id` AS account, `#uuid` AS last_uuid, `#type` AS last_type, CAST(n AS BIGINT) AS n FROM user"
    ).rows


@query(_IDENTITY + """SELECT user_id, count(*) AS n, min('e' || seq) AS first_uuid FROM res WHERE a <> '' OR d <> '' GROUP BY user_id""")
def ingest_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user after three uploads, each of which resolves against the ones before."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"))
    ids = _records(spark, sf_dir).join(e, "seq")
    text = lambda c: F.when(F.col(c) != "", F.col(c))
    line = F.to_json(
        F.struct(
            F.concat(F.lit("e"), "seq").alias("#uuid"), F.lit("track").alias("#type"), F.lit("t").alias("#time"), F.lit("x").alias("#event_name"),
            text("account_id").alias("#account_id"), text("distinct_id").alias("#distinct_id"),
        )
    )
    lines = ids.select(line.alias("line"), "seq")
    engine = _engine(spark)
    low, high = lines.agg(F.percentile_approx("seq", [0.3, 0.7])).first()[0]
    for part in (F.col("seq") <= low, (F.col("seq") > low) & (F.col("seq") <= high), F.col("seq") > high):
        engine.run(lines.where(part))
    return engine.sql("SELECT `#user_id` AS user_id, COUNT(*) AS n, MIN(`#uuid`) AS first_uuid FROM event GROUP BY `#user_id`").rows
