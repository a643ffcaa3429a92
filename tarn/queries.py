"""Named queries over lakehouse tables, each with the SQL that gives the same rows from the Parquet tables."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures
from .functions import compat, sign_url
from .operators import evaluate, schema, vacuum
from .plans import predicate as p
from .session import LakehouseSession
from .sources import catalog, snapshot
from .sources.storage import Storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a query under its function's name."""

    def take(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = inspect.cleandoc(oracle)
        return f

    return take


def _read(spark, sf_dir, name, **options) -> DataFrame:
    return LakehouseSession(spark).read(fixtures.path_of(spark, sf_dir, name), **options)


ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

PRICING = """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
  round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus
"""


@query(PRICING)
def delta_pricing_summary(spark, sf_dir):
    """The flagship: an aggregation over a log-backed table registered as a view."""
    LakehouseSession(spark).register("tarn_lineitem", fixtures.path_of(spark, sf_dir, "plain"))
    return LakehouseSession(spark).sql(PRICING.replace("FROM lineitem", "FROM tarn_lineitem").replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))


@query(f"SELECT {ORDERS} FROM orders")
def delta_scan_full(spark, sf_dir):
    return _read(spark, sf_dir, "sorted_orders")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_totalprice > 150000 AND NOT (o_orderstatus = 'F') OR o_orderkey < 40")
def delta_scan_projection_filter(spark, sf_dir):
    where = (p.gt(p.col("o_totalprice"), p.lit(150000)) & ~p.eq(p.col("o_orderstatus"), p.lit("F"))) | p.lt(p.col("o_orderkey"), p.lit(40))
    return _read(spark, sf_dir, "sorted_orders", where=where, columns=["o_orderkey", "o_totalprice", "o_orderpriority"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def delta_scan_limit_topk(spark, sf_dir):
    return _read(spark, sf_dir, "sorted_orders", columns=["o_orderkey", "o_totalprice"]).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT count(*) AS n FROM orders")
def delta_count_only(spark, sf_dir):
    return _read(spark, sf_dir, "sorted_orders").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderkey % 4 = 0")
def delta_time_travel_v0(spark, sf_dir):
    return _read(spark, sf_dir, "multi_commit", version=0)


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderkey % 4 < 3")
def delta_time_travel_v2(spark, sf_dir):
    return _read(spark, sf_dir, "multi_commit", version=2)


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderkey % 4 <> 1")
def delta_remove_reconcile(spark, sf_dir):
    return _read(spark, sf_dir, "multi_commit")


@query("SELECT 4 AS version, 3 AS min_reader_version, 'timestampNtz' AS reader_features, CAST(0 AS BIGINT) AS n_partition_columns, CAST(6 AS BIGINT) AS n_columns")
def delta_snapshot_accessors(spark, sf_dir):
    s = LakehouseSession(spark).snapshot(fixtures.path_of(spark, sf_dir, "multi_commit"))
    row = s.describe().select(F.col("version").cast("int"), "min_reader_version", F.array_join("reader_features", ",").alias("reader_features"), F.size("partition_columns").cast("long").alias("n_partition_columns"))
    return row.withColumn("n_columns", F.lit(len(s.schema.fields)).cast("long"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def delta_partitioned_prune(spark, sf_dir):
    return _read(spark, sf_dir, "partitioned").where("o_orderstatus = 'F' and o_totalprice > 1000").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderkey BETWEEN 10 AND 500")
def delta_partitioned_where(spark, sf_dir):
    return _read(spark, sf_dir, "partitioned", where="o_orderstatus in ('F', 'P') and o_orderkey between 10 and 500", columns=["o_orderkey", "o_orderstatus"])


@query(
    """SELECT event_id, value, CASE event_id % 5 WHEN 0 THEN 'a b' WHEN 1 THEN 'x/y' WHEN 2 THEN '50%' WHEN 3 THEN '[z]*' END AS kind,
       CAST(event_id % 5 AS INTEGER) AS num, event_id % 5 > 2 AS flag FROM events"""
)
def delta_partition_null_and_special(spark, sf_dir):
    return _read(spark, sf_dir, "partitioned_odd")


@query("SELECT c_custkey, c_name, CAST(c_custkey % 70 AS INTEGER) AS bucket FROM customer WHERE c_custkey % 70 > 40")
def delta_many_partitions(spark, sf_dir):
    return _read(spark, sf_dir, "many_partitions").where("bucket > 40").select("c_custkey", "c_name", "bucket")


@query(
    """SELECT c_custkey, c_name, c_nationkey AS nation, CASE WHEN c_custkey % 2 = 1 THEN upper(c_mktsegment) END AS segment, c_acctbal,
       CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer"""
)
def delta_schema_evolution(spark, sf_dir):
    return _read(spark, sf_dir, "evolved").select("c_custkey", "c_name", "extra.nation", "extra.segment", "c_acctbal", "c_mktsegment")


@query("SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS price FROM part")
def delta_type_widening(spark, sf_dir):
    return _read(spark, sf_dir, "widened")


@query(
    """SELECT vec_id, label, CASE WHEN vec_id % 2 = 1 THEN CAST(len(embedding) AS INTEGER) END AS dims, label + 1 AS x2,
       CASE WHEN vec_id % 2 = 1 THEN 'two' END AS y2, vec_id AS v, CASE WHEN vec_id % 2 = 1 THEN 1 END AS w FROM embeddings"""
)
def delta_nested_struct_array_map(spark, sf_dir):
    return _read(spark, sf_dir, "nested").select("vec_id", "s.label", "s.dims", F.col("a")[1]["x"].alias("x2"), F.col("a")[1]["y"].alias("y2"), F.col("m")["k"]["v"].alias("v"), F.col("m")["k"]["w"].alias("w"))


_NATION = 'SELECT n_nationkey AS "key of nation", n_name AS label, n_regionkey AS region, CAST(n_regionkey % 2 AS INTEGER) AS odd FROM nation'


@query(_NATION)
def delta_column_mapping_name(spark, sf_dir):
    return _read(spark, sf_dir, "mapped_name").select("key of nation", "about.label", "about.region", "odd")


@query(_NATION)
def delta_column_mapping_id(spark, sf_dir):
    return _read(spark, sf_dir, "mapped_id").select("key of nation", "about.label", "about.region", "odd")


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderkey % 12 <> 3")
def delta_checkpoint(spark, sf_dir):
    return _read(spark, sf_dir, "checkpointed")


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderkey % 12 <> 3 AND o_orderkey % 12 <> 11")
def delta_checkpoint_multipart(spark, sf_dir):
    return _read(spark, sf_dir, "checkpoint_parts", version=10)


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderkey % 12 <> 3")
def delta_checkpoint_v2(spark, sf_dir):
    return _read(spark, sf_dir, "checkpoint_v2")


_VECTORS = f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE {fixtures.VECTORS_LEFT}"


@query(_VECTORS)
def delta_deletion_vector_inline(spark, sf_dir):
    return _read(spark, sf_dir, "dv_inline", columns=["l_orderkey", "l_linenumber", "l_quantity"])


@query(_VECTORS)
def delta_deletion_vector_file(spark, sf_dir):
    return _read(spark, sf_dir, "dv_file", columns=["l_orderkey", "l_linenumber", "l_quantity"])


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderkey >= (SELECT (max(o_orderkey) + 1) * 7 // 8 FROM orders)")
def delta_stats_skipping(spark, sf_dir):
    lake, path = LakehouseSession(spark), fixtures.path_of(spark, sf_dir, "sorted_orders")
    low = (lake.read(path, columns=["o_orderkey"]).agg(F.max("o_orderkey")).first()[0] + 1) * 7 // 8
    return lake.read(path, where=p.ge(p.col("o_orderkey"), p.lit(low)))


@query("SELECT CAST(1 AS BIGINT) AS files")
def delta_files_after_skipping(spark, sf_dir):
    from .plans.scan import live_files

    s = LakehouseSession(spark).snapshot(fixtures.path_of(spark, sf_dir, "sorted_orders"))
    low = s.files.agg(F.max(F.get_json_object("stats", "$.maxValues.o_orderkey").cast("long"))).first()[0]
    return live_files(s, p.ge(p.col("o_orderkey"), p.lit(low))).agg(F.count(F.lit(1)).alias("files"))


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderkey < 100")
def delta_no_stats_keeps_files(spark, sf_dir):
    return _read(spark, sf_dir, "no_stats", where="o_orderkey < 100")


@query("SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name, CAST(n_regionkey AS INTEGER) AS n_regionkey FROM nation WHERE false")
def delta_empty_table(spark, sf_dir):
    return _read(spark, sf_dir, "empty")


@query(
    """SELECT event_id AS l, event_id % 2 = 0 AS bo, event_type AS s, CAST(event_id % 128 AS INTEGER) AS by,
       CAST(event_id % 32768 AS INTEGER) AS sh, CAST(event_id AS INTEGER) AS i, value AS d, ts AS tn, CAST(ts AS DATE) AS da FROM events"""
)
def delta_all_types(spark, sf_dir):
    return _read(spark, sf_dir, "all_types").select("l", "bo", "s", F.col("by").cast("int"), F.col("sh").cast("int"), "i", "d", "tn", "da")


@query("SELECT * FROM (VALUES ('add', 4), ('commitInfo', 5), ('metaData', 1), ('protocol', 1), ('remove', 1)) AS t(action, n)")
def delta_log_actions(spark, sf_dir):
    acts = LakehouseSession(spark).log_actions(fixtures.path_of(spark, sf_dir, "multi_commit"))
    kinds = ["add", "remove", "metaData", "protocol", "commitInfo"]
    one = acts.agg(*(F.count(k).cast("int").alias(k) for k in kinds))
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("action"), F.col(k).alias("n")) for k in kinds))).alias("x")).select("x.*")


@query("SELECT CAST(3 AS BIGINT) AS files, count(*) AS records FROM orders WHERE o_orderkey % 4 <> 1")
def delta_live_files(spark, sf_dir):
    files = LakehouseSession(spark).live_files(fixtures.path_of(spark, sf_dir, "multi_commit"))
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum(F.get_json_object("stats", "$.numRecords").cast("long")).alias("records"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2 UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 3")
def delta_schema_provider_refresh(spark, sf_dir):
    """A registered table is seen at the version committed after it was registered."""
    b = fixtures.Builder(spark, fixtures.path_of(spark, sf_dir, "empty", fresh=True))
    provider = catalog.SchemaProvider(spark)
    provider.register_delta("nations", b.root)
    df = fixtures._source(spark, sf_dir, "nation")
    b.version = 1
    b.commit(b.add(df.where("n_regionkey = 2")))
    b.commit(b.add(df.where("n_regionkey = 3")))
    return provider.table("nations").select("n_nationkey", "n_name")


@query("SELECT n_nationkey + 1 AS output FROM nation")
def expr_evaluator_scalar(spark, sf_dir):
    df = _source(spark, sf_dir, "nation")
    return evaluate.ExpressionEvaluator(df.schema, p.Arith("+", p.col("n_nationkey"), p.lit(1)), T.IntegerType()).evaluate(df)


@query("SELECT n_nationkey AS x, n_name AS y, (n_nationkey * 3 - 1) // 2 AS z FROM nation")
def expr_evaluator_struct(spark, sf_dir):
    df = _source(spark, sf_dir, "nation")
    out = T.StructType().add("x", T.IntegerType()).add("y", T.StringType()).add("z", T.IntegerType())
    half = p.Arith("/", p.Arith("-", p.Arith("*", p.col("n_nationkey"), p.lit(3)), p.lit(1)), p.lit(2))
    # truncated division: the one negative case is n_nationkey = 0, where -1 / 2 is 0 and SQL's floor is the same here
    return evaluate.ExpressionEvaluator(df.schema, p.Struct((p.col("n_nationkey"), p.col("n_name"), half)), out).evaluate(df)


@query("SELECT (n_regionkey > 1 AND n_nationkey < 20) OR n_name IS NULL AS output FROM nation")
def predicate_evaluator(spark, sf_dir):
    df = _source(spark, sf_dir, "nation")
    e = (p.gt(p.col("n_regionkey"), p.lit(1)) & p.lt(p.col("n_nationkey"), p.lit(20))) | p.IsNull(p.col("n_name"))
    return evaluate.PredicateEvaluator(df.schema, e).evaluate(df)


@query("SELECT CAST(NULL AS INTEGER) AS a, CAST(NULL AS VARCHAR) AS b")
def null_row(spark, sf_dir):
    return evaluate.null_row(spark, T.StructType().add("a", T.IntegerType(), False).add("b", T.StringType(), False))


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, TRY_CAST(c_name AS INTEGER) AS c_name, CAST(NULL AS DOUBLE) AS missing, c_nationkey FROM customer")
def schema_apply(spark, sf_dir):
    want = T.StructType().add("c_custkey", T.StringType()).add("c_name", T.IntegerType()).add("missing", T.DoubleType()).add("c_nationkey", T.IntegerType())
    return schema.apply_schema(_source(spark, sf_dir, "customer"), want)


@query("SELECT * FROM (VALUES ('d0/stray.parquet'), ('stray.parquet'), ('tombstone')) AS t(path)")
def vacuum_dry_run(spark, sf_dir):
    """Old untracked files and one whose tombstone has expired; live, recent and hidden files are not among them."""
    root = fixtures.path_of(spark, sf_dir, "vacuumable")
    found = LakehouseSession(spark).sql(f"VACUUM '{root}' RETAIN 168 HOURS DRY RUN")
    return found.select(F.when(F.col("path").contains("/d1/part-"), "tombstone").otherwise(F.expr(f"substring(path, {len(root) + 2})")).alias("path"))


@query("SELECT 'numDeletedBytes' AS metric_name, true AS positive UNION ALL SELECT 'numDeletedFiles', true UNION ALL SELECT 'retentionHours', true")
def vacuum_run(spark, sf_dir):
    root = fixtures.path_of(spark, sf_dir, "vacuumable", fresh=True)
    return LakehouseSession(spark).sql(f"VACUUM delta.'{root}'").select("metric_name", (F.col("metric_value").cast("double") > 0).alias("positive"))


@query("SELECT 'd1' AS folder")
def vacuum_lite(spark, sf_dir):
    s = snapshot.load(spark, fixtures.path_of(spark, sf_dir, "vacuumable"))
    return vacuum.candidates(vacuum.plan(s, "LITE")).select(F.regexp_extract("path", r"/(d\d)/part", 1).alias("folder"))


@query("SELECT * FROM (VALUES ('_delta_log', true), ('_hidden', true), ('d0', true), ('d1', true), ('d2', true), ('new.parquet', false), ('stray.parquet', false)) AS t(name, is_dir)")
def directory_listing(spark, sf_dir):
    root = fixtures.path_of(spark, sf_dir, "vacuumable")
    return Storage(spark).listing(root).select(F.element_at(F.split("path", "/"), -1).alias("name"), "is_dir")


@query("SELECT * FROM (VALUES ('lab', 'CATALOG', 'first'), ('lab', 'CATALOG', 'DROPPED')) AS t(securable_name, securable_type, detail)")
def catalog_create_drop(spark, sf_dir):
    lake = LakehouseSession(spark, catalog_client=catalog.MemoryCatalogs())
    made = lake.sql("CREATE CATALOG IF NOT EXISTS lab MANAGED LOCATION 's3://bucket/lab' COMMENT 'first' OPTIONS (a.b 1, 'c' two,)")
    gone = lake.sql("DROP CATALOG IF EXISTS lab CASCADE")
    made = made.select("securable_name", "securable_type", F.get_json_object("securable_object", "$.comment").alias("detail"))
    return made.unionByName(gone.withColumnRenamed("status", "detail"))


@query("SELECT page_id, 'memory://pages/' || page_id AS signed, CAST(NULL AS VARCHAR) AS wrong FROM pages")
def sign_storage_url_local(spark, sf_dir):
    sign_url.register(spark)
    return _source(spark, sf_dir, "pages").selectExpr("page_id", "sign_storage_url('memory://pages/' || page_id) AS signed", "sign_storage_url('no url') AS wrong")


def _source(spark, sf_dir, name):
    return fixtures._source(spark, sf_dir, name)


# --- the host's relational surface, over log-backed tables and Parquet views ---------------------------------------------


def _views(spark: SparkSession, sf_dir: str) -> None:
    lake = LakehouseSession(spark)
    lake.register("lineitem", fixtures.path_of(spark, sf_dir, "plain"))
    lake.register("orders", fixtures.path_of(spark, sf_dir, "partitioned"))
    for name in ("region", "nation", "customer", "supplier", "part", "events"):
        _source(spark, sf_dir, name).createOrReplaceTempView(name)


def sql_query(name: str, text: str, oracle: str | None = None) -> None:
    """A query whose text serves both engines, unless the oracle's differs."""

    def run(spark, sf_dir):
        _views(spark, sf_dir)
        return LakehouseSession(spark).sql(inspect.cleandoc(text))

    QUERIES[name] = run
    ORACLES[name] = inspect.cleandoc(oracle or text)


sql_query("sql_join_inner_multi", """
    SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
      JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_name""")  # fmt: skip
sql_query("sql_join_left_right_full", """
    SELECT c.c_custkey AS k, o.o_orderkey AS o, 'left' AS how FROM customer c LEFT JOIN orders o ON c_custkey = o_custkey AND o_totalprice > 200000
    UNION ALL SELECT c.c_custkey, o.o_orderkey, 'right' FROM customer c RIGHT JOIN orders o ON c_custkey = o_custkey AND c_acctbal > 5000
    UNION ALL SELECT c.c_custkey, s.s_suppkey, 'full' FROM customer c FULL JOIN supplier s ON c_custkey = s_suppkey + 90""")  # fmt: skip
sql_query("sql_join_using_natural", """
    SELECT a.n_name, b.x FROM nation a JOIN (SELECT n_nationkey, n_regionkey AS x FROM nation) b USING (n_nationkey)
    UNION ALL SELECT n_name, y FROM nation NATURAL JOIN (SELECT n_nationkey, n_nationkey * 2 AS y FROM nation) c""")  # fmt: skip
sql_query("sql_join_theta_range", """
    SELECT p_partkey, r_name FROM part JOIN region ON p_size > r_regionkey * 10 AND p_size <= r_regionkey * 10 + 10""")  # fmt: skip
sql_query("sql_join_cross_small", "SELECT r_name, n_name FROM region CROSS JOIN nation")
sql_query("sql_join_asof", """
    WITH p AS (SELECT user_id, ts, value FROM events WHERE event_type = 'click'), q AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    u AS (SELECT user_id, ts, event_id, CAST(NULL AS DOUBLE) AS value, 1 AS side FROM q UNION ALL SELECT user_id, ts, CAST(NULL AS BIGINT), value, 0 FROM p),
    w AS (SELECT event_id, side, count(CASE WHEN side = 0 THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM u)
    SELECT event_id, n > 0 AS found, n FROM w WHERE side = 1""", """
    SELECT q.event_id, count(p.ts) > 0 AS found, count(p.ts) AS n FROM (SELECT * FROM events WHERE event_type = 'purchase') q
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') p ON p.user_id = q.user_id AND p.ts <= q.ts GROUP BY q.event_id""")  # fmt: skip
sql_query("sql_semi_anti", """
    SELECT c_custkey, 'semi' AS how FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
    UNION ALL SELECT c_custkey, 'anti' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
    UNION ALL SELECT c_custkey, 'in' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
    UNION ALL SELECT c_custkey, 'not in' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)""")  # fmt: skip
sql_query("sql_rollup_cube", """
    SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INTEGER) AS g, count(*) AS n, 'rollup' AS how FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
    UNION ALL SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INTEGER), count(*), 'cube' FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
    UNION ALL SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INTEGER), count(*), 'sets' FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""")  # fmt: skip
sql_query("sql_aggregates", """
    SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(*) FILTER (WHERE l_discount > 0.05) AS discounted, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
      round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp, round(corr(l_quantity, l_extendedprice), 6) AS co, round(covar_pop(l_quantity, l_discount), 6) AS cp,
      bool_and(l_quantity > 0) AS every_one, bool_or(l_quantity > 49) AS some_one, bit_xor(l_linenumber) AS x, median(l_quantity) AS med
    FROM lineitem GROUP BY l_returnflag HAVING count(*) > 1""")  # fmt: skip
sql_query("sql_aggregate_lists", """
    SELECT n_regionkey, array_join(sort_array(collect_list(n_name)), ',') AS names, listagg(n_name, ';') WITHIN GROUP (ORDER BY n_name) AS joined FROM nation GROUP BY n_regionkey""", """
    SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names, string_agg(n_name, ';' ORDER BY n_name) AS joined FROM nation GROUP BY n_regionkey""")  # fmt: skip
sql_query("sql_approximate", """
    SELECT abs(approx_count_distinct(l_partkey) - count(DISTINCT l_partkey)) < 0.1 * count(DISTINCT l_partkey) AS near,
      abs(percentile_approx(l_quantity, 0.5) - 25.0) < 3 AS middle FROM lineitem""", """
    SELECT true AS near, true AS middle""")  # fmt: skip
sql_query("sql_window_rank", """
    SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS dr, ntile(4) OVER w AS nt, round(percent_rank() OVER w, 6) AS pr, round(cume_dist() OVER w, 6) AS cd
      FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey)) t WHERE rn <= 3""")  # fmt: skip
sql_query("sql_window_frames", """
    SELECT o_orderkey, lag(o_orderkey, 1) OVER w AS before, lead(o_orderkey, 2) OVER w AS after, first_value(o_orderkey) OVER w AS first,
      nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second,
      round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS recent,
      count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey RANGE BETWEEN 100 PRECEDING AND 100 FOLLOWING) AS near
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")  # fmt: skip
sql_query("sql_window_groups_frame", """
    WITH d AS (SELECT user_id, event_id, value, dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) AS g FROM events)
    SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY g RANGE BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM d""", """
    SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_type GROUPS BETWEEN 1 PRECEDING AND CURRENT ROW) AS n FROM events""")  # fmt: skip
sql_query("sql_qualify", """
    SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) t WHERE r = 1""", """
    SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")  # fmt: skip
sql_query("sql_setops", """
    SELECT k, how FROM (
      SELECT c_nationkey AS k, 'union' AS how FROM customer UNION SELECT s_nationkey, 'union' FROM supplier
      UNION ALL (SELECT c_nationkey, 'intersect' FROM customer INTERSECT SELECT s_nationkey, 'intersect' FROM supplier)
      UNION ALL (SELECT c_nationkey, 'except' FROM customer EXCEPT SELECT s_nationkey, 'except' FROM supplier WHERE s_nationkey < 10)
      UNION ALL (SELECT c_nationkey, 'intersect all' FROM customer INTERSECT ALL SELECT s_nationkey, 'intersect all' FROM supplier)
      UNION ALL (SELECT c_nationkey, 'except all' FROM customer EXCEPT ALL SELECT s_nationkey, 'except all' FROM supplier)) t""")  # fmt: skip
sql_query("sql_correlated_cte", """
    WITH big AS (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY o_custkey)
    SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n, (SELECT max(top) FROM big WHERE o_custkey = c_custkey) AS top
    FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer x WHERE x.c_nationkey = customer.c_nationkey)""")  # fmt: skip
sql_query("sql_recursive_cte", """
    WITH RECURSIVE t(n, f) AS (SELECT 1, 1 UNION ALL SELECT n + 1, f * 2 FROM t WHERE n < 10) SELECT n, f FROM t""")  # fmt: skip
sql_query("sql_lateral_unnest", """
    SELECT r_name, x FROM region, LATERAL (SELECT explode(sequence(0, r_regionkey)) AS x)""", """
    SELECT r_name, CAST(x AS INTEGER) AS x FROM region, LATERAL (SELECT unnest(range(0, r_regionkey + 1)) AS x)""")  # fmt: skip
sql_query("sql_sort_nulls_limit_offset", """
    SELECT k, v FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS v FROM orders) t ORDER BY v ASC NULLS LAST, k LIMIT 25 OFFSET 10""")  # fmt: skip
sql_query("sql_case_conditional", """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'middle' ELSE 'large' END AS c, coalesce(nullif(p_size, 7), -1) AS n, greatest(p_size, 20) AS g, least(p_size, 20) AS l, ifnull(nullif(p_brand, 'Brand#11'), '-') AS b FROM part""")  # fmt: skip
sql_query("sql_functions_math", """
    SELECT n_nationkey AS k, abs(n_nationkey - 12) AS a, ceil(n_nationkey / 7.0) AS c, floor(n_nationkey / 7.0) AS f, round(power(n_nationkey, 0.5), 6) AS p, round(ln(n_nationkey + 1), 6) AS l, round(log10(n_nationkey + 1), 6) AS lg,
      round(atan2(n_nationkey, 3), 6) AS at, round(degrees(n_nationkey), 6) AS d, sign(n_nationkey - 5) AS s, n_nationkey % 7 AS m, round(exp(n_nationkey / 10.0), 6) AS e, round(cbrt(n_nationkey), 6) AS cb FROM nation""")  # fmt: skip
sql_query("sql_functions_string", """
    SELECT n_name, upper(n_name) AS u, lower(n_name) AS l, length(n_name) AS n, substr(n_name, 2, 3) AS s, replace(n_name, 'A', '*') AS r, concat(n_name, '-', n_regionkey) AS c, lpad(n_name, 12, '.') AS lp, trim('  x ') AS t, reverse(n_name) AS rv,
      split_part(n_name, 'A', 1) AS sp, repeat(n_name, 2) AS rp, left(n_name, 2) AS lf, right(n_name, 2) AS rg, ascii(n_name) AS a, translate(n_name, 'AE', 'ae') AS tr, levenshtein(n_name, 'CHINA') AS lv, instr(n_name, 'A') AS i, md5(n_name) AS h FROM nation""")  # fmt: skip
sql_query("sql_functions_regex", """
    SELECT n_name, n_name RLIKE '^[A-M]' AS m, regexp_replace(n_name, '[AEIOU]', '_') AS r, regexp_extract(n_name, '([A-Z])A', 1) AS x, regexp_count(n_name, 'A') AS c FROM nation""", """
    SELECT n_name, regexp_matches(n_name, '^[A-M]') AS m, regexp_replace(n_name, '[AEIOU]', '_', 'g') AS r, regexp_extract(n_name, '([A-Z])A', 1) AS x, CAST(len(regexp_extract_all(n_name, 'A')) AS INTEGER) AS c FROM nation""")  # fmt: skip
sql_query("sql_functions_date", """
    SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(date_trunc('month', o_orderdate) AS DATE) AS t, datediff(DATE '1999-01-01', CAST(o_orderdate AS DATE)) AS d, date_format(o_orderdate, 'yyyy-MM') AS f, extract(quarter FROM o_orderdate) AS q FROM orders""", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(date_trunc('month', o_orderdate) AS DATE) AS t, CAST(DATE '1999-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS d, strftime(o_orderdate, '%Y-%m') AS f, CAST(quarter(o_orderdate) AS INTEGER) AS q FROM orders""")  # fmt: skip
sql_query("sql_functions_array_map", """
    SELECT n_nationkey, size(split(n_name, 'A')) AS n, array_join(array_sort(split(n_name, '')), '') AS s, array_contains(array(1, 2, n_regionkey), 3) AS c, element_at(map('a', n_nationkey, 'b', 0), 'a') AS e, named_struct('x', n_regionkey).x AS x, array_join(slice(array(1, 2, 3, 4), 2, 2), '-') AS sl FROM nation""", """
    SELECT n_nationkey, CAST(len(string_split(n_name, 'A')) AS INTEGER) AS n, array_to_string(list_sort(string_split(n_name, '')), '') AS s, list_contains([1, 2, n_regionkey], 3) AS c, n_nationkey AS e, n_regionkey AS x, '2-3' AS sl FROM nation""")  # fmt: skip
sql_query("sql_pushdown_partition_view", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 150000")


@query(
    """SELECT n_nationkey, gcd(n_nationkey, 12) AS g, lcm(n_nationkey, 12) AS l, starts_with(n_name, 'A') AS sw, strpos(n_name, 'A') AS sp, lower(hex(n_nationkey)) AS hx,
       sha256(n_name) AS sh, CASE WHEN n_nationkey - 12.5 < 0 THEN ceil(n_nationkey - 12.5) ELSE floor(n_nationkey - 12.5) END::DOUBLE AS tr FROM nation"""
)
def sql_compat_functions(spark, sf_dir):
    compat.register(spark)
    _views(spark, sf_dir)
    return LakehouseSession(spark).sql("SELECT n_nationkey, gcd(n_nationkey, 12) AS g, lcm(n_nationkey, 12) AS l, starts_with(n_name, 'A') AS sw, strpos(n_name, 'A') AS sp, to_hex(n_nationkey) AS hx, sha256(n_name) AS sh, trunc_number(n_nationkey - 12.5) AS tr FROM nation")


@query("SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS missing FROM nation WHERE n_regionkey = 1")
def engine_read_parquet(spark, sf_dir):
    from .sources import readers

    want = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()), T.StructField("n_regionkey", T.IntegerType()), T.StructField("missing", T.StringType())])
    return readers.read_parquet_files(spark, [f"{sf_dir}/nation.parquet"], want, p.eq(p.col("n_regionkey"), p.lit(1))).drop("n_regionkey")


@query("SELECT CAST(4 AS BIGINT) AS adds, CAST(1 AS BIGINT) AS removes")
def engine_read_json(spark, sf_dir):
    from .sources import log, readers

    seg = LakehouseSession(spark).snapshot(fixtures.path_of(spark, sf_dir, "multi_commit")).segment
    return readers.read_json_files(spark, list(seg.commits), log.ACTIONS).agg(F.count("add").alias("adds"), F.count("remove").alias("removes"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def engine_parse_json(spark, sf_dir):
    from .sources import readers

    parsed = readers.parse_json(F.col("props"), T.StructType([T.StructField("k", T.StringType())]))
    return _source(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query("SELECT n_nationkey FROM nation WHERE n_name IS DISTINCT FROM 'CHINA' AND n_regionkey IN (1, 2) AND NOT (n_nationkey >= 20 OR n_nationkey <> n_nationkey)")
def predicate_superset(spark, sf_dir):
    e = p.conjunction([p.distinct(p.col("n_name"), p.lit("CHINA")), p.In(p.col("n_regionkey"), (p.lit(1), p.lit(2))), ~(p.ge(p.col("n_nationkey"), p.lit(20)) | p.ne(p.col("n_nationkey"), p.col("n_nationkey")))])
    return _source(spark, sf_dir, "nation").where(p.to_column(e)).select("n_nationkey")


@query(
    """SELECT n_nationkey, CAST(len(v) AS INTEGER) AS n, list_contains(v, 3) AS has, array_to_string(v[2:3], ',') AS middle, array_to_string(list_slice(list_concat(v, [9, 9]), 1, 4), ',') AS longer, array_to_string(list_filter(v, lambda x: x <> 1), ',') AS without,
       CAST(1 AS INTEGER) AS dims, len(list_filter(['a', n_name], lambda x: x = n_name)) AS seen FROM (SELECT *, [1, n_regionkey, 3] AS v FROM nation)"""
)
def sql_compat_any_type(spark, sf_dir):
    """Functions by the host's names on arrays of numbers."""
    _views(spark, sf_dir)
    text = """SELECT n_nationkey, array_length(v) AS n, array_has(v, 3) AS has, array_to_string(array_slice(v, 2, 3), ',') AS middle, array_to_string(array_resize(v, 4, 9), ',') AS longer, array_to_string(array_remove_all(v, 1), ',') AS without, array_ndims(v) AS dims,
      CAST(array_length(array_positions(make_array('a', n_name), n_name)) AS BIGINT) AS seen FROM (SELECT *, make_array(1, n_regionkey, 3) AS v FROM nation)"""
    return LakehouseSession(spark, compatibility=True).sql(text)


@query("SELECT l_linenumber, round(var_samp(l_quantity), 6) AS a, round(var_pop(l_quantity), 6) AS b, round(quantile_cont(l_quantity, 0.25), 6) AS c, round(var_samp(l_tax), 8) AS d FROM lineitem GROUP BY l_linenumber")
def sql_compat_aggregates(spark, sf_dir):
    _views(spark, sf_dir)
    text = "SELECT l_linenumber, round(var_sample(l_quantity), 6) AS a, round(var_population(l_quantity), 6) AS b, round(quantile_cont(l_quantity, 0.25), 6) AS c, round(var(l_tax), 8) AS d FROM lineitem GROUP BY l_linenumber"
    return LakehouseSession(spark, compatibility=True).sql(text)


@query("SELECT * FROM (VALUES ('orders', 1, 8), ('customer', 1, 70)) AS t(which, files, of)")
def sql_filters_choose_files(spark, sf_dir):
    """How many files statements over views read, of how many."""
    lake = LakehouseSession(spark)
    lake.register("tarn_sorted", fixtures.path_of(spark, sf_dir, "sorted_orders"))
    lake.register("tarn_buckets", fixtures.path_of(spark, sf_dir, "many_partitions"))
    low = lake.sql("SELECT o_totalprice FROM tarn_sorted WHERE o_orderkey < 3")
    one = lake.sql("SELECT c_name FROM tarn_buckets WHERE bucket = 41")
    rows = [(name, len(set(df.inputFiles())), len(set(spark.table(view).inputFiles()))) for name, df, view in (("orders", low, "tarn_sorted"), ("customer", one, "tarn_buckets"))]
    return spark.createDataFrame(rows, "which string, files int, of int")


@query(f"SELECT {ORDERS} FROM orders WHERE o_totalprice BETWEEN 50000 AND 90000 AND o_orderstatus IN ('F', 'O')")
def sql_filters_over_followed_table(spark, sf_dir):
    """A statement over a table that follows its log."""
    lake = LakehouseSession(spark)
    lake.register_delta("tarn_followed", fixtures.path_of(spark, sf_dir, "partitioned"))
    out = lake.sql(f"SELECT {ORDERS} FROM tarn_followed WHERE o_totalprice BETWEEN 50000 AND 90000 AND o_orderstatus IN ('F', 'O')")
    lake.schema.deregister_table("tarn_followed")
    return out


@query("SELECT * FROM (VALUES ('00000000000000000003.json'), ('00000000000000000004.json')) AS t(name)")
def storage_list_from(spark, sf_dir):
    """Files of the log after a name, in order."""
    found = Storage(spark).list_from(f"{fixtures.path_of(spark, sf_dir, 'multi_commit')}/_delta_log", "00000000000000000002.json")
    return spark.createDataFrame([(x.name,) for x in found if x.name.endswith(".json")], "name string")


@query("SELECT * FROM (VALUES ('first', 'PAR1'), ('last', 'PAR1'), ('whole is as long as listed', 'true')) AS t(place, bytes)")
def storage_byte_ranges(spark, sf_dir):
    storage = Storage(spark)
    at = next(x for x in storage.list(fixtures.path_of(spark, sf_dir, "multi_commit")) if x.name.endswith(".parquet"))
    first, last, whole = storage.read_files([(at.path, (0, 4)), (at.path, (at.length - 4, at.length)), (at.path, None)])
    rows = [("first", first.decode()), ("last", last.decode()), ("whole is as long as listed", str(len(whole) == at.length).lower())]
    return spark.createDataFrame(rows, "place string, bytes string")


@query("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def external_table(spark, sf_dir):
    lake = LakehouseSession(spark)
    lake.sql(f"CREATE EXTERNAL TABLE IF NOT EXISTS tarn_external STORED AS PARQUET LOCATION '{sf_dir}/orders.parquet'")
    return lake.sql("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM tarn_external GROUP BY o_orderstatus")


@query("SELECT n_name, n_regionkey FROM nation")
def copy_to_files(spark, sf_dir):
    """Rows that a statement wrote as CSV, read by another."""
    from .sources.storage import workspace

    lake, at = LakehouseSession(spark), f"{workspace(spark)}/copied"
    _source(spark, sf_dir, "nation").createOrReplaceTempView("nation")
    lake.sql(f"COPY (SELECT n_name, n_regionkey FROM nation) TO '{at}.csv' OPTIONS (header true)")
    lake.sql(f"CREATE EXTERNAL TABLE IF NOT EXISTS tarn_copied STORED AS CSV WITH HEADER ROW LOCATION '{at}.csv'")
    return lake.sql("SELECT n_name, n_regionkey FROM tarn_copied")


@query("SELECT * FROM (VALUES (0, 'written'), (1, 'written'), (1, 'there already')) AS t(version, outcome)")
def commit_put_if_absent(spark, sf_dir):
    """A version is written once, whoever comes second."""
    from .sources.commit import write_commit
    from .sources.storage import FileAlreadyExists

    root, out = fixtures.path_of(spark, sf_dir, "empty", fresh=True), [(0, "written")]
    for _ in range(2):
        try:
            write_commit(spark, root, 1, [{"commitInfo": {"operation": "WRITE"}}])
            out.append((1, "written"))
        except FileAlreadyExists:
            out.append((1, "there already"))
    return spark.createDataFrame(out, "version int, outcome string")


@query("SELECT * FROM (VALUES ('1.5 hours', 90), ('0.999 hours', 59), ('interval 1 week', 10080), ('interval 2 days 3 hours', 3060)) AS t(given, minutes)")
def retention_helpers(spark, sf_dir):
    found = [(f"{n} hours", vacuum.hours(n)) for n in (1.5, 0.999)] + [(t, vacuum.interval(t)) for t in ("interval 1 week", "interval 2 days 3 hours")]
    return spark.createDataFrame([(t, int(d.total_seconds() // 60)) for t, d in found], "given string, minutes int")


@query("SELECT * FROM (VALUES ('none', 'none', 168), ('week', 'none', 168), ('week', '200', 200), ('week', '1', -1), ('week', '1 unchecked', 1), ('none', '1', 1)) AS t(property, asked, hours)")
def vacuum_retention_rules(spark, sf_dir):
    out, week = [], {vacuum.PROPERTY: "interval 1 week"}
    for name, asked in (("none", "none"), ("week", "none"), ("week", "200"), ("week", "1"), ("week", "1 unchecked"), ("none", "1")):
        n = None if asked == "none" else float(asked.split()[0])
        try:
            hours = int(vacuum.retention(week if name == "week" else {}, n, "unchecked" not in asked).total_seconds() // 3600)
        except vacuum.RetentionTooShort:
            hours = -1
        out.append((name, asked, hours))
    return spark.createDataFrame(out, "property string, asked string, hours int")


@query("SELECT * FROM (VALUES (1, 'Vacuum', 'Vacuum: table=t mode=LITE retention_hours=none dry_run=false'), (2, 'Host', 'SELECT 1'), (3, 'DropCatalog', 'DropCatalog: name=c if_exists=true cascade=true'), (4, 'CreateCatalog', 'CreateCatalog: name=d')) AS t(place, kind, text)")
def sql_script_statements(spark, sf_dir):
    """How a script is split, what its statements are, and the text of their plans."""
    from .plans import sqlext

    found = sqlext.parse("VACUUM t LITE;; SELECT 1 -- a; comment\n; DROP CATALOG IF EXISTS c CASCADE; CREATE CATALOG d;")
    return spark.createDataFrame([(i, type(x).__name__, x.text if isinstance(x, sqlext.Host) else str(x)) for i, x in enumerate(found, 1)], "place int, kind string, text string")


@query("SELECT * FROM (VALUES ('', 'SqlError'), ('SELECT 1; SELECT 2', 'NotImplementedError'), ('CREATE SHARE x', 'NotImplementedError'), ('VACUUM t RETAIN 1', 'SqlError')) AS t(text, refused)")
def sql_refused_statements(spark, sf_dir):
    out, lake = [], LakehouseSession(spark)
    for text in ("", "SELECT 1; SELECT 2", "CREATE SHARE x", "VACUUM t RETAIN 1"):
        try:
            lake.sql(text)
        except (ValueError, NotImplementedError) as e:
            out.append((text, type(e).__name__))
    return spark.createDataFrame(out, "text string, refused string")


@query("SELECT * FROM (VALUES ('a.b', '1'), ('k', 'v'), ('z', 'w'), ('default_collation', 'UTF8')) AS t(name, value)")
def catalog_options(spark, sf_dir):
    lake = LakehouseSession(spark, catalog_client=catalog.MemoryCatalogs())
    made = lake.sql("CREATE CATALOG opted OPTIONS (a.b 1, 'k' 'v', z w,) DEFAULT COLLATION 'UTF8'")
    found = made.select(F.explode(F.from_json(F.get_json_object("securable_object", "$.properties"), "map<string, string>")).alias("name", "value"))
    return found


@query("SELECT 'made' AS step, true AS fine UNION ALL SELECT 'evaluated', false")
def evaluator_deferred_error(spark, sf_dir):
    """A wrong expression is reported when it is evaluated."""
    df = _source(spark, sf_dir, "nation")
    wrong = evaluate.ExpressionEvaluator(df.schema, p.col("no_such_column"), T.IntegerType())
    try:
        wrong.evaluate(df)
        fine = True
    except Exception:
        fine = False
    return spark.createDataFrame([("made", True), ("evaluated", fine)], "step string, fine boolean")


@query("SELECT * FROM (VALUES ('s.label', 'int'), ('s', 'struct<label:int,dims:int>'), ('s.none', 'missing'), ('vec_id.x', 'missing')) AS t(path, type)")
def schema_nested_probe(spark, sf_dir):
    shape, out = LakehouseSession(spark).snapshot(fixtures.path_of(spark, sf_dir, "nested")).schema, []
    for path in ("s.label", "s", "s.none", "vec_id.x"):
        try:
            out.append((path, schema.nested_field(shape, path).simpleString()))
        except schema.SchemaMismatch:
            out.append((path, "missing"))
    return spark.createDataFrame(out, "path string, type string")


@query(
    """SELECT region_url AS url, 'https://b.s3.eu-west-1.amazonaws.com/r' || r_regionkey || '?X-Amz-Algorithm=AWS4-HMAC-SHA256&X-Amz-Credential=KEY%2F20240203%2Feu-west-1%2Fs3%2Faws4_request&X-Amz-Date=20240203T040506Z&X-Amz-Expires=3600&X-Amz-SignedHeaders=host&X-Amz-Signature=' AS head,
       64 AS digits FROM (SELECT r_regionkey, 's3://b/r' || r_regionkey AS region_url FROM region)"""
)
def sign_storage_url_s3(spark, sf_dir):
    """Links at a fixed clock; a test holds the signature against the published example."""
    from datetime import datetime, timezone

    signer = sign_url.s3_signer("KEY", "secret", "eu-west-1", clock=lambda: datetime(2024, 2, 3, 4, 5, 6, tzinfo=timezone.utc))
    rows = _source(spark, sf_dir, "region").select(F.concat(F.lit("s3://b/r"), "r_regionkey").alias("url"))
    made = rows.select("url", sign_url.function({"s3": signer})("url").alias("link"))
    return made.select("url", F.regexp_extract("link", "^(.*X-Amz-Signature=)[0-9a-f]+$", 1).alias("head"), F.length(F.regexp_extract("link", "X-Amz-Signature=([0-9a-f]+)$", 1)).alias("digits"))


@query("SELECT 'part' AS t, count(*) AS n FROM part WHERE p_size < 25 UNION ALL SELECT 'orders', count(*) FROM orders")
def register_plain_table(spark, sf_dir):
    """DataFrames beside log-backed tables in the registry of names."""
    lake = LakehouseSession(spark)
    lake.schema.register_table("tarn_small", _source(spark, sf_dir, "part").where("p_size < 25"))
    lake.register_delta("tarn_log", fixtures.path_of(spark, sf_dir, "sorted_orders"))
    out = lake.sql("SELECT 'part' AS t, count(*) AS n FROM tarn_small UNION ALL SELECT 'orders', count(*) FROM tarn_log")
    for name in ("tarn_small", "tarn_log"):
        lake.schema.deregister_table(name)
    return out


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CASE WHEN o_totalprice > 100000 THEN o_orderpriority END AS o_orderpriority FROM orders")
def insert_into(spark, sf_dir):
    """Two appends to an empty partitioned table, the second of some columns, read through SQL."""
    df = _source(spark, sf_dir, "orders")
    b = fixtures.Builder(spark, fixtures.path_of(spark, sf_dir, "empty", fresh=True) + "-orders")
    b.commit(*b.start(df.schema, ["o_orderstatus"]))
    lake = LakehouseSession(spark)
    df.createOrReplaceTempView("tarn_source")
    lake.register_delta("tarn_target", b.root)
    try:
        lake.sql(f"INSERT INTO tarn_target SELECT {', '.join(df.columns)} FROM tarn_source WHERE o_totalprice > 100000")
        some = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"
        lake.sql(f"INSERT INTO tarn_target ({some}) SELECT {some} FROM tarn_source WHERE NOT (o_totalprice > 100000)")
        return lake.sql(f"SELECT {ORDERS} FROM tarn_target WHERE o_orderkey >= 0")
    finally:
        lake.schema.deregister_table("tarn_target")
