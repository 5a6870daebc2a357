"""Registered queries (one per operator of the inventory) and their DuckDB oracles.

Each query takes (spark, sf_dir) and returns a DataFrame over the given
tables; each oracle is DuckDB SQL over the same tables with the same column
names and types.
"""

from __future__ import annotations

import dataclasses
import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import initial, to_decimal
from lodestar.operators import activate as act
from lodestar.operators import asof
from lodestar.operators import checks as chk
from lodestar.operators import dims, latest, views
from lodestar.operators.project import project, sort_load, top_n
from lodestar.plans import extracts as ex
from lodestar.plans import fixtures as fx
from lodestar.plans import jobs
from lodestar.session import work_dir
from lodestar.sources import files, ledger, sinks
from lodestar.sources.publish import as_of_request, publish_checked
from lodestar.sources.store import Store
from lodestar.spec import Check, EntitySpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _t(spark, sf, name):
    return fx.table(spark, sf, name)


# --------------------------------------------------------------------------- #
# shared SQL pieces
# --------------------------------------------------------------------------- #
DOC_KEYS = "doc_num, doc_item"
DOC_COLS = "recordmode, doc_num, doc_item, material, vendor, pstng_date, quant_b, value_lc, discount, linestatus"
DOC_TARGET = ("CAST(NULL AS VARCHAR) AS recordmode, doc_num, doc_item, material, vendor, pstng_date, quant_b, "
              "value_lc, discount, linestatus")
CUT_D = f"DATE '{fx.CUT}'"


def latest_sql(src: str, keys: str, where: str = "true", order: str = "reqtsn DESC, datapakid DESC, record DESC") -> str:
    return f"""SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn FROM ({src}) s WHERE {where}
) x WHERE _rn = 1"""


def doc_state_sql(where: str = "true") -> str:
    """Active doc rows: latest change per key among rows matching ``where``, not deleted."""
    return f"""SELECT {DOC_TARGET} FROM ({latest_sql(fx.DOC_INBOUND_SQL, DOC_KEYS, where)}) l
WHERE coalesce(recordmode, '') <> 'D'"""


DOC_A_SQL = doc_state_sql(f"pstng_date < {CUT_D}")
DOC_ALL_SQL = doc_state_sql()

ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderpriority FROM orders"""
ORDERS_TEXT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS {0}, CAST(o_custkey AS VARCHAR) AS {1}, o_orderstatus AS {2},
  CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS VARCHAR) AS {3}, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS {4},
  o_orderpriority AS {5} FROM orders"""
ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate DATE, "
              "o_orderpriority STRING")
ORDER_NAMES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


ORDERS_SPEC = EntitySpec(name="orders", kind="insert", ddl=ORDERS_DDL, partition_date="o_orderdate")


def orders_typed(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")


def orders_for_text(spark, sf) -> DataFrame:
    o = orders_typed(spark, sf)
    return o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(17,2)"))


# --------------------------------------------------------------------------- #
# 2.1 sources and sinks
# --------------------------------------------------------------------------- #
@register("src_csv", ORDERS_TEXT_SQL.format(*ORDER_NAMES))
def q_src_csv(spark, sf):
    path = work_dir(spark, "src_csv")
    orders_for_text(spark, sf).write.options(header=True, sep="|", escape="\\").csv(path)
    return files.read_source(spark, "csv", path, sep="|")


@register("src_csv_noheader", ORDERS_TEXT_SQL.format(*[f"_c{i}" for i in range(6)]))
def q_src_csv_noheader(spark, sf):
    path = work_dir(spark, "src_csv_noheader")
    orders_for_text(spark, sf).write.options(header=False, sep=",", escape="\\").csv(path)
    return files.read_source(spark, "csv", path, header=False)


@register("src_csv_mixed_headers", ORDERS_TEXT_SQL.format(*ORDER_NAMES))
def q_src_csv_mixed_headers(spark, sf):
    # two files of one load whose columns stand in different orders
    o = orders_for_text(spark, sf)
    base = work_dir(spark, "csv_mixed")
    even = F.col("o_orderkey").cast("long") % 2 == 0
    o.where(even).write.options(header=True).csv(f"{base}/a")
    o.where(~even).select(*reversed(o.columns)).write.options(header=True).csv(f"{base}/b")
    return files.read_source(spark, "csv", [f"{base}/a", f"{base}/b"])


@register("src_object_root", ORDERS_SQL)
def q_src_object_root(spark, sf):
    # the spec's root folder (an object store's in production, the shared folder here)
    root = work_dir(spark, "bucket")
    spec = dataclasses.replace(ORDERS_SPEC, root=f"{root}/orders")
    orders_typed(spark, sf).write.parquet(f"{spec.root}/t2")
    store = _store(spark)
    jobs.create(store, spec, "2")
    jobs.insert(store, spec, "2")
    return store.read(jobs.tname(spec, "2"))


@register("src_orc", ORDERS_SQL)
def q_src_orc(spark, sf):
    path = work_dir(spark, "src_orc")
    orders_typed(spark, sf).write.orc(path)
    return files.read_source(spark, "orc", path)


@register("src_parquet", ORDERS_SQL)
def q_src_parquet(spark, sf):
    path = work_dir(spark, "src_parquet")
    orders_typed(spark, sf).write.parquet(path)
    return files.read_source(spark, "parquet", path)


@register("convert_orc", ORDERS_TEXT_SQL.format(*ORDER_NAMES))
def q_convert_orc(spark, sf):
    base = work_dir(spark, "convert_orc")
    orders_for_text(spark, sf).write.options(header=True).csv(f"{base}/csv")
    sinks.convert(files.read_source(spark, "csv", f"{base}/csv"), "orc", f"{base}/orc")
    return files.read_source(spark, "orc", f"{base}/orc")


def _orders_by_status(spark, sf) -> str:
    """orders as an extract folder, one sub-folder per status under t1."""
    root = work_dir(spark, "orders_extract")
    orders_typed(spark, sf).write.partitionBy("o_orderstatus").parquet(f"{root}/t1")
    return root


def _with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderstatus", F.regexp_extract(F.col(files.FILE_COL), "o_orderstatus=([^/]+)", 1))


def _read_files(spark, todo: DataFrame) -> DataFrame:
    paths = [r["file"] for r in todo.collect()]  # file names only
    if not paths:
        return spark.createDataFrame([], ORDERS_DDL)
    df = _with_status(files.read_source(spark, "parquet", paths, with_file=True))
    return df.select(*ORDER_NAMES)


@register("src_discover", "SELECT o_orderstatus AS status, count(*) AS cnt FROM orders GROUP BY 1")
def q_src_discover(spark, sf):
    root = _orders_by_status(spark, sf)
    found = files.source_files(spark, root, "1")
    df = _with_status(files.read_source(spark, "parquet", [r["file"] for r in found.collect()], with_file=True))
    return df.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("cnt"))


def _ledger_with_f(spark, sf):
    root = _orders_by_status(spark, sf)
    store = Store(spark, f"{root}/store")
    found = files.source_files(spark, root, "1")
    ledger.ledger_append(store, "orders", "1", found.where(F.col("file").contains("o_orderstatus=F")))
    return root, store, found


@register("intake_incremental", ORDERS_SQL + " WHERE o_orderstatus <> 'F'")
def q_intake_incremental(spark, sf):
    _, store, found = _ledger_with_f(spark, sf)
    return _read_files(spark, ledger.unprocessed(found, store, "orders", "1"))


@register("intake_reload", ORDERS_SQL)
def q_intake_reload(spark, sf):
    # loadmanytimes: the ledger is not consulted
    _, store, found = _ledger_with_f(spark, sf)
    return _read_files(spark, found)


@register("ledger_reset", ORDERS_SQL)
def q_ledger_reset(spark, sf):
    _, store, found = _ledger_with_f(spark, sf)
    ledger.ledger_reset(store, "orders", "1")
    return _read_files(spark, ledger.unprocessed(found, store, "orders", "1"))


def _orders_store(spark, sf) -> Store:
    store = Store(spark, work_dir(spark, "store"))
    store.create("orders_t", orders_typed(spark, sf).schema, partition_date="o_orderdate")
    return store


@register("insert_append", f"{ORDERS_SQL} WHERE o_orderstatus = 'F' UNION ALL {ORDERS_SQL}")
def q_insert_append(spark, sf):
    store = _orders_store(spark, sf)
    o = orders_typed(spark, sf)
    store.append("orders_t", o.where(F.col("o_orderstatus") == "F"))
    store.append("orders_t", o)
    return store.read("orders_t")


@register("create_table", DOC_A_SQL)
def q_create_table(spark, sf):
    # create or replace empties a table that held other rows; what is inserted next is all it holds
    store = Store(spark, work_dir(spark, "store"))
    name = jobs.tname(fx.DOC, "2")
    state = ex.initial_state(spark, sf, "doc")
    store.replace(name, state.unionByName(state), fx.DOC.partition_date)
    jobs.create(store, fx.DOC, "2")
    store.append(name, state)
    return store.read(name)


@register("delete_all", f"{ORDERS_SQL} WHERE o_orderstatus = 'P'")
def q_delete_all(spark, sf):
    store = _orders_store(spark, sf)
    o = orders_typed(spark, sf)
    store.append("orders_t", o)
    store.truncate("orders_t")
    store.append("orders_t", o.where(F.col("o_orderstatus") == "P"))
    return store.read("orders_t")


@register("drop_create", f"{ORDERS_SQL} WHERE o_orderstatus = 'P'")
def q_drop_create(spark, sf):
    store = _orders_store(spark, sf)
    o = orders_typed(spark, sf)
    store.append("orders_t", o)
    store.dropcreate("orders_t", o.schema, partition_date="o_orderdate")  # SNK3: data gone, table new
    assert store.snapshots("orders_t") == [1]
    store.append("orders_t", o.where(F.col("o_orderstatus") == "P"))
    return store.read("orders_t")


DEL_COND = "o_totalprice > 100000 AND o_orderstatus = 'O'"


@register("delete_where", f"{ORDERS_SQL} WHERE NOT coalesce({DEL_COND}, false)")
def q_delete_where(spark, sf):
    store = _orders_store(spark, sf)
    store.append("orders_t", orders_typed(spark, sf))
    store.delete_where("orders_t", DEL_COND)
    return store.read("orders_t")


@register("write_by_request", fx.DOC_INBOUND_SQL)
def q_write_by_request(spark, sf):
    inb = ex.inbound(spark, sf, "doc")
    path = work_dir(spark, "by_request")
    sinks.write_by_request(inb, "parquet", path, cluster=False)  # numbered rows: range-partitioned by request
    return sinks.read_by_request(spark, "parquet", path, inb.schema).select(*inb.columns)


@register("request_running_total", f"""SELECT reqtsn, count(*) AS cnt,
  CAST(sum(count(*)) OVER (ORDER BY reqtsn) AS BIGINT) AS running_total
FROM ({fx.DOC_INBOUND_SQL}) s GROUP BY reqtsn""")
def q_request_running_total(spark, sf):
    return sinks.request_profile(ex.inbound(spark, sf, "doc", numbered=False))


@register("distinct_requests", f"SELECT DISTINCT reqtsn FROM ({fx.DOC_INBOUND_SQL}) s")
def q_distinct_requests(spark, sf):
    return latest.distinct_requests(ex.inbound(spark, sf, "doc", numbered=False))


@register("count_rows", f"SELECT count(*) AS cnt FROM ({fx.DOC_INBOUND_SQL}) s")
def q_count_rows(spark, sf):
    return latest.count_rows(ex.inbound(spark, sf, "doc", numbered=False))


# --------------------------------------------------------------------------- #
# 2.2 projections, filters, order
# --------------------------------------------------------------------------- #
@register("project_mapped", f"SELECT {DOC_COLS} FROM ({fx.DOC_INBOUND_SQL}) s")
def q_project_mapped(spark, sf):
    return project(ex.staging(spark, sf, "doc"), fx.DOC, "2")


@register("project_inbound", fx.DOC_INBOUND_SQL)
def q_project_inbound(spark, sf):
    return project(ex.staging(spark, sf, "doc"), fx.DOC, "1")


@register("project_view_sql", fx.DOC_INBOUND_SQL)
def q_project_view_sql(spark, sf):
    from lodestar.operators.project import project_sql

    files.stage(ex.staging(spark, sf, "doc"), "doc_staging")
    return project_sql(spark, "doc_staging", fx.DOC, "1")


@register("rename_quoted", """SELECT CAST(l_partkey AS VARCHAR) AS material,
  CAST("/BIC/ZALTCOST" AS DECIMAL(17,2)) AS zaltcost, coalesce("/BIC/ZSGTXT", chr(0)) AS zsgtxt
FROM (SELECT l_partkey, l_extendedprice AS "/BIC/ZALTCOST",
  CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS "/BIC/ZSGTXT" FROM lineitem) s""")
def q_rename_quoted(spark, sf):
    li = _t(spark, sf, "lineitem")
    staged = li.select("l_partkey", F.col("l_extendedprice").alias("/BIC/ZALTCOST"),
                       F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("/BIC/ZSGTXT"))
    spec = EntitySpec(
        name="quoted", kind="insert", ddl="material STRING, zaltcost DECIMAL(17,2), zsgtxt STRING NOT NULL",
        mapping=(("material", "l_partkey"), ("zaltcost", "`/BIC/ZALTCOST`"), ("zsgtxt", "ifnull(`/BIC/ZSGTXT`, chr(0))")))
    return project(staged, spec)


@register("cast_decimal", """SELECT l_orderkey, l_linenumber,
  CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(17,2)) AS value_lc,
  CAST(CAST(l_quantity AS VARCHAR) AS DECIMAL(17,3)) AS quant_b FROM lineitem""")
def q_cast_decimal(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     to_decimal(F.col("l_extendedprice").cast("string"), 17, 2).alias("value_lc"),
                     to_decimal(F.col("l_quantity").cast("string"), 17, 3).alias("quant_b"))


BAD_DATE = "l_linestatus = 'O' AND l_returnflag = 'A'"


@register("parse_bw_date", f"""SELECT l_orderkey, l_linenumber,
  CAST(try_strptime(CASE WHEN {BAD_DATE} THEN '00000000' ELSE strftime(l_shipdate, '%Y%m%d') END, '%Y%m%d')
       AS DATE) AS calday FROM lineitem""")
def q_parse_bw_date(spark, sf):
    from lodestar.functions import bw_date

    li = _t(spark, sf, "lineitem")
    txt = F.when(F.expr(BAD_DATE), F.lit("00000000")).otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    return li.select("l_orderkey", "l_linenumber", bw_date(txt, strict=False).alias("calday"))


@register("null_to_initial", """SELECT CAST(c_custkey AS VARCHAR) AS customer,
  coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), chr(0)) AS segment FROM customer""")
def q_null_to_initial(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("customer"),
                    initial(F.expr("nullif(c_mktsegment, 'HOUSEHOLD')")).alias("segment"))


CUST_SEL = ('"0customer" AS customer, "0customer___txtlg" AS customer_txt, "0country" AS country, '
            '"0region" AS region, "0segment" AS segment, CAST("0acctbal" AS DECIMAL(17,2)) AS acctbal')
CUST_NULLED_SQL = f"""SELECT * REPLACE (nullif("0segment", 'BUILDING') AS "0segment") FROM ({fx.CUSTOMER_STAGING_SQL}) s"""


def cust_nulled(spark, sf) -> DataFrame:
    st = fx.customer_staging(spark, sf)
    return st.withColumn("0segment", F.expr("nullif(`0segment`, 'BUILDING')"))


@register("filter_load", f"""SELECT {CUST_SEL} FROM ({CUST_NULLED_SQL}) s
WHERE "0segment" <> 'HOUSEHOLD' AND "0country" <> '3'""")
def q_filter_load(spark, sf):
    return project(cust_nulled(spark, sf), fx.CUST, "0", where="`0segment` <> 'HOUSEHOLD' AND `0country` <> '3'",
                   order="")


@register("filter_compare", f"SELECT * FROM ({DOC_A_SQL}) a WHERE value_lc > 50000 AND linestatus = 'F'")
def q_filter_compare(spark, sf):
    a = ex.initial_state(spark, sf, "doc")
    return a.where((F.col("value_lc") > 50000) & (F.col("linestatus") == "F"))


@register("sort_load", f"""SELECT {CUST_SEL} FROM ({fx.CUSTOMER_STAGING_SQL}) s
WHERE "0segment" <> 'HOUSEHOLD' ORDER BY 1""")
def q_sort_load(spark, sf):
    return sort_load(project(fx.customer_staging(spark, sf), fx.CUST, "0", order=""), "1")


TOP_ORDER_SQL = "value_lc DESC, doc_num, doc_item, reqtsn, record"


@register("top_n", f"SELECT * FROM ({fx.DOC_INBOUND_SQL}) s ORDER BY {TOP_ORDER_SQL} LIMIT 100")
def q_top_n(spark, sf):
    inb = ex.inbound(spark, sf, "doc")
    order = [F.col("value_lc").desc(), "doc_num", "doc_item", "reqtsn", "record"]
    return top_n(inb, order, 100)


# --------------------------------------------------------------------------- #
# 2.3 / 2.4 joins and aggregations
# --------------------------------------------------------------------------- #
@register("join_latest_semi", latest_sql(fx.DOC_INBOUND_SQL, DOC_KEYS))
def q_join_latest_semi(spark, sf):
    inb = ex.inbound(spark, sf, "doc")
    ids = latest.latest_identities(inb, list(fx.DOC.keys))
    return latest.join_latest_semi(inb, ids)


@register("latest_per_key", latest_sql(fx.DOC_INBOUND_SQL, DOC_KEYS))
def q_latest_per_key(spark, sf):
    return latest.latest_per_key(ex.inbound(spark, sf, "doc"), list(fx.DOC.keys))


@register("latest_per_key_text",
          latest_sql(fx.DOC_INBOUND_SQL, DOC_KEYS, order="reqtsn || datapakid || CAST(record AS VARCHAR) DESC"))
def q_latest_per_key_text(spark, sf):
    return latest.latest_per_key(ex.inbound(spark, sf, "doc"), list(fx.DOC.keys), order="text")


@register("key_profile", f"""SELECT {DOC_KEYS}, max(reqtsn) AS reqtsn, max(datapakid) AS datapakid,
  max(record) AS record, max(recordmode) AS recordmode, count(*) AS cnt
FROM ({fx.DOC_INBOUND_SQL}) s GROUP BY {DOC_KEYS}""")
def q_key_profile(spark, sf):
    return latest.key_profile(ex.inbound(spark, sf, "doc"), list(fx.DOC.keys))


CUBE_SUM = "CAST(sum(quant_b) AS DECIMAL(17,3)) AS quant_b, CAST(sum(value_lc) AS DECIMAL(17,2)) AS value_lc"


CUBE_K = "calday, material, vendor"


@register("sum_per_key_rowcnt", f"SELECT {CUBE_K}, count(*) AS rowcnt FROM ({fx.CUBE_INBOUND_SQL}) s GROUP BY {CUBE_K}")
def q_sum_per_key_rowcnt(spark, sf):
    return latest.sum_per_key(ex.inbound(spark, sf, "cube", numbered=False), list(fx.CUBE.keys), [])


@register("sum_per_key", f"SELECT {CUBE_K}, {CUBE_SUM} FROM ({fx.CUBE_INBOUND_SQL}) s GROUP BY {CUBE_K}")
def q_sum_per_key(spark, sf):
    return latest.sum_per_key(ex.inbound(spark, sf, "cube", numbered=False), list(fx.CUBE.keys), list(fx.CUBE.figures))


STOCK_K5 = "base_uom, loc_currcy, material, plant, stor_loc, valspecst"
STOCK_K = "calday, " + STOCK_K5


def stock_sums(prefix: str = "") -> str:
    out = []
    for f in fx.STOCK_FIGS:
        typ = "DECIMAL(17,3)" if f.endswith("bu") else "DECIMAL(17,2)"
        out.append(f"CAST(sum({prefix}{f}) AS {typ}) AS {f}")
    return ", ".join(out)


@register("sum_per_stock_key", f"""SELECT {STOCK_K5}, min(calday) AS calday, {stock_sums()}
FROM ({fx.STOCK_INBOUND_SQL}) s GROUP BY {STOCK_K5}""")
def q_sum_per_stock_key(spark, sf):
    return latest.sum_per_stock_key(ex.inbound(spark, sf, "stock", numbered=False), list(fx.STOCK.keys), list(fx.STOCK.figures))


def _attr_sql(name: str, where: str = "\"0segment\" <> 'HOUSEHOLD'") -> str:
    return f"""SELECT DISTINCT CAST("0{name}" AS VARCHAR) AS {name}, CAST("0{name}___t" AS VARCHAR) AS {name}_txt
FROM ({fx.CUSTOMER_STAGING_SQL}) s WHERE {where}"""


@register("attr_distinct", _attr_sql("segment"))
def q_attr_distinct(spark, sf):
    st = fx.customer_staging(spark, sf)
    return dims.attribute_table(st, "segment", "`0segment`", "`0segment___t`", fx.CUST.where)


@register("attr_city", _attr_sql("country"))
def q_attr_city(spark, sf):
    return dims.attribute_tables(fx.customer_staging(spark, sf), fx.CUST)["country"]


ATTR_ALL_SQL = " UNION ".join(
    f"""SELECT '{a}' AS attr, CAST("0{a}" AS VARCHAR) AS code, CAST("0{a}___t" AS VARCHAR) AS text
FROM ({fx.CUSTOMER_STAGING_SQL}) s WHERE "0segment" <> 'HOUSEHOLD'""" for a in ("country", "region", "segment"))


@register("attr_all", ATTR_ALL_SQL)
def q_attr_all(spark, sf):
    return dims.attributes_long(fx.customer_staging(spark, sf), fx.CUST)


# --------------------------------------------------------------------------- #
# 2.5 activation
# --------------------------------------------------------------------------- #
@register("activate_standard", DOC_ALL_SQL)
def q_activate_standard(spark, sf):
    a = ex.initial_state(spark, sf, "doc")
    return act.activate_standard(a, ex.inbound(spark, sf, "doc", "after"), fx.DOC)


DOC_D_LATEST = latest_sql(fx.DOC_INBOUND_SQL, DOC_KEYS, f"pstng_date >= {CUT_D}")


@register("activate_standard_strict", f"""WITH a AS ({DOC_A_SQL}), l AS ({DOC_D_LATEST})
SELECT a.* FROM a ANTI JOIN (SELECT {DOC_KEYS} FROM l WHERE recordmode = 'D') d USING ({DOC_KEYS})
UNION ALL
SELECT {DOC_TARGET} FROM l ANTI JOIN a USING ({DOC_KEYS})""")
def q_activate_standard_strict(spark, sf):
    a = ex.initial_state(spark, sf, "doc")
    return act.activate_standard(a, ex.inbound(spark, sf, "doc", "after"), fx.DOC, mode="strict")


EV_KEYS = "user_id, event_type"


EVENTS_ALL_SQL = f"""SELECT CAST(NULL AS VARCHAR) AS recordmode, user_id, event_type, ev_date,
  value, props FROM ({latest_sql(fx.EVENTS_INBOUND_SQL, EV_KEYS)}) l WHERE coalesce(recordmode, '') <> 'D'"""


@register("activate_standard_events", EVENTS_ALL_SQL)
def q_activate_standard_events(spark, sf):
    a = ex.initial_state(spark, sf, "events")
    return act.activate_standard(a, ex.inbound(spark, sf, "events", "after"), fx.EVENTS)


def cube_sql(where: str = "true") -> str:
    return f"SELECT {CUBE_K}, {CUBE_SUM} FROM ({fx.CUBE_INBOUND_SQL}) s WHERE {where} GROUP BY {CUBE_K}"


CUBE_ALL_SQL = cube_sql()
CUBE_A_SQL = cube_sql(f"calday < {CUT_D}")


@register("activate_cube", CUBE_ALL_SQL)
def q_activate_cube(spark, sf):
    a = ex.initial_state(spark, sf, "cube")
    return act.activate_cube(a, ex.inbound(spark, sf, "cube", "after", numbered=False), fx.CUBE)


STOCK_OUT = ("recordmode, recordtp, calday, base_uom, loc_currcy, plant, material, stor_loc, valspecst, "
             "cptstisbu, cptstispv, cptstrebu, cptstrepv, altstispv, altstrepv")
MOVEMENTS_SQL = f"""SELECT CAST(NULL AS VARCHAR) AS recordmode, '2' AS recordtp, {STOCK_K}, {stock_sums()}
FROM ({fx.STOCK_INBOUND_SQL}) s GROUP BY {STOCK_K}"""


@register("activate_movements", f"SELECT {STOCK_OUT} FROM ({MOVEMENTS_SQL}) m")
def q_activate_movements(spark, sf):
    a = ex.initial_state(spark, sf, "stock", "2")
    return act.activate_movements(a, ex.inbound(spark, sf, "stock", "after", numbered=False), fx.STOCK)


def _marker_sql(strict: bool = False) -> str:
    grp = f"SELECT {STOCK_K5}, min(calday) AS calday, {stock_sums()}, 1 AS _p FROM ({fx.STOCK_INBOUND_SQL}) s"
    a = f"{grp} WHERE calday < {CUT_D} GROUP BY {STOCK_K5}"
    d = f"{grp} WHERE calday >= {CUT_D} GROUP BY {STOCK_K5}"
    both = "a._p IS NOT NULL AND d._p IS NOT NULL"
    cols = []
    pairs = {rec: iss for rec, iss in fx.STOCK.stock_pairs}
    for f in ["cptstisbu", "cptstispv", "cptstrebu", "cptstrepv", "altstispv", "altstrepv"]:
        typ = "DECIMAL(17,3)" if f.endswith("bu") else "DECIMAL(17,2)"
        if f in pairs:
            iss = pairs[f]
            if strict:  # NULL propagates (Q5 as the configured merge runs)
                upd = f"a.{f} + d.{f} - d.{iss}"
            else:
                upd = (f"CASE WHEN a.{f} IS NULL AND d.{f} IS NULL AND d.{iss} IS NULL THEN NULL "
                       f"ELSE coalesce(a.{f}, 0) + coalesce(d.{f}, 0) - coalesce(d.{iss}, 0) END")
        else:
            upd = f"a.{f}"
        cols.append(f"CAST(CASE WHEN {both} THEN {upd} WHEN a._p IS NOT NULL THEN a.{f} ELSE d.{f} END AS {typ}) AS {f}")
    keys = ", ".join(f"coalesce(a.{k}, d.{k}) AS {k}" for k in STOCK_K5.split(", "))
    return f"""SELECT CAST(NULL AS VARCHAR) AS recordmode, '1' AS recordtp,
  CASE WHEN a._p IS NOT NULL THEN a.calday ELSE d.calday END AS calday, {keys}, {", ".join(cols)}
FROM ({a}) a FULL JOIN ({d}) d USING ({STOCK_K5})"""


MARKER_SQL = _marker_sql()


@register("activate_marker", f"SELECT {STOCK_OUT} FROM ({MARKER_SQL}) m")
def q_activate_marker(spark, sf):
    m = ex.initial_state(spark, sf, "stock", "5")
    return act.activate_marker(m, ex.inbound(spark, sf, "stock", "after", numbered=False), fx.STOCK)


@register("activate_marker_strict", f"SELECT {STOCK_OUT} FROM ({_marker_sql(strict=True)}) m")
def q_activate_marker_strict(spark, sf):
    m = ex.initial_state(spark, sf, "stock", "5")
    return act.activate_marker(m, ex.inbound(spark, sf, "stock", "after", numbered=False), fx.STOCK, null_policy="strict")


@register("stock_balance", f"""SELECT {STOCK_K5},
  CAST(sum(coalesce(altstrepv, 0) - coalesce(altstispv, 0)) AS DECIMAL(17,2)) AS altstrepv_bal,
  CAST(sum(coalesce(cptstrebu, 0) - coalesce(cptstisbu, 0)) AS DECIMAL(17,3)) AS cptstrebu_bal,
  CAST(sum(coalesce(cptstrepv, 0) - coalesce(cptstispv, 0)) AS DECIMAL(17,2)) AS cptstrepv_bal
FROM ({fx.STOCK_INBOUND_SQL}) s GROUP BY {STOCK_K5}""")
def q_stock_balance(spark, sf):
    m = ex.initial_state(spark, sf, "stock", "5")
    m = act.activate_marker(m, ex.inbound(spark, sf, "stock", "after", numbered=False), fx.STOCK)
    return act.stock_balance(m, fx.STOCK)


# --------------------------------------------------------------------------- #
# 2.6 set operations and views
# --------------------------------------------------------------------------- #
MATL_SEL = ('"0material" AS material, "0material___txtlg" AS material_txt, "0matl_group" AS matl_group, '
            '"0matl_type" AS matl_type, "0base_uom" AS base_uom, CAST("0size" AS INTEGER) AS size')


@register("view_inbound_active", f"""SELECT {DOC_COLS} FROM ({fx.DOC_INBOUND_SQL}) s WHERE pstng_date >= {CUT_D}
UNION ALL SELECT {DOC_COLS} FROM ({DOC_A_SQL}) a""")
def q_view_inbound_active(spark, sf):
    a = ex.initial_state(spark, sf, "doc")
    d = ex.inbound(spark, sf, "doc", "after")
    return views.inbound_active_view(d, a, fx.DOC.columns)


@register("view_material_ext", """SELECT lpad(CAST(p_partkey AS VARCHAR), 18, '0') AS material,
  p_brand || right(lpad(CAST(p_partkey AS VARCHAR), 18, '0'), 6) AS material_ext, p_name AS material_txt FROM part""")
def q_view_material_ext(spark, sf):
    md = project(fx.material_staging(spark, sf), fx.MATL, "0", where="true", order="")
    return views.material_text_view(md)


def _material_view(name: str):
    def run(spark, sf):
        md = project(fx.material_staging(spark, sf), fx.MATL, "0", where="true", order="")
        return views.material_views(md, MATL_SUBSET, prefix="material")[name]
    return run


MATL_SUBSET = ["material", "matl_group", "base_uom", "size"]
register("view_material_all", f"SELECT {MATL_SEL} FROM ({fx.MATERIAL_STAGING_SQL}) s")(_material_view("all"))
register("view_material_01", f"SELECT {', '.join(MATL_SUBSET)} FROM (SELECT {MATL_SEL} FROM ({fx.MATERIAL_STAGING_SQL}) s) m")(
    _material_view("01"))


@register("reconcile_keys", f"""SELECT {DOC_KEYS} FROM ({latest_sql(fx.DOC_INBOUND_SQL, DOC_KEYS)}) l
EXCEPT SELECT {DOC_KEYS} FROM ({DOC_ALL_SQL}) a""")
def q_reconcile_keys(spark, sf):
    inb = ex.inbound(spark, sf, "doc")
    ids = latest.latest_identities(inb, list(fx.DOC.keys))
    a = act.activate_standard(ex.initial_state(spark, sf, "doc"), ex.inbound(spark, sf, "doc", "after"), fx.DOC)
    return views.missing_keys(ids, a, list(fx.DOC.keys))


# --------------------------------------------------------------------------- #
# 2.7 dimensions
# --------------------------------------------------------------------------- #
def _calendar_sql(weekend: str) -> str:
    return f"""SELECT d AS calday, strftime(d, '%Y%m%d') AS calday_s, CAST(year(d) AS INTEGER) AS calyear,
  CAST(quarter(d) AS INTEGER) AS calquarter1, CAST(month(d) AS INTEGER) AS calmonth2,
  CAST(isodow(d) AS INTEGER) AS weekday1, dayname(d) AS weekday1_txt, isodow(d) IN ({weekend}) AS weekend,
  false AS holiday, CAST(year(d) AS VARCHAR) || lpad(CAST(month(d) AS VARCHAR), 2, '0') AS calmonth,
  CAST(year(d) AS VARCHAR) || lpad(CAST(quarter(d) AS VARCHAR), 2, '0') AS calquarter
FROM (SELECT CAST(unnest(generate_series(min(l_shipdate)::DATE, max(l_shipdate)::DATE, INTERVAL 1 DAY)) AS DATE) AS d
      FROM lineitem) days"""


@register("calendar", _calendar_sql("6, 7"))
def q_calendar(spark, sf):
    return dims.calendar_for(_t(spark, sf, "lineitem"), F.col("l_shipdate"))


@register("calendar_strict_weekend", _calendar_sql("1, 7"))
def q_calendar_strict_weekend(spark, sf):
    return dims.calendar_for(_t(spark, sf, "lineitem"), F.col("l_shipdate"), weekend="mon_sun")


MASTER_SQL = f"""SELECT {CUST_SEL} FROM ({fx.CUSTOMER_STAGING_SQL}) s WHERE "0segment" <> 'HOUSEHOLD'"""


@register("load_master", MASTER_SQL)
def q_load_master(spark, sf):
    return dims.load_master(fx.customer_staging(spark, sf), fx.CUST)


CUST_ROW = ("concat_ws('|', customer, customer_txt, country, region, segment, CAST(acctbal AS {})) AS text")


@register("job_master", f"""SELECT attr, code, text FROM ({ATTR_ALL_SQL}) a
UNION ALL SELECT '0' AS attr, customer AS code, {CUST_ROW.format('VARCHAR')} FROM ({MASTER_SQL}) m""")
def q_job_master(spark, sf):
    # from files: the snapshot table 0 and every attribute table, in long form
    root = work_dir(spark, "customer_extract")
    fx.customer_staging(spark, sf).write.parquet(root)
    out = jobs.job_master(_store(spark), dataclasses.replace(fx.CUST, safe_dml=True), root=root)
    parts = [out[a.name].select(F.lit(a.name).alias("attr"), F.col(a.name).alias("code"),
                                F.col(f"{a.name}_txt").alias("text")) for a in fx.CUST.attributes]
    res = out["0"].select(F.lit("0").alias("attr"), F.col("customer").alias("code"), F.expr(CUST_ROW.format("STRING")))
    for p in parts:
        res = res.unionByName(p)
    return res


MATL_WHERE = "\"0base_uom\" <> ''"


@register("load_master_material", f"SELECT {MATL_SEL} FROM ({fx.MATERIAL_STAGING_SQL}) s WHERE {MATL_WHERE}")
def q_load_master_material(spark, sf):
    return dims.load_master(fx.material_staging(spark, sf), fx.MATL)


@register("attr_material", " UNION ".join(
    f"""SELECT '{a}' AS attr, CAST("0{a}" AS VARCHAR) AS code, CAST("0{a}___t" AS VARCHAR) AS text
FROM ({fx.MATERIAL_STAGING_SQL}) s WHERE {MATL_WHERE}""" for a in ("matl_group", "matl_type")))
def q_attr_material(spark, sf):
    return dims.attributes_long(fx.material_staging(spark, sf), fx.MATL)


# --------------------------------------------------------------------------- #
# 2.8 checks and publishing
# --------------------------------------------------------------------------- #
@register("check_pk", f"""SELECT 'pk' AS "check", count(*) AS cnt FROM (
  SELECT {DOC_KEYS} FROM ({fx.DOC_INBOUND_SQL}) s GROUP BY {DOC_KEYS} HAVING count(*) > 1) d""")
def q_check_pk(spark, sf):
    return chk.check_pk(ex.inbound(spark, sf, "doc", numbered=False), list(fx.DOC.keys))


@register("check_initial", f"""SELECT 'initial:segment' AS "check", count(*) AS cnt
FROM (SELECT coalesce("0segment", chr(0)) AS segment FROM ({CUST_NULLED_SQL}) s) x WHERE segment = chr(0)""")
def q_check_initial(spark, sf):
    df = cust_nulled(spark, sf).select(initial("0segment").alias("segment"))
    return chk.check_initial(df, "segment")


@register("check_not_null", " UNION ALL ".join(
    f"""SELECT 'not_null:{c}' AS "check", count(*) FILTER (WHERE {c} IS NULL) AS cnt
FROM (SELECT {CUST_SEL} FROM ({CUST_NULLED_SQL}) s) x""" for c in ("customer", "country", "region", "segment")))
def q_check_not_null(spark, sf):
    df = project(cust_nulled(spark, sf), fx.CUST, "0", where="true", order="")
    return chk.check_not_null(df, fx.CUST)


@register("check_material", f"""WITH m AS (SELECT {MATL_SEL} FROM ({fx.MATERIAL_STAGING_SQL}) s WHERE {MATL_WHERE})
SELECT 'pk' AS "check", count(*) AS cnt FROM (SELECT material FROM m GROUP BY material HAVING count(*) > 1) d
UNION ALL SELECT 'initial:material' AS "check", count(*) FILTER (WHERE material = chr(0)) AS cnt FROM m""")
def q_check_material(spark, sf):
    # the material entity's declared checks (key unique, no initial key), run (Q8)
    md = dims.load_master(fx.material_staging(spark, sf), fx.MATL)
    return chk.check_report([chk.check_pk(md, ["material"]), chk.check_initial(md, "material")])


_NN = ("doc_num", "doc_item", "material", "vendor", "linestatus")


@register("check_report", f"""WITH a AS ({DOC_ALL_SQL})
{" UNION ALL ".join(f"SELECT 'not_null:{c}' AS \"check\", count(*) FILTER (WHERE {c} IS NULL) AS cnt FROM a"
                    for c in _NN)}
UNION ALL SELECT 'pk' AS "check", count(*) AS cnt FROM (SELECT {DOC_KEYS} FROM a GROUP BY {DOC_KEYS}
  HAVING count(*) > 1) d
UNION ALL SELECT 'initial:doc_num' AS "check", count(*) FILTER (WHERE doc_num = chr(0)) AS cnt FROM a""")
def q_check_report(spark, sf):
    a = act.activate_standard(ex.initial_state(spark, sf, "doc"), ex.inbound(spark, sf, "doc", "after"), fx.DOC)
    return chk.check_report(chk.standard_checks(a, fx.DOC))


def _orders_checks(store: Store):
    def run(staged: DataFrame) -> list[DataFrame]:
        nn = staged.agg(F.count_if(F.col("o_orderpriority").isNull()).alias("cnt"))
        return [chk.check_pk_incoming(store.read("orders_t"), staged, ["o_orderkey"]),
                nn.select(F.lit("not_null:o_orderpriority").alias("check"), F.col("cnt").cast("long"))]
    return run


@register("publish_pass", ORDERS_SQL)
def q_publish_pass(spark, sf):
    store = _orders_store(spark, sf)
    o = orders_typed(spark, sf)
    ok1, _ = publish_checked(store, "orders_t", o.where(F.col("o_orderstatus") == "F"), _orders_checks(store))
    ok2, _ = publish_checked(store, "orders_t", o.where(F.col("o_orderstatus") != "F"), _orders_checks(store))
    assert ok1 and ok2, "checks unexpectedly failed"
    return store.read("orders_t")


@register("publish_reject", f"{ORDERS_SQL} WHERE o_orderstatus = 'F'")
def q_publish_reject(spark, sf):
    store = _orders_store(spark, sf)
    o = orders_typed(spark, sf)
    ok1, _ = publish_checked(store, "orders_t", o.where(F.col("o_orderstatus") == "F"), _orders_checks(store))
    bad = o.where(F.col("o_orderstatus") != "F").withColumn(
        "o_orderpriority", F.expr("nullif(o_orderpriority, '1-URGENT')"))
    ok2, _ = publish_checked(store, "orders_t", bad, _orders_checks(store))
    assert ok1 and not ok2, "second load should have been rejected"
    return store.read("orders_t")


AS_OF = "20000101" + fx.REQ_PAD


@register("as_of_request", doc_state_sql(f"reqtsn <= '{AS_OF}'"))
def q_as_of_request(spark, sf):
    a = ex.initial_state(spark, sf, "doc")
    return as_of_request(a, ex.inbound(spark, sf, "doc", "after"), fx.DOC, AS_OF)


@register("as_of_cube", cube_sql(f"reqtsn <= '{AS_OF}'"))
def q_as_of_cube(spark, sf):
    # the history that activation keeps, replayed up to a request over the state before the delta
    root = ex.ensure_extracts(spark, sf, "cube")
    store, spec = _store(spark), dataclasses.replace(fx.CUBE, archive=True)
    base = jobs.job_cube_init(store, spec, root)
    jobs.merge12(store, spec)
    return as_of_request(base, jobs.history(store, spec), spec, AS_OF)


@register("as_of_stock", f"""SELECT CAST(NULL AS VARCHAR) AS recordmode, '2' AS recordtp, {STOCK_K}, {stock_sums()}
FROM ({fx.STOCK_INBOUND_SQL}) s WHERE reqtsn <= '{AS_OF}' GROUP BY {STOCK_K}""")
def q_as_of_stock(spark, sf):
    root = ex.ensure_extracts(spark, sf, "stock")
    store, spec = _store(spark), dataclasses.replace(fx.STOCK, archive=True)
    jobs.job_stock_init(store, spec, root)
    base = store.read(jobs.tname(spec, "2"))
    jobs.job_delta(store, spec, root)
    return as_of_request(base, jobs.history(store, spec), spec, AS_OF)


AS_OF_MANY = [d + fx.REQ_PAD for d in ("19990131", "19990704", "20000101")]


def each_request(state) -> str:
    """The states as of several requests, one below the other."""
    return "\nUNION ALL ".join(f"SELECT '{r}' AS reqtsn, s.* FROM ({state(f"reqtsn <= '{r}'")}) s" for r in AS_OF_MANY)


@register("as_of_requests", each_request(doc_state_sql))
def q_as_of_requests(spark, sf):
    a = ex.initial_state(spark, sf, "doc")
    return asof.as_of_requests(a, ex.inbound(spark, sf, "doc", "after"), fx.DOC, AS_OF_MANY)


@register("as_of_requests_cube", each_request(cube_sql))
def q_as_of_requests_cube(spark, sf):
    a = ex.initial_state(spark, sf, "cube")
    return asof.as_of_requests(a, ex.inbound(spark, sf, "cube", "after", numbered=False), fx.CUBE, AS_OF_MANY)


def stock_net(pair: tuple[str, str]) -> str:
    rec, iss = pair
    return f"sum(coalesce({rec}, 0) - coalesce({iss}, 0)) AS {rec}"


def stock_type(rec: str) -> str:
    return "DECIMAL(17,3)" if rec.endswith("bu") else "DECIMAL(17,2)"


def stock_days_sql() -> str:
    net = ", ".join(stock_net(p) for p in fx.STOCK.stock_pairs)
    out = ", ".join(f"CAST(sum({rec}) OVER (PARTITION BY {STOCK_K5} ORDER BY calday) AS {stock_type(rec)}) AS {rec}_stock"
                    for rec, _ in fx.STOCK.stock_pairs)
    return f"""SELECT {STOCK_K5}, calday, {out}
FROM (SELECT {STOCK_K5}, calday, {net} FROM ({fx.STOCK_INBOUND_SQL}) s GROUP BY {STOCK_K5}, calday) d"""


STOCK_DAYS = [datetime.date(1995, 6, 30), datetime.date(1997, 12, 31), datetime.date(2001, 1, 1)]


def stock_on_sql() -> str:
    out = ", ".join(f"CAST(coalesce(sum(coalesce({rec}, 0) - coalesce({iss}, 0)) FILTER (s.calday <= d.calday), 0) AS {stock_type(rec)}) "
                    f"AS {rec}_stock" for rec, iss in fx.STOCK.stock_pairs)
    days = ", ".join(f"(DATE '{d}')" for d in STOCK_DAYS)
    return f"""SELECT {STOCK_K5}, d.calday, {out}
FROM ({fx.STOCK_INBOUND_SQL}) s, (VALUES {days}) d(calday) GROUP BY {STOCK_K5}, d.calday"""


def _stock_tables(spark, sf) -> tuple[DataFrame, DataFrame]:
    """All movements, and the marker after the delta."""
    inbound = ex.inbound(spark, sf, "stock", "after", numbered=False)
    return (act.activate_movements(ex.initial_state(spark, sf, "stock", "2"), inbound, fx.STOCK),
            act.activate_marker(ex.initial_state(spark, sf, "stock", "5"), inbound, fx.STOCK))


@register("stock_by_day", stock_days_sql())
def q_stock_by_day(spark, sf):
    return asof.stock_by_day(*_stock_tables(spark, sf), fx.STOCK)


@register("stock_on_days", stock_on_sql())
def q_stock_on_days(spark, sf):
    return asof.stock_on_days(*_stock_tables(spark, sf), fx.STOCK, STOCK_DAYS)


# --------------------------------------------------------------------------- #
# 2.9 end-to-end jobs (extract folders -> tables)
# --------------------------------------------------------------------------- #
def _store(spark) -> Store:
    return Store(spark, work_dir(spark, "store"))


@register("job_standard_init", DOC_A_SQL)
def q_job_standard_init(spark, sf):
    root = ex.ensure_extracts(spark, sf, "doc")
    return jobs.job_standard_init(_store(spark), fx.DOC, root)


def run_standard_delta(spark, sf, store: Store | None = None) -> DataFrame:
    root = ex.ensure_extracts(spark, sf, "doc")
    store = store or _store(spark)
    jobs.job_standard_init(store, fx.DOC, root)
    return jobs.job_delta(store, fx.DOC, root)


@register("job_standard_delta", DOC_ALL_SQL)
def q_job_standard_delta(spark, sf):
    return run_standard_delta(spark, sf)


@register("job_events_delta", EVENTS_ALL_SQL)
def q_job_events_delta(spark, sf):
    root = ex.ensure_extracts(spark, sf, "events")
    store = _store(spark)
    jobs.job_standard_init(store, fx.EVENTS, root)
    return jobs.job_delta(store, fx.EVENTS, root)


def _cube_both(store: Store) -> DataFrame:
    """Tables 1 and 2 of the cube as one result (table 2 has no request)."""
    cols = ["n", "reqtsn", *fx.CUBE.columns]
    t1 = store.read(jobs.tname(fx.CUBE, "1")).withColumn("n", F.lit("1"))
    t2 = store.read(jobs.tname(fx.CUBE, "2")).withColumn("n", F.lit("2")).withColumn("reqtsn", F.lit(None).cast("string"))
    return t1.select(*cols).unionByName(t2.select(*cols))


@register("job_cube_init", f"""SELECT '1' AS n, reqtsn, {CUBE_K}, quant_b, value_lc
FROM ({fx.CUBE_INBOUND_SQL}) s WHERE calday >= {CUT_D}
UNION ALL SELECT '2' AS n, CAST(NULL AS VARCHAR) AS reqtsn, {CUBE_K}, quant_b, value_lc FROM ({CUBE_A_SQL}) a""")
def q_job_cube_init(spark, sf):
    root = ex.ensure_extracts(spark, sf, "cube")
    store = _store(spark)
    jobs.job_cube_init(store, fx.CUBE, root)  # t1 -> 1, t2 -> 2
    return _cube_both(store)


@register("job_cube_delta", CUBE_ALL_SQL)
def q_job_cube_delta(spark, sf):
    root = ex.ensure_extracts(spark, sf, "cube")
    store = _store(spark)
    jobs.job_cube_init(store, fx.CUBE, root)
    jobs.merge12(store, fx.CUBE)
    jobs.job_delta(store, fx.CUBE, root)  # no new files: a rerun changes nothing
    return store.read(jobs.tname(fx.CUBE, "2"))


@register("job_cube_reload", CUBE_ALL_SQL)
def q_job_cube_reload(spark, sf):
    # table 2 is emptied and everything loaded again: nothing counts as absorbed any more
    root = ex.ensure_extracts(spark, sf, "cube")
    store = _store(spark)
    jobs.job_cube_init(store, fx.CUBE, root)
    jobs.merge12(store, fx.CUBE)
    jobs.delete(store, fx.CUBE, "2")
    jobs.create(store, fx.CUBE, "1")
    ledger.ledger_reset(store, fx.CUBE.name, "2")
    jobs.insert(store, fx.CUBE, "2", root)
    return jobs.job_delta(store, fx.CUBE, root)


@register("job_delta_split_requests", DOC_ALL_SQL)
def q_job_delta_split_requests(spark, sf):
    # the delta arrives in two loads, cut in the middle of a request's package
    base = ex.ensure_extracts(spark, sf, "doc")
    root = work_dir(spark, "split_extract")
    delta = files.read_source(spark, "orc", [r["file"] for r in files.source_files(spark, base, "1").collect()])
    store = _store(spark)
    jobs.job_standard_init(store, fx.DOC, base)
    early = (F.col("reqtsn") < AS_OF) | (F.col("reqtsn") == AS_OF) & (F.col("record") <= 5)
    for part, rows in enumerate((delta.where(early), delta.where(~early))):
        rows.write.orc(f"{root}/t1/p{part}")
        out = jobs.job_delta(store, fx.DOC, root)
    return out


@register("job_standard_checked", doc_state_sql(f"pstng_date < {CUT_D} OR linestatus = 'O'"))
def q_job_standard_checked(spark, sf):
    # audited loads: a batch without its document numbers is rejected and leaves table and ledger alone
    base = ex.ensure_extracts(spark, sf, "doc")
    root = work_dir(spark, "checked_extract")
    spec = dataclasses.replace(fx.DOC, safe_dml=True, checks=(Check("not_null"), Check("pk"), Check("initial", "doc_num")))
    delta = files.read_source(spark, "orc", [r["file"] for r in files.source_files(spark, base, "1").collect()])
    store = _store(spark)
    jobs.job_standard_init(store, spec, base)
    delta.where("linestatus = 'O'").write.orc(f"{root}/t1/good")
    jobs.insert(store, spec, "1", root)
    delta.where("linestatus <> 'O'").withColumn("doc_num", F.lit(None).cast("string")).write.orc(f"{root}/t1/bad")
    try:
        jobs.job_delta(store, spec, root)
    except jobs.LoadRejected:
        pass
    else:
        raise AssertionError("the load without document numbers should have been rejected")
    jobs.merge12(store, spec)
    return store.read(jobs.tname(spec, "2"))


@register("job_stock_delta", f"""SELECT '5' AS n, {STOCK_OUT} FROM ({MARKER_SQL}) m
UNION ALL SELECT '2' AS n, {STOCK_OUT} FROM ({MOVEMENTS_SQL}) v""")
def q_job_stock_delta(spark, sf):
    root = ex.ensure_extracts(spark, sf, "stock")
    store = _store(spark)
    jobs.job_stock_init(store, fx.STOCK, root)
    jobs.job_delta(store, fx.STOCK, root)
    t2, t5 = (store.read(jobs.tname(fx.STOCK, n)).withColumn("n", F.lit(n)) for n in ("2", "5"))
    return t2.unionByName(t5)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_activate_standard(spark, sf_dir)


@register("intake_quarantine", """
WITH src AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_totalprice AS DECIMAL(17,2)) END AS o_totalprice,
    concat_ws('; ', CASE WHEN o_orderkey % 17 = 0 THEN 'o_custkey: null' END,
      CASE WHEN o_orderkey % 7 = 0 THEN 'o_orderdate: bad value' END,
      CASE WHEN o_orderkey % 11 = 0 THEN 'o_totalprice: bad value' END) AS reason
  FROM orders WHERE o_orderstatus <> 'P')
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, reason, CASE WHEN reason = '' THEN o_custkey END AS o_custkey,
  CASE WHEN reason = '' THEN o_orderdate END AS o_orderdate, CASE WHEN reason = '' THEN o_totalprice END AS o_totalprice
FROM src""")
def q_intake_quarantine(spark, sf):
    """Every order is delivered as CSV; bad dates, bad prices and missing customers are turned away with
    their reasons and everything else is loaded."""
    root = work_dir(spark, "quarantine")
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", F.expr("if(o_orderkey % 17 = 0, null, o_custkey)").alias("o_custkey"),
        F.expr("if(o_orderkey % 7 = 0, '20201345', date_format(o_orderdate, 'yyyyMMdd'))").alias("o_orderdate"),
        F.expr("if(o_orderkey % 11 = 0, 'n/a', cast(o_totalprice as string))").alias("o_totalprice"), "o_orderstatus")
    o.write.csv(f"{root}/t2", header=True)
    spec = EntitySpec(
        name="orders_q", kind="standard", srcformat="csv", quarantine=True, keys=("o_orderkey",),
        ddl="o_orderkey BIGINT NOT NULL, o_custkey BIGINT NOT NULL, o_orderdate DATE, o_totalprice DECIMAL(17,2)",
        mapping=(("o_orderdate", "to_date(o_orderdate, 'yyyyMMdd')"),), where="o_orderstatus <> 'P'")
    store = Store(spark, work_dir(spark, "store"))
    jobs.create(store, spec, "2")
    jobs.insert(store, spec, "2", root)
    loaded = store.read(jobs.tname(spec, "2"))
    away = jobs.rejects(store, spec).select(F.get_json_object("raw", "$.o_orderkey").alias("o_orderkey"), "reason")
    return (loaded.withColumn("o_orderkey", F.col("o_orderkey").cast("string")).withColumn("reason", F.lit(""))
            .unionByName(away, allowMissingColumns=True))
