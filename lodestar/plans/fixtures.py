"""Entity specs and staging extracts derived from the driver's test tables.

Every extract is computed by Spark from the given tables (so its size grows
with them); the matching DuckDB SQL for the correctness oracle sits next to
each builder.  Roles:

* ``doc``    standard entity over lineitem, key (doc_num, doc_item)
* ``events`` standard entity over events, key (user_id, event_type)
* ``cube``   cube over lineitem, key (material, vendor)
* ``stock``  non-cumulative stock over lineitem: R = issue, N/A = receipt
* ``cust``   master data: customer x nation x region, with attribute texts
* ``matl``   material master over part
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.sequence import sequence_within
from lodestar.spec import Attribute, EntitySpec

# Fixed values of the fixtures: the activation cut and the batch cuts of the delta.
CUT = "1999-01-01"
BATCH_CUTS = ("2000-01-01", "2001-01-01")
EVENTS_CUT = "2024-01-15"
REQ_PAD = "0" * 15  # reqtsn = yyyyMMdd + 15 zeros = 23 chars
PACKAGE = "000001"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------- #
# specs
# --------------------------------------------------------------------------- #
def _init(c: str) -> str:
    return f"ifnull(`{c}`, chr(0))"


DOC = EntitySpec(
    name="doc",
    kind="standard",
    ddl=(
        "recordmode STRING, doc_num STRING NOT NULL, doc_item STRING NOT NULL, material STRING NOT NULL, "
        "vendor STRING NOT NULL, pstng_date DATE, quant_b DECIMAL(17,3), value_lc DECIMAL(17,2), "
        "discount DECIMAL(17,2), linestatus STRING NOT NULL"
    ),
    mapping=(
        ("recordmode", "recordmode"),
        ("doc_num", _init("doc_num")),
        ("doc_item", _init("doc_item")),
        ("material", _init("material")),
        ("vendor", _init("vendor")),
        ("pstng_date", "to_date(pstng_date, 'yyyyMMdd')"),
        ("quant_b", "CAST(quant_b AS DECIMAL(17,3))"),
        ("value_lc", "CAST(value_lc AS DECIMAL(17,2))"),
        ("discount", "CAST(discount AS DECIMAL(17,2))"),
        ("linestatus", _init("linestatus")),
    ),
    keys=("doc_num", "doc_item"),
    partition_date="pstng_date",
    srcformat="orc",
)

EVENTS = EntitySpec(
    name="event",
    kind="standard",
    ddl=(
        "recordmode STRING, user_id STRING NOT NULL, event_type STRING NOT NULL, ev_date DATE, "
        "value DECIMAL(17,2), props STRING NOT NULL"
    ),
    mapping=(
        ("recordmode", "recordmode"),
        ("user_id", _init("user_id")),
        ("event_type", _init("event_type")),
        ("ev_date", "to_date(ev_date, 'yyyyMMdd')"),
        ("value", "CAST(value AS DECIMAL(17,2))"),
        ("props", _init("props")),
    ),
    keys=("user_id", "event_type"),
    buckets=8,  # table 2 bucketed on the key
    srcformat="parquet",
)

CUBE = EntitySpec(
    name="cube",
    kind="cube",
    ddl=("calday DATE NOT NULL, material STRING NOT NULL, vendor STRING NOT NULL, "
         "quant_b DECIMAL(17,3), value_lc DECIMAL(17,2)"),
    mapping=(
        ("calday", "to_date(calday, 'yyyyMMdd')"),
        ("material", _init("material")),
        ("vendor", _init("vendor")),
        ("quant_b", "CAST(quant_b AS DECIMAL(17,3))"),
        ("value_lc", "CAST(value_lc AS DECIMAL(17,2))"),
    ),
    keys=("calday", "material", "vendor"),
    figures=("quant_b", "value_lc"),
    partition_date="calday",  # the day is in the key: a delta touches its own months only
    srcformat="parquet",
)

# Declared schema of the stock entity.
STOCK_FIGS = ("altstrepv", "altstispv", "cptstrepv", "cptstispv", "cptstrebu", "cptstisbu")
STOCK = EntitySpec(
    name="stock",
    kind="ncum",
    ddl=(
        "recordmode STRING, recordtp STRING, calday DATE NOT NULL, base_uom STRING NOT NULL, "
        "loc_currcy STRING NOT NULL, plant STRING NOT NULL, material STRING NOT NULL, "
        "stor_loc STRING NOT NULL, valspecst STRING NOT NULL, cptstisbu DECIMAL(17,3), "
        "cptstispv DECIMAL(17,2), cptstrebu DECIMAL(17,3), cptstrepv DECIMAL(17,2), "
        "altstispv DECIMAL(17,2), altstrepv DECIMAL(17,2)"
    ),
    mapping=(
        ("recordmode", "recordmode"),
        ("recordtp", _init("recordtp")),
        ("calday", "to_date(calday, 'yyyyMMdd')"),
        ("base_uom", _init("base_uom")),
        ("loc_currcy", _init("loc_currcy")),
        ("plant", _init("plant")),
        ("material", _init("material")),
        ("stor_loc", _init("stor_loc")),
        ("valspecst", _init("valspecst")),
        ("cptstisbu", "CAST(cptstisbu AS DECIMAL(17,3))"),
        ("cptstispv", "CAST(cptstispv AS DECIMAL(17,2))"),
        ("cptstrebu", "CAST(cptstrebu AS DECIMAL(17,3))"),
        ("cptstrepv", "CAST(cptstrepv AS DECIMAL(17,2))"),
        ("altstispv", "CAST(altstispv AS DECIMAL(17,2))"),
        ("altstrepv", "CAST(altstrepv AS DECIMAL(17,2))"),
    ),
    keys=("calday", "base_uom", "loc_currcy", "material", "plant", "stor_loc", "valspecst"),
    figures=STOCK_FIGS,
    stock_pairs=(("altstrepv", "altstispv"), ("cptstrebu", "cptstisbu"), ("cptstrepv", "cptstispv")),
    partition_date="calday",
    srcformat="orc",
)

CUST = EntitySpec(
    name="customer",
    kind="master",
    ddl=(
        "customer STRING NOT NULL, customer_txt STRING, country STRING NOT NULL, region STRING NOT NULL, "
        "segment STRING NOT NULL, acctbal DECIMAL(17,2)"
    ),
    mapping=(
        ("customer", "`0customer`"),
        ("customer_txt", "`0customer___txtlg`"),
        ("country", "`0country`"),
        ("region", "`0region`"),
        ("segment", "`0segment`"),
        ("acctbal", "`0acctbal`"),
    ),
    keys=("customer",),
    where="(`0segment` <> 'HOUSEHOLD')",
    order="1",
    attributes=(
        Attribute("country", "`0country`", "`0country___t`"),
        Attribute("region", "`0region`", "`0region___t`"),
        Attribute("segment", "`0segment`", "`0segment___t`"),
    ),
    srcformat="parquet",
    loadmanytimes=True,
)

MATL = EntitySpec(
    name="material",
    kind="master",
    ddl=("material STRING NOT NULL, material_txt STRING, matl_group STRING NOT NULL, matl_type STRING NOT NULL, "
         "base_uom STRING NOT NULL, size INT"),
    mapping=(
        ("material", "`0material`"),
        ("material_txt", "`0material___txtlg`"),
        ("matl_group", "`0matl_group`"),
        ("matl_type", "`0matl_type`"),
        ("base_uom", "`0base_uom`"),
        ("size", "`0size`"),
    ),
    keys=("material",),
    where="(`0base_uom` <> '')",
    order="1",
    attributes=(
        Attribute("matl_group", "`0matl_group`", "`0matl_group___t`"),
        Attribute("matl_type", "`0matl_type`", "`0matl_type___t`"),
    ),
)


# --------------------------------------------------------------------------- #
# staging extracts (Spark) and their DuckDB twins
# --------------------------------------------------------------------------- #
def _reqtsn_day(ts_col: str):
    return F.concat(F.date_format(F.col(ts_col), "yyyyMMdd"), F.lit(REQ_PAD))


def _day_of_request():
    """The day as text, as it stands in front of the request."""
    return F.expr(f"left(reqtsn, length(reqtsn) - {len(REQ_PAD)})")


def lineitem_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with request fields: one request per ship day, records numbered
    within the day in a fixed total order (skew-safe numbering).  Only the columns that a
    staging takes are sorted and kept."""
    li = table(spark, sf_dir, "lineitem").withColumn("reqtsn", _reqtsn_day("l_shipdate")).drop("l_tax", "l_shipdate")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    li = sequence_within(li, ["reqtsn"], order, name="record")
    return li.withColumn("datapakid", F.lit(PACKAGE))


def lineitem_unnumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows where no result uses ``record``: no sort, no copy, a plain scan."""
    return table(spark, sf_dir, "lineitem").select(
        "*", _reqtsn_day("l_shipdate").alias("reqtsn"), F.lit(1).alias("record"), F.lit(PACKAGE).alias("datapakid"))


LINEITEM_REQ_SQL = f"""
SELECT *, strftime(l_shipdate, '%Y%m%d') || '{REQ_PAD}' AS reqtsn, '{PACKAGE}' AS datapakid,
  CAST(row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE)
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INTEGER) AS record
FROM lineitem"""


def doc_staging(li_req: DataFrame) -> DataFrame:
    """Goods-document extract rows as the source system delivers them."""
    return li_req.select(
        "reqtsn",
        "datapakid",
        "record",
        F.when(F.col("l_returnflag") == "R", "D").when(F.col("l_returnflag") == "N", "N").alias("recordmode"),
        F.col("l_orderkey").cast("string").alias("doc_num"),
        F.col("l_linenumber").cast("string").alias("doc_item"),
        F.col("l_partkey").cast("string").alias("material"),
        F.col("l_suppkey").cast("string").alias("vendor"),
        _day_of_request().alias("pstng_date"),
        F.col("l_quantity").alias("quant_b"),
        F.col("l_extendedprice").alias("value_lc"),
        F.col("l_discount").alias("discount"),
        F.col("l_linestatus").alias("linestatus"),
    )


DOC_STAGING_SQL = f"""
SELECT reqtsn, datapakid, record,
  CASE l_returnflag WHEN 'R' THEN 'D' WHEN 'N' THEN 'N' END AS recordmode,
  CAST(l_orderkey AS VARCHAR) AS doc_num, CAST(l_linenumber AS VARCHAR) AS doc_item,
  CAST(l_partkey AS VARCHAR) AS material, CAST(l_suppkey AS VARCHAR) AS vendor,
  strftime(l_shipdate, '%Y%m%d') AS pstng_date, l_quantity AS quant_b, l_extendedprice AS value_lc,
  l_discount AS discount, l_linestatus AS linestatus
FROM ({LINEITEM_REQ_SQL}) li"""

# inbound table 1 of the doc entity, typed (PRJ1 + PRJ2)
DOC_INBOUND_SQL = f"""
SELECT reqtsn, datapakid, record, recordmode,
  coalesce(doc_num, chr(0)) AS doc_num, coalesce(doc_item, chr(0)) AS doc_item,
  coalesce(material, chr(0)) AS material, coalesce(vendor, chr(0)) AS vendor,
  CAST(strptime(pstng_date, '%Y%m%d') AS DATE) AS pstng_date,
  CAST(quant_b AS DECIMAL(17,3)) AS quant_b, CAST(value_lc AS DECIMAL(17,2)) AS value_lc,
  CAST(discount AS DECIMAL(17,2)) AS discount, coalesce(linestatus, chr(0)) AS linestatus
FROM ({DOC_STAGING_SQL}) s"""


def events_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second standard extract: events; identity from the event time, record = event_id."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.date_format("ts", "yyyyMMddHHmmssSSSSSS"), F.lit("000")).alias("reqtsn"),
        F.lit(PACKAGE).alias("datapakid"),
        F.col("event_id").cast("int").alias("record"),
        F.when(F.col("event_type") == "error", "D").alias("recordmode"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type"),
        F.date_format("ts", "yyyyMMdd").alias("ev_date"),
        F.col("value"),
        F.col("props"),
    )


EVENTS_INBOUND_SQL = f"""
SELECT strftime(ts, '%Y%m%d%H%M%S%f') || '000' AS reqtsn, '{PACKAGE}' AS datapakid,
  CAST(event_id AS INTEGER) AS record,
  CASE WHEN event_type = 'error' THEN 'D' END AS recordmode,
  coalesce(CAST(user_id AS VARCHAR), chr(0)) AS user_id, coalesce(event_type, chr(0)) AS event_type,
  CAST(ts AS DATE) AS ev_date, CAST(value AS DECIMAL(17,2)) AS value, coalesce(props, chr(0)) AS props
FROM events"""


def cube_staging(li_req: DataFrame) -> DataFrame:
    return li_req.select(
        "reqtsn",
        "datapakid",
        "record",
        _day_of_request().alias("calday"),
        F.col("l_partkey").cast("string").alias("material"),
        F.col("l_suppkey").cast("string").alias("vendor"),
        F.col("l_quantity").alias("quant_b"),
        F.col("l_extendedprice").alias("value_lc"),
    )


CUBE_INBOUND_SQL = f"""
SELECT reqtsn, datapakid, record, CAST(l_shipdate AS DATE) AS calday, CAST(l_partkey AS VARCHAR) AS material,
  CAST(l_suppkey AS VARCHAR) AS vendor, CAST(l_quantity AS DECIMAL(17,3)) AS quant_b,
  CAST(l_extendedprice AS DECIMAL(17,2)) AS value_lc
FROM ({LINEITEM_REQ_SQL}) li"""


def stock_staging(li_req: DataFrame) -> DataFrame:
    issue = F.col("l_returnflag") == "R"
    rec = lambda c: F.when(~issue, c)
    iss = lambda c: F.when(issue, c)
    alt = F.col("l_extendedprice") * F.lit(2.0)
    return li_req.select(
        "reqtsn",
        "datapakid",
        "record",
        F.lit(None).cast("string").alias("recordmode"),
        F.lit(None).cast("string").alias("recordtp"),
        _day_of_request().alias("calday"),
        F.lit("PC").alias("base_uom"),
        F.lit("USD").alias("loc_currcy"),
        F.lit("1000").alias("plant"),
        F.col("l_partkey").cast("string").alias("material"),
        F.lit("0001").alias("stor_loc"),
        F.lit(None).cast("string").alias("valspecst"),
        iss(F.col("l_quantity")).alias("cptstisbu"),
        iss(F.col("l_extendedprice")).alias("cptstispv"),
        rec(F.col("l_quantity")).alias("cptstrebu"),
        rec(F.col("l_extendedprice")).alias("cptstrepv"),
        iss(alt).alias("altstispv"),
        rec(alt).alias("altstrepv"),
    )


STOCK_INBOUND_SQL = f"""
SELECT reqtsn, datapakid, record, CAST(NULL AS VARCHAR) AS recordmode, chr(0) AS recordtp,
  CAST(l_shipdate AS DATE) AS calday, 'PC' AS base_uom, 'USD' AS loc_currcy, '1000' AS plant,
  CAST(l_partkey AS VARCHAR) AS material, '0001' AS stor_loc, chr(0) AS valspecst,
  CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity END AS DECIMAL(17,3)) AS cptstisbu,
  CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS DECIMAL(17,2)) AS cptstispv,
  CAST(CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS DECIMAL(17,3)) AS cptstrebu,
  CAST(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS DECIMAL(17,2)) AS cptstrepv,
  CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * 2.0 END AS DECIMAL(17,2)) AS altstispv,
  CAST(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice * 2.0 END AS DECIMAL(17,2)) AS altstrepv
FROM ({LINEITEM_REQ_SQL}) li"""


def customer_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide master-data staging with code/text pairs and BW-style names."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    w = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return w.select(
        F.col("c_custkey").cast("string").alias("0customer"),
        F.col("c_name").alias("0customer___txtlg"),
        F.col("n_nationkey").cast("string").alias("0country"),
        F.col("n_name").alias("0country___t"),
        F.col("r_regionkey").cast("string").alias("0region"),
        F.col("r_name").alias("0region___t"),
        F.col("c_mktsegment").alias("0segment"),
        F.initcap(F.lower(F.col("c_mktsegment"))).alias("0segment___t"),
        F.col("c_acctbal").alias("0acctbal"),
    )


CUSTOMER_STAGING_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS "0customer", c_name AS "0customer___txtlg",
  CAST(n_nationkey AS VARCHAR) AS "0country", n_name AS "0country___t",
  CAST(r_regionkey AS VARCHAR) AS "0region", r_name AS "0region___t",
  c_mktsegment AS "0segment", upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS "0segment___t",
  c_acctbal AS "0acctbal"
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def material_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Material master staging over part: 18-digit material number, group and
    type codes with their texts, and no base unit for the largest parts."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.lpad(F.col("p_partkey").cast("string"), 18, "0").alias("0material"),
        F.col("p_name").alias("0material___txtlg"),
        F.col("p_brand").alias("0matl_group"),
        F.regexp_replace(F.col("p_brand"), "#", " no. ").alias("0matl_group___t"),
        F.upper(F.substring(F.col("p_type"), 1, 3)).alias("0matl_type"),
        F.initcap(F.lower(F.col("p_type"))).alias("0matl_type___t"),
        F.when(F.col("p_size") > 45, F.lit("")).otherwise(F.lit("PC")).alias("0base_uom"),
        F.col("p_size").alias("0size"),
    )


MATERIAL_STAGING_SQL = """
SELECT lpad(CAST(p_partkey AS VARCHAR), 18, '0') AS "0material", p_name AS "0material___txtlg",
  p_brand AS "0matl_group", replace(p_brand, '#', ' no. ') AS "0matl_group___t",
  upper(substr(p_type, 1, 3)) AS "0matl_type",
  upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS "0matl_type___t",
  CASE WHEN p_size > 45 THEN '' ELSE 'PC' END AS "0base_uom", p_size AS "0size"
FROM part"""
