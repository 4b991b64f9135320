"""The domain tables as views over the test tables, in Spark and as SQL text.

``SQL`` holds the same definitions for an independent engine; a query's check is
its SQL text after ``WITH`` and the views it names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.functions.predicates import DATE_KEY, TIME_KEY


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str):
    return F.col(column).cast("string")


def _text_of(number, width: int = 2):
    return F.lpad(number.cast("string"), width, "0")


def _vendor(key: str):
    k = F.pmod(F.col(key), F.lit(3))
    return F.when(k == 0, "SAMSUNG").when(k == 1, "ERICSSON").otherwise("NOKIA")


def cdr_of(events: DataFrame) -> DataFrame:
    """Call records from an events frame, batch or stream."""
    return events.select(
        _text("event_id").alias("sgi_id"),
        _text("user_id").alias("cell_id"),
        F.get_json_object("props", "$.k").alias("alt_cell_id"),
        F.date_format("ts", TIME_KEY).alias("rqt_st_dt"),
        F.date_format("ts", DATE_KEY).alias("etl_date"),
        F.date_format("ts", DATE_KEY).alias("base_date"),
        F.floor(F.col("value") * 100).cast("long").alias("val"),
        F.when(F.col("event_type") == "click", "S1AP")
        .when(F.col("event_type") == "view", "SGI")
        .otherwise(F.col("event_type"))
        .alias("signal_type"),
        F.when(F.col("event_id") % 2 == 0, "Y").otherwise("N").alias("use_flag"),
        _text("user_id").alias("subscriber_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdr_of(_read(spark, sf_dir, "events"))


def mdt_raw_of(events: DataFrame) -> DataFrame:
    """Raw measurements from an events frame, batch or stream."""
    return events.select(
        _text("event_id").alias("mdt_id"),
        (F.col("value") * 1000).alias("gnss_utmkx"),
        (F.col("value") * 2000).alias("gnss_utmky"),
        F.date_format("ts", TIME_KEY).alias("rqt_st_dt"),
        _vendor("user_id").alias("bts_market_nm"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def mdt_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mdt_raw_of(_read(spark, sf_dir, "events"))


def _line(x: str, y: str, dx: str, dy: str):
    """POINT for every fourth key, else a LINESTRING of two legs."""
    return F.expr(
        f"CASE WHEN s_suppkey % 4 = 0 THEN concat('POINT(', {x}, ' ', {y}, ')')"
        f" ELSE concat('LINESTRING(', {x}, ' ', {y}, ', ', {x} + {dx}, ' ', {y} + {dy},"
        f" ', ', {x} + {dx}, ' ', {y} + 2 * {dy}, ')') END"
    )


def bts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation and region have a fixed number of rows
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    return (
        _read(spark, sf_dir, "supplier")
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _text("s_suppkey").alias("cell_id"),
            # four stations share an alternate cell, at any scale
            F.floor(F.col("s_suppkey") / 4).cast("string").alias("alt_cell_id"),
            F.col("s_name").alias("bts_alt_key"),
            _vendor("s_suppkey").alias("bts_market_nm"),
            (F.col("s_acctbal") / 100).alias("lat"),
            (F.col("s_acctbal") / 50).alias("lon"),
            F.col("r_name").alias("region_cd"),
            _line("s_suppkey * 20", "s_suppkey * 10", "30", "40").alias("rpot_geom"),
            (F.col("s_suppkey") % 20 + 1).cast("int").alias("rpot_line_cnt"),
        )
    )


def rpot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("rpot_seq"),
        _line("(s_suppkey * 37) % 1000", "s_suppkey * 10", "45", "-25").alias("rpot_geom"),
        (F.col("s_suppkey") % 20 + 1).cast("int").alias("rpot_line_cnt"),
        _vendor("s_suppkey").alias("bts_market_nm"),
    )


def mdt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("mdt_id"),
        F.col("l_partkey").cast("double").alias("gnss_utmkx"),
        (F.col("l_suppkey") * 10).cast("double").alias("gnss_utmky"),
        F.concat_ws("_", F.col("l_suppkey") % 5, F.col("l_suppkey") % 25).alias("gnss_metric_id"),
        _vendor("l_suppkey").alias("bts_market_nm"),
        F.when(F.col("l_returnflag") == "R", "PERIODIC").when(F.col("l_returnflag") == "A", "").alias("trigr_ev"),
        F.col("l_linestatus").alias("hndset_pet_nm"),
        F.when(F.col("l_linenumber") == 1, "1550")
        .when(F.col("l_linenumber") == 2, "1650")
        .when(F.col("l_linenumber") == 3, "1694")
        .when(F.col("l_linenumber") == 4, "1700")
        .otherwise("2600")
        .alias("dlearfcn_cd"),
        (-60 - F.col("l_quantity")).cast("int").alias("rsrp"),
        F.date_format("l_shipdate", DATE_KEY).alias("base_date"),
        F.date_format("l_shipdate", DATE_KEY).alias("etl_date"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )


def gpot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("gpot25_x"),
        F.col("n_nationkey").alias("gpot25_y"),
        _text("n_nationkey").alias("bdri_cd"),
    )


def bdri(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        _text("n_nationkey").alias("bdri_cd"),
        F.col("r_name").alias("sido_name"),
        F.concat(F.lit("G"), _text("n_regionkey")).alias("gungu_name"),
        F.col("n_name").alias("bemd_name"),
        F.concat(F.lit("B"), _text("n_nationkey")).alias("bdri_name"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("l_shipdate", DATE_KEY)
    hour, minute = _text_of(F.col("l_suppkey") % 24), _text_of(F.col("l_partkey") % 60)
    clock = F.concat(hour, minute, _text_of(F.col("l_linenumber")))
    return _read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("call_id"),
        _text("l_orderkey").alias("contract_id"),
        _text("l_partkey").alias("product_id"),
        F.concat(day, clock).alias("call_start_dt"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("drop_flag"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("volte_flag"),
        day.alias("base_date"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("contract_id"),
        _text("o_custkey").alias("subscriber_id"),
        F.col("o_orderpriority").alias("plan_type"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"), "Y").otherwise("N").alias("volte_eligible"),
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        F.format_string("LOOKUP_KEY_%05d", "o_orderkey").alias("lookup_key"),
        F.format_string("CALL_%05d", "o_custkey").alias("call_id"),
        (-60 - F.col("o_orderkey") % 60).cast("int").alias("rsrp"),
        (-(F.col("o_orderkey") % 20)).cast("int").alias("rsrq"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("drop_flag"),
        F.date_format("o_orderdate", DATE_KEY).alias("base_date"),
        F.concat(F.lit('{"priority":"'), "o_orderpriority", F.lit('"}')).alias("detail_json"),
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timings_of(_read(spark, sf_dir, "events"))


def timings_of(events: DataFrame) -> DataFrame:
    """Response times from an events frame, batch or stream: purchases play failed runs (-1)."""
    return events.select(
        F.when(F.col("user_id") % 2 == 0, "bucketed").otherwise("partitioned").alias("engine"),
        F.when(F.col("event_type") == "purchase", -1.0).otherwise(F.col("value")).alias("elapsed_sec"),
        F.col("ts").cast("timestamp").alias("started_at"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").alias("query_id"),
        F.col("event_type").alias("stmt"),
        F.col("ts").cast("timestamp").alias("start_time"),
        F.floor(F.col("value") * 1000).cast("long").alias("duration_ms"),
    )


def station_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated station snapshots: every signup event changes the station of its cell."""
    return (
        _read(spark, sf_dir, "events")
        .where(F.col("event_type") == "signup")
        .select(
            _text("user_id").alias("cell_id"),
            F.concat(F.lit("BTS_"), _text("event_id")).alias("bts_alt_key"),
            F.get_json_object("props", "$.k").alias("region_cd"),
            F.col("ts").cast("timestamp").alias("valid_from"),
        )
    )


def quality_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nightly change set for ``quality``: several changes per key, some keys new."""
    return _read(spark, sf_dir, "lineitem").select(
        F.format_string("LOOKUP_KEY_%05d", F.col("l_orderkey") + F.col("l_linenumber") * 1000).alias("lookup_key"),
        F.format_string("CALL_%05d", "l_partkey").alias("call_id"),
        (-60 - F.col("l_quantity")).cast("int").alias("rsrp"),
        (-(F.col("l_suppkey") % 20)).cast("int").alias("rsrq"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("drop_flag"),
        F.date_format("l_shipdate", DATE_KEY).alias("base_date"),
        F.concat(F.lit('{"line":'), _text("l_linenumber"), F.lit("}")).alias("detail_json"),
    )


_VENDOR = "CASE WHEN {k} % 3 = 0 THEN 'SAMSUNG' WHEN {k} % 3 = 1 THEN 'ERICSSON' ELSE 'NOKIA' END"

SQL: dict[str, str] = {
    "cdr": """
        SELECT CAST(event_id AS VARCHAR) AS sgi_id, CAST(user_id AS VARCHAR) AS cell_id,
               json_extract_string(props, '$.k') AS alt_cell_id,
               strftime(ts, '%Y%m%d%H%M%S') AS rqt_st_dt, strftime(ts, '%Y%m%d') AS etl_date,
               strftime(ts, '%Y%m%d') AS base_date, CAST(floor(value * 100) AS BIGINT) AS val,
               CASE event_type WHEN 'click' THEN 'S1AP' WHEN 'view' THEN 'SGI' ELSE event_type END AS signal_type,
               CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END AS use_flag,
               CAST(user_id AS VARCHAR) AS subscriber_id, ts AS event_time
        FROM events""",
    "mdt_raw": f"""
        SELECT CAST(event_id AS VARCHAR) AS mdt_id, strftime(ts, '%Y%m%d%H%M%S') AS rqt_st_dt,
               {_VENDOR.format(k="user_id")} AS bts_market_nm, ts AS event_time
        FROM events""",
    "bts": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS cell_id, CAST(s_suppkey // 4 AS VARCHAR) AS alt_cell_id,
               s_name AS bts_alt_key, {_VENDOR.format(k="s_suppkey")} AS bts_market_nm, r_name AS region_cd,
               s_suppkey * 20.0::DOUBLE AS gx, s_suppkey * 10.0::DOUBLE AS gy, 30.0::DOUBLE AS dx,
               40.0::DOUBLE AS dy, s_suppkey % 4 = 0 AS is_point
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "rpot": f"""
        SELECT s_suppkey AS rpot_seq, {_VENDOR.format(k="s_suppkey")} AS bts_market_nm,
               CAST(s_suppkey % 20 + 1 AS INTEGER) AS rpot_line_cnt,
               ((s_suppkey * 37) % 1000)::DOUBLE AS gx, s_suppkey * 10.0::DOUBLE AS gy, 45.0::DOUBLE AS dx,
               -25.0::DOUBLE AS dy, s_suppkey % 4 = 0 AS is_point
        FROM supplier""",
    "mdt": f"""
        SELECT concat(l_orderkey, '-', l_linenumber) AS mdt_id, l_partkey::DOUBLE AS gnss_utmkx,
               (l_suppkey * 10)::DOUBLE AS gnss_utmky,
               concat(l_suppkey % 5, '_', l_suppkey % 25) AS gnss_metric_id,
               {_VENDOR.format(k="l_suppkey")} AS bts_market_nm,
               CASE l_returnflag WHEN 'R' THEN 'PERIODIC' WHEN 'A' THEN '' END AS trigr_ev,
               CASE l_linenumber WHEN 1 THEN '1550' WHEN 2 THEN '1650' WHEN 3 THEN '1694'
                    WHEN 4 THEN '1700' ELSE '2600' END AS dlearfcn_cd,
               CAST(-60 - l_quantity AS INTEGER) AS rsrp, strftime(l_shipdate, '%Y%m%d') AS base_date,
               l_shipdate AS event_time
        FROM lineitem""",
    "gpot": """
        SELECT n_regionkey AS gpot25_x, n_nationkey AS gpot25_y, CAST(n_nationkey AS VARCHAR) AS bdri_cd
        FROM nation""",
    "bdri": """
        SELECT CAST(n_nationkey AS VARCHAR) AS bdri_cd, r_name AS sido_name, concat('G', n_regionkey) AS gungu_name,
               n_name AS bemd_name, concat('B', n_nationkey) AS bdri_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "calls": """
        SELECT CAST(l_orderkey AS VARCHAR) AS contract_id, CAST(l_partkey AS VARCHAR) AS product_id,
               l_shipdate + to_hours(CAST(l_suppkey % 24 AS INTEGER))
                          + to_minutes(CAST(l_partkey % 60 AS INTEGER))
                          + to_seconds(CAST(l_linenumber AS INTEGER)) AS started,
               CASE l_returnflag WHEN 'R' THEN 'Y' ELSE 'N' END AS drop_flag,
               CASE l_linestatus WHEN 'O' THEN 'Y' ELSE 'N' END AS volte_flag,
               strftime(l_shipdate, '%Y%m%d') AS base_date
        FROM lineitem""",
    "contracts": "SELECT CAST(o_orderkey AS VARCHAR) AS contract_id FROM orders",
    "products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Y' ELSE 'N' END AS volte_eligible
        FROM part""",
    "quality": """
        SELECT concat('LOOKUP_KEY_', CASE WHEN o_orderkey < 100000 THEN lpad(CAST(o_orderkey AS VARCHAR), 5, '0')
                                          ELSE CAST(o_orderkey AS VARCHAR) END) AS lookup_key,
               concat('CALL_', CASE WHEN o_custkey < 100000 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0')
                                    ELSE CAST(o_custkey AS VARCHAR) END) AS call_id,
               CAST(-60 - o_orderkey % 60 AS INTEGER) AS rsrp, CAST(-(o_orderkey % 20) AS INTEGER) AS rsrq,
               CASE o_orderstatus WHEN 'F' THEN 'Y' ELSE 'N' END AS drop_flag,
               strftime(o_orderdate, '%Y%m%d') AS base_date,
               concat('{"priority":"', o_orderpriority, '"}') AS detail_json
        FROM orders""",
    "quality_changes": """
        SELECT concat('LOOKUP_KEY_', CASE WHEN l_orderkey + l_linenumber * 1000 < 100000
                      THEN lpad(CAST(l_orderkey + l_linenumber * 1000 AS VARCHAR), 5, '0')
                      ELSE CAST(l_orderkey + l_linenumber * 1000 AS VARCHAR) END) AS lookup_key,
               concat('CALL_', CASE WHEN l_partkey < 100000 THEN lpad(CAST(l_partkey AS VARCHAR), 5, '0')
                                    ELSE CAST(l_partkey AS VARCHAR) END) AS call_id,
               CAST(-60 - l_quantity AS INTEGER) AS rsrp, CAST(-(l_suppkey % 20) AS INTEGER) AS rsrq,
               CASE l_returnflag WHEN 'R' THEN 'Y' ELSE 'N' END AS drop_flag,
               strftime(l_shipdate, '%Y%m%d') AS base_date,
               concat('{"line":', l_linenumber, '}') AS detail_json
        FROM lineitem""",
    "timings": """
        SELECT CASE WHEN user_id % 2 = 0 THEN 'bucketed' ELSE 'partitioned' END AS engine,
               CASE WHEN event_type = 'purchase' THEN -1.0 ELSE value END AS elapsed_sec, ts AS started_at
        FROM events""",
    "versions": """
        SELECT CAST(user_id AS VARCHAR) AS cell_id, concat('BTS_', event_id) AS bts_alt_key,
               json_extract_string(props, '$.k') AS region_cd, ts AS valid_from
        FROM events WHERE event_type = 'signup'""",
}


def with_views(names: str, body: str) -> str:
    """SQL text: the named views, then the query."""
    views = ",\n".join(f"{n} AS ({SQL[n]})" for n in names.split())
    return f"WITH {views}\n{body}"
