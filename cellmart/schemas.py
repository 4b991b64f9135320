"""The 24 tables: columns, partitioning, write order, buckets and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MAIN, STAGING, RESULTS = "cellmart", "cellmart_staging", "cellmart_results"

_TYPES = {
    "S": T.StringType(),
    "L": T.LongType(),
    "I": T.IntegerType(),
    "D": T.DoubleType(),
    "T": T.TimestampType(),
}


def _columns(spec: str) -> T.StructType:
    fields = []
    for item in spec.split():
        name, _, code = item.partition(":")
        fields.append(T.StructField(name, _TYPES[code or "S"], True))
    return T.StructType(fields)


@dataclass(frozen=True)
class Table:
    """One table. ``day_of`` names the timestamp behind a derived date partition."""

    name: str
    schema: T.StructType
    partition_by: str | None = None
    day_of: str | None = None
    sort_by: str | None = None
    bucket_by: str | None = None
    buckets: int = 0
    key: tuple[str, ...] = ()

    @property
    def partition_column(self) -> str | None:
        if self.day_of:
            return "window_date" if self.day_of == "window_start" else "event_date"
        return self.partition_by

    @property
    def is_dim(self) -> bool:
        """Replaced whole, and kept in versions."""
        return not self.partition_column and not self.buckets


# Table names, column names and types of the data model.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "cdr_sgi",
            _columns(
                "sgi_id cell_id alt_cell_id rqt_st_dt etl_date base_date val:L"
                " signal_type use_flag subscriber_id event_time:T"
            ),
            partition_by="etl_date",
            sort_by="cell_id",
        ),
        Table(
            "cdr_sgi_raw",
            _columns("sgi_id cell_id alt_cell_id rqt_st_dt etl_date val:L use_flag signal_type event_time:T"),
            day_of="event_time",
        ),
        Table(
            "cdr_mdt_smsng",
            _columns(
                "mdt_id gnss_utmkx:D gnss_utmky:D gnss_metric_id bts_market_nm trigr_ev"
                " hndset_pet_nm dlearfcn_cd rsrp:I base_date etl_date event_time:T"
            ),
            partition_by="base_date",
            sort_by="gnss_metric_id",
        ),
        Table(
            "cdr_mdt_smsng_raw",
            _columns("mdt_id gnss_utmkx:D gnss_utmky:D rqt_st_dt bts_market_nm event_time:T"),
            day_of="event_time",
        ),
        Table(
            "sum_ltas_cdr_tm",
            _columns("etl_date base_hour bts_alt_key region_cd total_val:L record_cnt:L created_at:T"),
            partition_by="etl_date",
        ),
        Table(
            "tfm_s1ap_sgi_use_dd_v1",
            _columns("etl_date cell_id use_cnt:L created_at:T"),
            partition_by="etl_date",
        ),
        Table(
            "tfm_s1ap_sgi_use_dd_v2",
            _columns("etl_date cell_id use_cnt:L created_at:T"),
            partition_by="etl_date",
        ),
        Table(
            "cnv_mdt_merge_stg",
            _columns("mdt_id gnss_utmkx:D gnss_utmky:D bts_alt_key distance_m:D base_date created_at:T"),
            partition_by="base_date",
        ),
        Table(
            "ltas_5min_flink",
            _columns("window_start:T window_end:T bts_alt_key region_cd total_val:L record_cnt:L"),
            day_of="window_start",
        ),
        Table(
            "sgi_5min_flink",
            _columns("window_start:T window_end:T bts_alt_key region_cd total_val:L record_cnt:L"),
            day_of="window_start",
        ),
        Table(
            "sgi_5min_flink_v2",
            _columns("window_start:T window_end:T bts_alt_key total_val:L record_cnt:L"),
            day_of="window_start",
        ),
        Table(
            "mdt_5min_flink",
            _columns("window_start:T window_end:T bts_alt_key record_cnt:L"),
            day_of="window_start",
        ),
        Table(
            "call_quality_iceberg",
            _columns("lookup_key call_id rsrp:I rsrq:I drop_flag base_date detail_json"),
            partition_by="base_date",
            sort_by="lookup_key",
        ),
        Table(
            "call_quality_kudu",
            _columns("lookup_key call_id rsrp:I rsrq:I drop_flag base_date detail_json"),
            bucket_by="lookup_key",
            buckets=32,
            key=("lookup_key",),
        ),
        Table(
            "call_quality_kudu_by_call",
            _columns("call_id base_date lookup_key rsrp:I drop_flag"),
            bucket_by="call_id",
            buckets=16,
            key=("call_id", "base_date"),
        ),
        Table(
            "bts_master",
            _columns(
                "cell_id alt_cell_id bts_alt_key bts_market_nm lat:D lon:D region_cd rpot_geom rpot_line_cnt:I"
            ),
            key=("cell_id",),
        ),
        Table("tbm_rpot_m", _columns("rpot_seq:I rpot_geom rpot_line_cnt:I bts_market_nm")),
        Table("tbm_gpot25", _columns("gpot25_x:I gpot25_y:I bdri_cd")),
        Table("tbm_bdri", _columns("bdri_cd sido_name gungu_name bemd_name bdri_name"), key=("bdri_cd",)),
        Table(
            "lte_call_fact",
            _columns("call_id contract_id product_id call_start_dt drop_flag volte_flag base_date"),
            partition_by="base_date",
        ),
        Table("contract_dim", _columns("contract_id subscriber_id plan_type"), key=("contract_id",)),
        Table("product_dim", _columns("product_id product_name volte_eligible"), key=("product_id",)),
        Table(
            "mstr_rsrp_bad_rate_result",
            _columns("run_id base_date sido_name gungu_name rsrp_tot:L rsrp_u110:L computed_at:T"),
            partition_by="base_date",
        ),
        Table(
            "mstr_volte_drop_result",
            _columns("run_id window_start:T drop_rate:D total_calls:L dropped_calls:L computed_at:T"),
            day_of="window_start",
        ),
    )
}


def schema(name: str) -> T.StructType:
    return TABLES[name].schema
