"""Batch transforms, dashboard queries and their stored results."""

from datetime import datetime

import pytest

from cellmart.plans import batch, bi, daily
from cellmart.sources.readers import literal_rows
from cellmart.sources.writers import overwrite_partitions

CDR = ["sgi_id", "cell_id", "alt_cell_id", "rqt_st_dt", "etl_date", "base_date", "val", "signal_type", "use_flag"]
BTS = ["cell_id", "alt_cell_id", "bts_alt_key", "region_cd"]


def cdr(spark, rows):
    return literal_rows(spark, "cdr_sgi", [(str(i), *r) for i, r in enumerate(rows)], CDR)


def day(c, a, val=1, signal="SGI", use="Y", date="20251201", base=None, hour="09"):
    return (c, a, f"{date}{hour}4500", date, base or date, val, signal, use)


@pytest.fixture
def stations(spark):
    rows = [
        ("c1", "a1", "B1", "R1"),
        ("c2", "a2", "B2", "R1"),
        ("c3", "a1", "B3", "R2"),
        ("c4", None, None, "R2"),
        (None, "a5", "B5", "R5"),
        ("c2", "a2", "B2", "R1"),  # repeated row: counts twice
    ]
    return literal_rows(spark, "bts_master", rows, BTS)


RECORDS = [
    day("c1", "zz"),  # cell only: B1
    day("zz", "a1"),  # alternate only: B1 and B3
    day("c1", "a1"),  # both on B1, alternate also on B3
    day("c2", "a1", use="N"),  # cell on B2 twice, alternate on B1 and B3
    day("zz", "zz"),  # nothing
    day(None, None),
    day(None, "a5"),
    day("c4", None, val=None),
    day("c4", "a5", signal="OTHER"),
    day("c1", "a1", date="20251202"),
    day("c1", "a1", base="20251130"),
]


def test_ltas_hourly(spark, stations):
    records = cdr(spark, [*RECORDS, day("c1", "x", val=5, hour="10"), day("c2", "x", val=5, hour="10")])
    out = batch.ltas_hourly(records, stations, "20251201", "20251201")
    assert sorted((tuple(r)[1:] for r in out.collect()), key=str) == sorted(
        [
            ("2025120109", "B1", "R1", 2, 2),
            ("2025120109", "B2", "R1", 2, 2),  # one record, two equal station rows
            ("2025120109", None, "R2", 1, 2),  # station without key; NULL values add nothing
            ("2025120109", None, None, 4, 4),  # unknown or NULL cells
            ("2025120110", "B1", "R1", 5, 1),
            ("2025120110", "B2", "R1", 10, 2),
        ],
        key=str,
    )


def test_sgi_use_by_cell(spark, stations):
    out = batch.sgi_use_by_cell(cdr(spark, RECORDS), stations, "20251201", "20251201")
    got = {r["cell_id"]: r["use_cnt"] for r in out.collect()}
    # c1: 1 + 2 stations; zz: 2 stations + 1 unmatched; NULL: 1 unmatched + 1 by a5; c2 unused
    assert got == {"c1": 3, "zz": 3, None: 2, "c2": 0, "c4": 1}


def test_sgi_use_by_station(spark, stations):
    out = batch.sgi_use_by_station(cdr(spark, RECORDS), stations, "20251201", "20251201")
    got = {r["cell_id"]: r["use_cnt"] for r in out.collect()}
    # c4 has no station key, so its two records go under their own cell
    assert got == {"B1": 4, "B3": 3, "B2": 2, "B5": 2, "c4": 2}


def test_all_days_equal_single_days(spark, stations, bag):
    records = cdr(spark, RECORDS)
    for run in (batch.ltas_hourly, batch.sgi_use_by_cell, batch.sgi_use_by_station):
        whole = run(records, stations)
        parts = run(records, stations, "20251201").unionByName(run(records, stations, ["20251202"]))
        assert bag(whole) == bag(parts)


def test_facts_are_summed_before_the_join(spark, stations, plan, tmp_path):
    path = str(tmp_path / "cdr_sgi")
    overwrite_partitions(cdr(spark, RECORDS), path, "cdr_sgi")
    tables = daily.Warehouse(spark, str(tmp_path))
    text = plan(batch.ltas_hourly(tables.read("cdr_sgi"), stations, "20251201", "20251201"))
    assert "PartitionFilters: [isnotnull(etl_date" in text
    assert "PushedFilters: [IsNotNull(base_date), EqualTo(base_date,20251201)]" in text
    assert "ReadSchema: struct<cell_id:string,rqt_st_dt:string,base_date:string,val:bigint>" in text
    text = plan(batch.sgi_use_by_cell(tables.read("cdr_sgi"), stations, "20251201"))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "signal_type IN (S1AP,SGI)" in text or "In(signal_type, [S1AP,SGI])" in text


MDT = ["mdt_id", "gnss_metric_id", "dlearfcn_cd", "rsrp", "base_date"]


def mdt(spark, rows):
    return literal_rows(spark, "cdr_mdt_smsng", [(str(i), *r) for i, r in enumerate(rows)], MDT)


@pytest.fixture
def areas(spark):
    gpot = literal_rows(spark, "tbm_gpot25", [(1, 2, "k1"), (1, 3, "k1"), (9, 9, "k2"), (7, 7, "none")])
    bdri = literal_rows(spark, "tbm_bdri", [("k1", "S", "G", "E", "R"), ("k2", "S", "G", "E2", "R2")])
    return gpot, bdri


SIGNAL = [
    ("1_2", "1550", -74, "20250701"),
    ("1_2", "1650", -75, "20250701"),
    ("1_3", "1700", -110, "20250702"),
    ("1_3", "2600", -109, "20250702"),
    ("1_3", "2600", -111, "20250702"),
    ("1_2", "1694", None, "20250702"),
    ("9_9", "2600", -90, "20250702"),
    ("9_9_x", "2600", -90, "20250702"),
    ("12", "1550", -70, "20250702"),
    (None, "1550", -70, "20250702"),
    ("7_7", "1550", -70, "20250702"),
    ("1_2", "1550", -70, "20250801"),
]


def test_rsrp_bad_rate(spark, areas):
    out = bi.rsrp_bad_rate(mdt(spark, SIGNAL), *areas, "202507")
    got = {r["bemd_name"]: tuple(r)[4:] for r in out.collect()}
    assert got == {"E": (1, 1, 4, 1, 2, 6), "E2": (None, None, None, None, None, 2)}


def test_rsrp_plan(spark, areas, plan, tmp_path):
    path = str(tmp_path / "cdr_mdt_smsng")
    overwrite_partitions(mdt(spark, SIGNAL), path, "cdr_mdt_smsng")
    text = plan(bi.rsrp_bad_rate(daily.Warehouse(spark, str(tmp_path)).read("cdr_mdt_smsng"), *areas, "202507"))
    assert "StartsWith(base_date#" in text and "PartitionFilters: [isnotnull(base_date" in text


CALLS = ["call_id", "contract_id", "product_id", "call_start_dt", "drop_flag", "volte_flag", "base_date"]


def test_volte_drop(spark, bag):
    rows = [
        ("1", "k1", "p1", "20251201120000", "Y", "Y", "20251201"),
        ("2", "k1", "p1", "20251201120459", "N", "Y", "20251201"),
        ("3", "k2", "p1", "20251201120500", "Y", "N", "20251201"),  # k2 is listed twice
        ("4", "k1", "p2", "20251201120000", "Y", "Y", "20251201"),  # not eligible
        ("5", "zz", "p1", "20251201120000", "Y", "Y", "20251201"),  # no contract
        ("6", "k1", "p1", "20251202120000", "N", "N", "20251202"),  # no voice call that day
    ]
    calls = literal_rows(spark, "lte_call_fact", rows, CALLS)
    contracts = literal_rows(spark, "contract_dim", [("k1", "s", "x"), ("k2", "s", "x"), ("k2", "s", "y")])
    products = literal_rows(spark, "product_dim", [("p1", "n", "Y"), ("p2", "n", "N"), (None, "n", "Y")])
    out = bi.volte_drop(calls, contracts, products)
    assert {tuple(r) for r in out.collect()} == {("20251201", 4, 1, 0.5), ("20251202", 1, 0, None)}
    assert bag(bi.volte_drop(calls, contracts, products, "20251202")) == [repr(("20251202", 1, 0, None))]
    mart = {tuple(r)[1:] for r in bi.mart_volte(calls, contracts, products, "R", "20251201").collect()}
    assert mart == {
        (datetime(2025, 12, 1, 12, 0), 0.5, 2, 1),
        (datetime(2025, 12, 1, 12, 5), None, 2, 0),
    }


def test_tagged_queries(spark, stations):
    records = cdr(spark, RECORDS)
    assert [tuple(r) for r in bi.partition_count(records, "q", "20251201", "20251201").collect()] == [("q", 9)]
    assert [tuple(r) for r in bi.partition_count(records, "q", "19990101").collect()] == [("q", 0)]
    out = bi.region_total(records, stations, "q", "20251201")
    assert {tuple(r) for r in out.collect()} == {("q", "R1", 5), ("q", "R2", 1)}


def test_runs_replace_only_their_day(spark, stations, tmp_path):
    tables = daily.Warehouse(spark, str(tmp_path))
    tables.replace("cdr_sgi", cdr(spark, RECORDS))
    tables.replace("bts_master", stations)
    for run in ("ltas", "sgi_v1", "sgi_v2"):
        daily.BATCH[run](tables, "20251201", "20251201")
        daily.BATCH[run](tables, "20251202", "20251202")
        daily.BATCH[run](tables, "20251202", "20251202")
    for table in ("sum_ltas_cdr_tm", "tfm_s1ap_sgi_use_dd_v1", "tfm_s1ap_sgi_use_dd_v2"):
        out = tables.read(table)
        assert {r[0] for r in out.select("etl_date").distinct().collect()} == {"20251201", "20251202"}
        assert out.where("created_at IS NULL").count() == 0
    assert tables.read("sum_ltas_cdr_tm").where("etl_date = '20251202'").count() == 1


def test_marts_are_filled(spark, areas, tmp_path):
    tables = daily.Warehouse(spark, str(tmp_path))
    tables.replace("cdr_mdt_smsng", mdt(spark, SIGNAL))
    tables.replace("tbm_gpot25", areas[0])
    tables.replace("tbm_bdri", areas[1])
    daily.fill_rsrp_mart(tables, "run", "202507")
    got = {tuple(r)[:5] for r in tables.read("mstr_rsrp_bad_rate_result").select(
        "base_date", "sido_name", "gungu_name", "rsrp_tot", "rsrp_u110").collect()}
    assert got == {("20250701", "S", "G", 2, None), ("20250702", "S", "G", 6, 2)}
    calls = [("1", "k1", "p1", "20251201120000", "Y", "Y", "20251201")]
    tables.replace("lte_call_fact", literal_rows(spark, "lte_call_fact", calls, CALLS))
    tables.replace("contract_dim", literal_rows(spark, "contract_dim", [("k1", "s", "x")]))
    tables.replace("product_dim", literal_rows(spark, "product_dim", [("p1", "n", "Y")]))
    daily.fill_volte_mart(tables, "run", "20251201")
    assert tables.read("mstr_volte_drop_result").first()["drop_rate"] == 1.0


def test_marts_keep_other_runs(spark, areas, tmp_path):
    """Two days whose calls share a window day at midnight, and calls whose start cannot be read."""
    tables = daily.Warehouse(spark, str(tmp_path))
    calls = [
        ("1", "k1", "p1", "20251201001000", "Y", "Y", "20251201"),
        ("2", "k1", "p1", "20251201120000", "Y", "N", "20251201"),
        ("3", "k1", "p1", "no time", "Y", "N", "20251201"),
        ("4", "k1", "p1", "20251201235800", "Y", "Y", "20251202"),
        ("5", "k1", "p1", "no time", "Y", "Y", "20251202"),
    ]
    tables.replace("lte_call_fact", literal_rows(spark, "lte_call_fact", calls, CALLS))
    tables.replace("contract_dim", literal_rows(spark, "contract_dim", [("k1", "s", "x")]))
    tables.replace("product_dim", literal_rows(spark, "product_dim", [("p1", "n", "Y")]))
    for run_id, day in (("R1", "20251201"), ("R2", "20251202"), ("R2", "20251202")):
        daily.fill_volte_mart(tables, run_id, day)
    mart = tables.read("mstr_volte_drop_result")
    got = sorted((r.run_id, str(r.window_start), r.total_calls) for r in mart.collect())
    assert got == [
        ("R1", "2025-12-01 00:10:00", 1), ("R1", "2025-12-01 12:00:00", 1), ("R1", "None", 1),
        ("R2", "2025-12-01 23:55:00", 1), ("R2", "None", 1),
    ]
    tables.replace("cdr_mdt_smsng", mdt(spark, SIGNAL))
    tables.replace("tbm_gpot25", areas[0])
    tables.replace("tbm_bdri", areas[1])
    for run_id in ("R1", "R2", "R2"):
        daily.fill_rsrp_mart(tables, run_id, "202507")
    counts = tables.read("mstr_rsrp_bad_rate_result").groupBy("run_id").count().collect()
    assert {r["run_id"]: r["count"] for r in counts} == {"R1": 2, "R2": 2}
