"""The command line on small stored tables."""

import pytest

import seed
from cellmart.__main__ import main
from cellmart.plans import daily
from cellmart.schemas import MAIN
from cellmart.sources import readers


@pytest.fixture
def tables(spark, tmp_path):
    tables = daily.Warehouse(spark, str(tmp_path / "wh"))
    late = ("900", "CELL_A", "CELL_A_ALT", "20260803131000", "20260803", 1, "Y", "SGI", seed.at("13:10:00"))
    tables.replace("cdr_sgi_raw", seed.cdr(spark, [*seed.CDR, late]))
    tables.replace("cdr_mdt_smsng_raw", seed.mdt(spark))
    tables.replace("bts_master", seed.bts(spark))
    rows = [("1", "CELL_A", "x", "20251201094500", "20251201", "20251201", 5, "SGI", "Y")]
    columns = ["sgi_id", "cell_id", "alt_cell_id", "rqt_st_dt", "etl_date", "base_date", "val", "signal_type", "use_flag"]
    tables.replace("cdr_sgi", readers.literal_rows(spark, "cdr_sgi", rows, columns))
    return tables


def run(tables, *arguments):
    main(["--warehouse", tables.root, *arguments])


def test_batch_and_stream(tables, tmp_path):
    for job in ("ltas", "sgi_v1", "sgi_v2"):
        run(tables, "batch", job)
    assert tables.read("sum_ltas_cdr_tm").first()["total_val"] == 5
    assert tables.read("tfm_s1ap_sgi_use_dd_v2").first()["cell_id"] == "BTS_NORTH_01"
    run(tables, "stream", "ltas", "--checkpoint", str(tmp_path / "cp"), "--drain", "--state-partitions", "2")
    assert tables.read("ltas_5min_flink").count() == len(seed.WINDOWS)


def test_shown_results(tables, capsys, spark):
    run(tables, "report", "region")
    assert "NORTH" in capsys.readouterr().out
    run(tables, "report", "count")
    assert "count\t1" in capsys.readouterr().out
    run(tables, "audit")
    assert "pending" in capsys.readouterr().out
    row = ("K1", "C1", -70, -9, "N", "20251201", "{}")
    tables.replace("call_quality_kudu", readers.literal_rows(spark, "call_quality_kudu", [row]))
    run(tables, "lookup", "K1")
    assert "C1" in capsys.readouterr().out


def test_keyed_table_by_catalog(tables, capsys, spark, tmp_path):
    name = "call_quality_kudu"
    old = [("K1", "C1", -70, -9, "N", "20251201", "{}"), ("K2", "C2", -71, -9, "N", "20251201", "{}")]
    tables.replace(name, readers.literal_rows(spark, name, old))
    changes = str(tmp_path / "changes")
    readers.literal_rows(spark, name, [("K1", "C9", -80, -9, "Y", "20251202", "{}")]).write.parquet(changes)
    run(tables, "upsert", changes)
    run(tables, "compact", name)
    run(tables, "lookup", "K1")
    shown = capsys.readouterr().out
    assert "C9" in shown and "C1" not in shown
    view = spark.table(f"{MAIN}.{name}_now")
    assert view.count() == 2 and spark.table(f"{MAIN}.call_quality_kudu_by_call_now").count() == 2


def test_ingest_compact_and_parity(tables, capsys, spark, tmp_path):
    other = daily.Warehouse(spark, str(tmp_path / "other"))
    main(["--warehouse", other.root, "ingest", tables.root, "cdr_sgi_raw", "--value", "2026-08-03"])
    main(["--warehouse", other.root, "ingest", tables.root, "bts_master"])
    assert other.read("cdr_sgi_raw").count() == 13 and other.read("bts_master").count() == 10
    run(tables, "compact", "cdr_sgi_raw", "--out", str(tmp_path / "few"))
    assert readers.read_table(spark, str(tmp_path / "few"), "cdr_sgi_raw").count() == 13
    for _ in range(2):
        run(tables, "stream", "sgi_v2", "--checkpoint", str(tmp_path / "cp"), "--drain", "--state-partitions", "2")
    run(tables, "parity", "sgi_v2")
    assert "sgi_v2" in capsys.readouterr().out
