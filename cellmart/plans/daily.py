"""Table-to-table runs: read the stored tables, compute a day, replace its partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.plans import batch, bi
from cellmart.schemas import TABLES
from cellmart.session import stored
from cellmart.sources.readers import exists, read_table
from cellmart.sources.writers import append, overwrite_partitions


class Warehouse:
    """Stored tables below one folder, one subfolder per table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.root = path.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.path(table), table)

    def replace(self, table: str, rows: DataFrame) -> None:
        overwrite_partitions(rows, self.path(table), table)


def run_ltas(tables: Warehouse, etl_date: str, base_date: str) -> None:
    rows = batch.ltas_hourly(tables.read("cdr_sgi"), tables.read("bts_master"), etl_date, base_date)
    tables.replace("sum_ltas_cdr_tm", batch.stamped(rows))


def run_sgi_v1(tables: Warehouse, etl_date: str, base_date: str) -> None:
    rows = batch.sgi_use_by_cell(tables.read("cdr_sgi"), tables.read("bts_master"), etl_date, base_date)
    tables.replace("tfm_s1ap_sgi_use_dd_v1", batch.stamped(rows))


def run_sgi_v2(tables: Warehouse, etl_date: str, base_date: str) -> None:
    rows = batch.sgi_use_by_station(tables.read("cdr_sgi"), tables.read("bts_master"), etl_date, base_date)
    tables.replace("tfm_s1ap_sgi_use_dd_v2", batch.stamped(rows))


def run_mdt(tables: Warehouse, etl_date: str, base_date: str) -> None:
    rows = batch.mdt_merge(
        tables.read("cdr_mdt_smsng"), tables.read("bts_master"), tables.read("tbm_rpot_m"), base_date
    )
    tables.replace("cnv_mdt_merge_stg", batch.stamped(rows))


BATCH: dict[str, Callable[[Warehouse, str, str], None]] = {
    "ltas": run_ltas,
    "sgi_v1": run_sgi_v1,
    "sgi_v2": run_sgi_v2,
    "mdt": run_mdt,
}


def store_run(tables: Warehouse, table: str, rows: DataFrame, run_id: str) -> None:
    """Add a run to a mart, replacing what the same run stored in the partitions it now fills.

    A run that is not there yet is appended. If it is, rows of other runs in these partitions, the one of unreadable
    starts included, are written back with it.
    """
    spec = TABLES[table]
    part = F.to_date(spec.day_of) if spec.day_of else F.col(spec.partition_column)

    def gathered(some: DataFrame) -> DataFrame:
        """A partition's rows in one task, or a few if they are many: a file each."""
        return some.withColumn("_own", part).hint("rebalance", "_own").drop("_own")

    new = stored(rows, table)
    if not exists(tables.spark, tables.path(table)) or tables.read(table).where(F.col("run_id") == run_id).isEmpty():
        append(gathered(new), tables.path(table), table)
        return
    touched = new.select(part.alias("_part")).distinct()
    others = tables.read(table).where(~F.col("run_id").eqNullSafe(run_id)).withColumn("_own", part)
    others = others.join(touched, F.col("_own").eqNullSafe(F.col("_part")), "left_semi").select(*new.columns)
    # read before its partitions are replaced
    tables.replace(table, gathered(new.unionByName(stored(others, table))))


def fill_rsrp_mart(tables: Warehouse, run_id: str, month: str | None = None) -> None:
    rows = bi.mart_rsrp(
        tables.read("cdr_mdt_smsng"), tables.read("tbm_gpot25"), tables.read("tbm_bdri"), run_id, month
    )
    store_run(tables, "mstr_rsrp_bad_rate_result", batch.stamped(rows, "computed_at"), run_id)


def fill_volte_mart(tables: Warehouse, run_id: str, base_date: str) -> None:
    rows = bi.mart_volte(
        tables.read("lte_call_fact"), tables.read("contract_dim"), tables.read("product_dim"), run_id, base_date
    )
    store_run(tables, "mstr_volte_drop_result", batch.stamped(rows, "computed_at"), run_id)
