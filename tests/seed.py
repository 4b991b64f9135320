"""Rows made up for the tests: ten stations, twelve call records, ten measurements of one day."""


from datetime import datetime, timedelta

BTS_COLUMNS = ["cell_id", "alt_cell_id", "bts_alt_key", "bts_market_nm", "region_cd"]
BTS = [
    ("CELL_A", "CELL_A_ALT", "BTS_NORTH_01", "ERICSSON", "NORTH"),
    ("CELL_B", "CELL_B_ALT", "BTS_COAST_01", "ERICSSON", "COAST"),
    ("CELL_C", "CELL_C_ALT", "BTS_RIDGE_01", "SAMSUNG", "NORTH"),
    ("CELL_D", "CELL_D_ALT", "BTS_PORT_01", "NOKIA", "COAST"),
    ("CELL_E", "CELL_E_ALT", "BTS_LAKE_01", "ERICSSON", "SOUTH"),
    ("CELL_F", "CELL_F_ALT", "BTS_MOOR_01", "SAMSUNG", "SOUTH"),
    ("CELL_G", "CELL_G_ALT", "BTS_FORD_01", "SAMSUNG", "INLAND"),
    ("CELL_H", "CELL_H_ALT", "BTS_MILL_01", "NOKIA", "INLAND"),
    ("CELL_I", "CELL_I_ALT", "BTS_DALE_01", "ERICSSON", "INLAND"),
    ("CELL_J", "CELL_J_ALT", "BTS_HILL_01", "SAMSUNG", "NORTH"),
]

DAY = datetime(2026, 8, 3)


def at(clock: str) -> datetime:
    h, m, s = (int(x) for x in clock.split(":"))
    return DAY + timedelta(hours=h, minutes=m, seconds=s)


def key(moment: datetime) -> str:
    return moment.strftime("%Y%m%d%H%M%S")


CDR_COLUMNS = [
    "sgi_id", "cell_id", "alt_cell_id", "rqt_st_dt", "etl_date", "val", "use_flag", "signal_type", "event_time",
]
CDR = [
    (n, f"CELL_{c}", f"CELL_{c}_ALT", key(at(t)), "20260803", val, use, signal, at(t))
    for n, c, t, val, use, signal in (
        ("101", "A", "12:45:03", 41, "Y", "S1AP"),
        ("102", "A", "12:45:52", 27, "Y", "SGI"),
        ("103", "B", "12:45:17", 33, "N", "S1AP"),
        ("104", "B", "12:45:48", 19, "Y", "SGI"),
        ("105", "C", "12:45:29", 64, "Y", "S1AP"),
        ("106", "D", "12:45:11", 8, "Y", "SGI"),
        ("107", "E", "12:45:37", 15, "N", "SGI"),
        ("108", "F", "12:45:22", 77, "Y", "S1AP"),
        ("109", "G", "12:45:58", 23, "Y", "S1AP"),
        ("110", "H", "12:45:44", 50, "Y", "SGI"),
        ("111", "A", "12:50:05", 6, "Y", "S1AP"),
        ("112", "J", "12:40:30", 91, "Y", "SGI"),
    )
]

MDT_COLUMNS = ["mdt_id", "gnss_utmkx", "gnss_utmky", "rqt_st_dt", "bts_market_nm", "event_time"]
MDT = [
    (n, x, y, key(at(t)), vendor, at(t))
    for n, x, y, vendor, t in (
        ("m1", 955200.0, 1931400.0, "ERICSSON", "12:45:02"),
        ("m2", 957900.0, 1930100.0, "SAMSUNG", "12:45:09"),
        ("m3", 951300.0, 1938800.0, "SAMSUNG", "12:45:21"),
        ("m4", 953700.0, 1935500.0, "NOKIA", "12:45:33"),
        ("m5", 958800.0, 1939900.0, "ERICSSON", "12:45:41"),
        ("m6", 950600.0, 1932200.0, "ERICSSON", "12:45:50"),
        ("m7", 952100.0, 1937300.0, "SAMSUNG", "12:45:59"),
        ("m8", 956400.0, 1933600.0, "NOKIA", "12:41:00"),
        ("m9", 954500.0, 1936700.0, "SAMSUNG", "12:47:30"),
        ("m10", 959100.0, 1934900.0, "ERICSSON", "12:52:10"),
    )
]

# station -> (ltas total, ltas count, v1 total, v2 total); counts are equal in the three jobs
WINDOWS = {
    "BTS_NORTH_01": (68, 2, 68, 68),
    "BTS_COAST_01": (52, 2, 19, 52),
    "BTS_RIDGE_01": (64, 1, 64, 64),
    "BTS_PORT_01": (8, 1, 8, 8),
    "BTS_LAKE_01": (15, 1, 0, 15),
    "BTS_MOOR_01": (77, 1, 77, 77),
    "BTS_FORD_01": (23, 1, 23, 23),
    "BTS_MILL_01": (50, 1, 50, 50),
}
MDT_WINDOWS = {
    "BTS_NORTH_01": 3, "BTS_COAST_01": 3, "BTS_RIDGE_01": 3, "BTS_PORT_01": 1, "BTS_LAKE_01": 3,
    "BTS_MOOR_01": 3, "BTS_FORD_01": 3, "BTS_MILL_01": 1, "BTS_DALE_01": 3, "BTS_HILL_01": 3,
}


def bts(spark):
    from cellmart.sources.readers import literal_rows

    return literal_rows(spark, "bts_master", BTS, BTS_COLUMNS)


def cdr(spark, rows=CDR):
    from cellmart.sources.readers import literal_rows

    return literal_rows(spark, "cdr_sgi_raw", rows, CDR_COLUMNS)


def mdt(spark, rows=MDT):
    from cellmart.sources.readers import literal_rows

    return literal_rows(spark, "cdr_mdt_smsng_raw", rows, MDT_COLUMNS)
