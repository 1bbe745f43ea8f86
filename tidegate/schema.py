"""Fixed schemas: the staged table, sidecars, ledger and report tables."""

from pyspark.sql import types as T

TEXT_COLUMNS = [
    "loc", "loc_zn", "loc_name", "loc_purp_desc", "loc_qti", "flow_ind",
]
QUANTITY_COLUMNS = ["dc", "opc", "tsq", "oac"]
INDICATOR_COLUMNS = [
    "it", "auth_overrun_ind", "nom_cap_exceed_ind", "all_qty_avail", "qty_reason",
]
LINEAGE_COLUMNS = ["measure_date", "cycle_id", "download_timestamp"]
KEY_COLUMNS = ["loc", "loc_name", "measure_date", "cycle_id"]
CREATED_AT = "created_at"

# Header of a raw capacity file, before names are sanitised.
RAW_HEADER = [
    "Loc", "Loc Zn", "Loc Name", "Loc Purp Desc", "Loc/QTI", "Flow Ind",
    "DC", "OPC", "TSQ", "OAC",
    "IT", "Auth Overrun Ind", "Nom Cap Exceed Ind", "All Qty Avail", "Qty Reason",
]


def capacity_schema(exact_numbers: bool = False) -> T.StructType:
    """The staged capacity table; ``exact_numbers`` stores quantities as decimals."""
    number = T.DecimalType(38, 6) if exact_numbers else T.DoubleType()
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in TEXT_COLUMNS]
        + [T.StructField(c, number) for c in QUANTITY_COLUMNS]
        + [T.StructField(c, T.StringType()) for c in INDICATOR_COLUMNS]
        + [
            T.StructField("measure_date", T.DateType()),
            T.StructField("cycle_id", T.StringType()),
            T.StructField("download_timestamp", T.DoubleType()),
            T.StructField(CREATED_AT, T.TimestampType()),
        ]
    )


SIDECAR_SCHEMA = T.StructType([
    T.StructField("endpoint", T.StringType()),
    T.StructField("requested_cycle", T.IntegerType()),
    T.StructField("cycle_name", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("original_filename", T.StringType()),
    T.StructField("saved_filename", T.StringType()),
    T.StructField("download_time", T.StringType()),
    T.StructField("download_timestamp", T.DoubleType()),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("cache_key", T.StringType()),
    T.StructField("ts", T.DoubleType()),
])

QUALITY_COLUMNS = ["date", "location", "capacity", "available", "cycle"]
