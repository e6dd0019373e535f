"""Record layouts: one fixed schema per layer."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

# The nine positional fields of an access-log record.
RECORD_FIELDS = [
    "client_ip",
    "domain",
    "time",
    "target_ip",
    "rcode",
    "query_type",
    "authority_record",
    "add_msg",
    "dns_ip",
]
DATE_PARTS = ["year", "month", "day"]
GEO_LABELS = ["country", "province", "city", "operator"]

# Column order of the raw layer, the detail layer and the index record.
ODS_COLUMNS = RECORD_FIELDS + DATE_PARTS
DWD_COLUMNS = ["client_ip", *GEO_LABELS, *RECORD_FIELDS[1:], *DATE_PARTS]
INDEX_COLUMNS = ["id", "client_ip", "domain", "do_time", *RECORD_FIELDS[3:]]

TIME_PATTERN = "yyyyMMddHHmmss"
UNKNOWN_RCODE = 99


def strings(names):
    return StructType([StructField(n, StringType()) for n in names])


RECORD_SCHEMA = strings(RECORD_FIELDS)
ODS_SCHEMA = strings(ODS_COLUMNS)
DWD_SCHEMA = strings(DWD_COLUMNS)
DEMO_SCHEMA = StructType(
    [StructField("id", StringType())]
    + [
        StructField(n, IntegerType() if n == "rcode" else StringType())
        for n in ODS_COLUMNS
    ]
)
# The geo range file is delimited by pipes; its fourth field is not used.
GEO_FILE_SCHEMA = strings(
    ["ip_start", "ip_end", "country", "unused", "province", "city", "operator"]
)
SEGMENT_SCHEMA = StructType(
    [StructField("seg_lo", LongType()), StructField("seg_hi", LongType())]
    + [StructField(n, StringType()) for n in GEO_LABELS]
)
