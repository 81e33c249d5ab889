"""Record schemas and the province dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)

# Field names of the recharge log, the record kind that is kept, and the success code.
SERVICE_NAME = "serviceName"
RESULT = "bussinessRst"
FEE = "chargefee"
PROVINCE_CODE = "provinceCode"
REQUEST_ID = "requestId"
RECEIVE_TIME = "receiveNotifyTime"
RECHARGE_SERVICE = "reChargeNotifyReq"
SUCCESS = "0000"

CORRUPT = "_corrupt"
LISTED = "_listed"

# Every field is read as text: amounts come both bare and quoted, and a typed field would lose the quoted ones.
RECHARGE_FIELDS = T.StructType(
    [T.StructField(name, T.StringType()) for name in (SERVICE_NAME, RESULT, FEE, PROVINCE_CODE, REQUEST_ID, RECEIVE_TIME)]
)
RECHARGE_PARSE_SCHEMA = T.StructType(
    [T.StructField(LISTED, T.ArrayType(RECHARGE_FIELDS)), T.StructField(CORRUPT, T.StringType())]
)

# Province codes and names.
PROVINCES = [
    ("100", "北京"),
    ("200", "广东"),
    ("210", "上海"),
    ("220", "天津"),
    ("230", "重庆"),
    ("240", "辽宁"),
    ("250", "江苏"),
    ("270", "湖北"),
    ("280", "四川"),
    ("290", "陕西"),
    ("311", "河北"),
    ("351", "山西"),
    ("371", "河南"),
    ("431", "吉林"),
    ("451", "黑龙江"),
    ("471", "内蒙古"),
    ("531", "山东"),
    ("551", "安徽"),
    ("571", "浙江"),
    ("591", "福建"),
    ("731", "湖南"),
    ("771", "广西"),
    ("791", "江西"),
    ("851", "贵州"),
    ("871", "云南"),
    ("891", "西藏"),
    ("898", "海南"),
    ("931", "甘肃"),
    ("951", "宁夏"),
    ("971", "青海"),
    ("991", "新疆"),
]

# The words a running count starts from.
SEED_WORDS = [("hello", 1), ("world", 1)]

METRICS = ["orders", "succ", "fail", "fee", "cost_ms"]

CELL_SCHEMA = T.StructType(
    [
        T.StructField("grain", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("hour", T.StringType()),
        T.StructField("minute", T.StringType()),
        T.StructField("province_code", T.StringType()),
        T.StructField("orders", T.LongType()),
        T.StructField("succ", T.LongType()),
        T.StructField("fail", T.LongType()),
        T.StructField("fee", MONEY_SUM),
        T.StructField("cost_ms", T.LongType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("groupid", T.StringType()),
        T.StructField("partitions", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)


def rows_of(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A small table of literals. It is made in the JVM, so that reading it starts no Python worker."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def provinces(spark: SparkSession) -> DataFrame:
    return rows_of(spark, PROVINCES, "code", "name")


def seed_words(spark: SparkSession) -> DataFrame:
    return rows_of(spark, SEED_WORDS, "word", "n0").withColumn("n0", F.col("n0").cast("bigint"))
