"""Customer documents derived from the tables ``customer`` and ``orders``.

The given tables hold no telecom documents, so each customer becomes one. Orders
become payments and services. Fields are made messy by fixed lists of spellings,
picked by the customer's number. A document holds the orders of one block of
order keys, and order keys are unique, so no document outgrows ``BLOCK``
payments however many orders one customer has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 65_536
BLOCK_STRIDE = 1_000_000_000_000
LOADED_AT = "2024-01-01 00:00:00"
EARLIER_LOAD = "2023-12-31 00:00:00"
AS_OF = "2024-01-01"

# Raw spellings, picked by number modulo the length of the list.
COUNTRY = ["AR", " argentna ", "Argentinaxx", "méx", "mejico", "MEXICO", "colmbia", "CO", "pru",
           "pero", "chle", "chi", "br", None, "Chile"]
CITY = ["Bogotá", "bogta", "cal", "Coroba", "CDMX", "mty", "stgo", "trjllo", "punta arenas", None,
        "Monteria", " buenos_aires", "Rosario", "ciudad mexico", "GDL", "lma", "areqipa", "Valpo",
        "conce", "san-juan del río", "Cali", "Santo Domingo", "córdoba", "Medelin"]
OPERATOR = ["movstr", "w0m", "tygo", "clr", "xyz", None, " Movistar ", "WON", "tgo plus", "Claro", ""]
PLAN = ["Pre-Pago", "pospago", "ctrl", None, "PREPAGO ", "post_pago", "controlx", "basic"]
BRAND = ["samung", "appel", "xaomi", "hauwei", "lg", " SAMSUNG", "Apple", None, "Huawei P"]
MODEL = ["Model 12", "Model-X7", "Model 12 v3", "7", "Model", "n/a", None, "Model  9", "S21+"]
PHONE = ["+54 11-22", "0011 22", "300-", "n/a", "", None, "abc", " Unknown ", "+x5"]
AGE = ["34.5", "-1", "121", "abc", "", "-0.4", "17", "18", "24", "25", "34", "44", "45", "55", None,
       "120.4"]
SCORE = ["579.5", "-5", "579", "669", "670", "739", "740", "799", "800", "abc", "", None, "300",
         "650.25"]
DATA_GB = ["10", "2.5", "-1", "abc", "", None, "7.25", "0"]
STATUS = ["activo", " INACTIVE ", "suspendido", "x", "ACTIVE", None, "Suspended"]
LIMIT = ["5000", "1200.50", "bad", None, "-3"]
NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?(e[0-9]+)?\z"
SERVICE_OF_PRIORITY = {
    "1-URGENT": "VOICE",
    "2-HIGH": "SMS",
    "3-MEDIUM": "DATA",
    "4-NOT SPECIFIED": "ROAMING",
    "5-LOW": "INTERNATIONAL",
}


def _pick(values: list, number: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(v).cast("string") for v in values]), (number % len(values) + 1).cast("int")
    )


def _json(text: Column, as_number: Column) -> Column:
    """JSON text of a number where asked for and possible, otherwise of a string."""
    # an exponent is written out, as a variant prints it
    number = F.when(text.contains("e"), F.to_json(F.try_parse_json(text))).otherwise(text)
    return F.when(as_number & text.rlike(NUMBER), number).otherwise(_quoted(text))


def _quoted(text: Column) -> Column:
    """JSON text of a string; NULL stays NULL."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNotNull(), listed.substr(F.lit(2), F.length(listed) - 2))


def _money(amount: Column) -> Column:
    """Two decimals at most, without trailing zeros."""
    return F.regexp_replace(amount.cast("decimal(12,2)").cast("string"), r"\.?0+$", "")


def _payment() -> Column:
    """JSON text of one payment."""
    key = F.col("o_orderkey")
    date = (
        F.when(key % 41 == 0, "n/a")
        .when(key % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'10:11:12"))
        .when(key % 3 == 1, F.date_format("o_orderdate", "MM-dd-yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    amount = (
        F.when(key % 43 == 0, "unknown")
        .when(key % 47 == 0, "")
        .when(key % 53 == 0, "-1")
        .when(key % 59 == 0, "0")
        .otherwise(_money(F.col("o_totalprice")))
    )
    status = (
        F.when(key % 11 == 0, " Processing ")
        .when(key % 13 == 0, "DECLINED")
        .when(key % 31 == 0, "x")
        .when(key % 37 == 0, F.lit(None).cast("string"))
        .when(F.col("o_orderstatus") == "F", "paid")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("late")
    )
    bare = (key % 2 == 0) & amount.rlike("^-?[0-9]")
    members = (
        F.when(key % 10 != 9, _member("payment_id", F.concat(F.lit("P"), key.cast("string")))),
        _member("date", date),
        F.when(bare, F.concat(F.lit('"amount":'), amount)).otherwise(_member("amount", amount)),
        _member("status", status),
    )
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _member(name: str, text: Column) -> Column:
    return F.concat(F.lit(f'"{name}":"'), text, F.lit('"'))


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and block of order keys, with its orders.

    Customers are joined to the blocks by an inner join of narrow rows, which adaptive
    execution can split where one customer has very many blocks; customers without
    orders come from an anti join. Both meet the orders by customer and block, as these
    are gathered: gathered orders, the widest rows here, are not shuffled again.
    """
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnRenamed("o_custkey", "c_custkey")
    service = F.lit(None).cast("string")
    for priority, code in SERVICE_OF_PRIORITY.items():
        service = F.when(F.col("o_orderpriority") == priority, code).otherwise(service)
    # Collecting shrinks nothing, so rows are spread by block before they are grouped.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    block = F.expr(f"o_orderkey DIV {BLOCK}").alias("block")
    # Columns of an order travel, the longer JSON text is made where it is gathered.
    by_block = (
        orders.select(
            "c_custkey",
            block,
            "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate",
        )
        .repartition(tasks, "c_custkey", "block")
        .select(
            "c_custkey",
            "block",
            F.struct("o_orderkey", _payment().alias("payment")).alias("payment"),
            F.when(F.col("o_orderkey") % 3 == 0, service).alias("service"),
            "o_orderdate",
        )
        .groupBy("c_custkey", "block")
        .agg(
            F.collect_list("payment").alias("payments"),
            F.sort_array(F.collect_set("service")).alias("services"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    blocks = orders.select("c_custkey", block).distinct()
    without_orders = customer.join(blocks, "c_custkey", "left_anti").withColumn("block", F.lit(0).cast("bigint"))
    buyers = customer.join(blocks, "c_custkey")
    return by_block.join(buyers, ["c_custkey", "block"]).unionByName(without_orders, allowMissingColumns=True)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``data``, ``_loaded_at`` and ``_row_id``, as a load of raw documents has them."""
    key, block = F.col("c_custkey"), F.col("block")
    number = key + block * 7
    account = block * BLOCK_STRIDE + key
    copies = _accounts(spark, sf_dir).select(
        "*",
        account.alias("account"),
        number.alias("n"),
        F.explode(F.when(number % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    n, copy = F.col("n"), F.col("copy")
    m = n + copy
    numeric = n % 2 == 0
    start = F.coalesce("first_order", F.lit("2020-02-29").cast("timestamp_ntz"))
    registered = (
        F.when((n % 51 == 0) & (copy == 1), "06/05/2023")
        .when(n % 19 == 4, "06/05/2023")
        .when(n % 19 == 5, "13-45-2023")
        .when(n % 19 == 6, F.date_format(start, "yyyy-MM-dd'T'10:00:00-05:00"))
        .when(n % 3 == 0, F.date_format(start, "yyyy-MM-dd'T'07:08:09"))
        .when(n % 3 == 1, F.date_format(start, "MM-dd-yyyy"))
        .otherwise(F.date_format(start, "yyyy-MM-dd"))
    )
    customer_id = (
        F.when(n % 23 == 5, F.lit(None).cast("string"))
        .when(n % 23 == 6, "null")
        .when(n % 29 == 7, '"C-12"')
        .otherwise(_json(F.col("account").cast("string"), n % 5 != 1))
    )
    listed = F.coalesce("services", F.array().cast("array<string>"))
    as_json = F.to_json(listed)
    services = (
        F.when(n % 71 == 3, F.lit(None).cast("string"))
        .when(n % 4 == 0, as_json)
        .when(n % 4 == 3, F.to_json(F.concat(listed, F.array(F.lit("FAX"), F.lit(" voice "), F.lit("VOICE"), F.lit("")))))
        .when(n % 4 == 1, _quoted(F.lower(F.array_join(listed, ", "))))
        .otherwise(_quoted(as_json))
    )
    ordered = F.transform(F.sort_array("payments"), lambda p: p["payment"])
    with_junk = F.when(n % 67 == 11, F.concat(ordered, F.array(F.lit("5"), F.lit("null")))).otherwise(ordered)
    history = F.when(n % 61 == 9, '"none"').otherwise(
        F.concat(F.lit("["), F.array_join(with_junk, ","), F.lit("]"))
    )
    texts = F.struct(
        F.when(n % 4 == 0, F.concat(F.lit(" "), "c_name", F.lit(" "))).otherwise(F.col("c_name")).alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(n % 37 != 3, F.concat("c_name", F.lit("@Mail.COM "))).alias("email"),
        F.when(n % 9 == 2, F.concat(F.lit("300-"), key.cast("string"))).otherwise(_pick(PHONE, n)).alias("phone_number"),
        _pick(COUNTRY, n + F.col("c_nationkey")).alias("country"),
        _pick(CITY, n * 5 + F.col("c_nationkey")).alias("city"),
        _pick(OPERATOR, m).alias("operator"),
        _pick(PLAN, m).alias("plan_type"),
        _pick(BRAND, n).alias("device_brand"),
        _pick(MODEL, m).alias("device_model"),
        registered.alias("registration_date"),
        F.date_format("last_order", "MM-dd-yyyy").alias("last_payment_date"),
        _pick(STATUS, n).alias("status"),
        _pick(LIMIT, n).alias("credit_limit"),
        F.lit("12.345").alias("data_usage_current_month"),
        F.concat(F.lit("-34.6037"), (n % 10).cast("string")).alias("latitude"),
        F.lit("-58.381592").alias("longitude"),
        F.md5(F.concat_ws("-", "account", "copy")).alias("record_uuid"),
    )
    # values that are JSON already stand beside the texts: each document is parsed once
    members = {
        "customer_id": customer_id,
        "age": _json(_pick(AGE, m), numeric),
        "monthly_data_gb": _json(_pick(DATA_GB, n), numeric),
        "monthly_bill_usd": _json(F.when(n % 47 == 1, "1e3").otherwise(_money(F.col("c_acctbal"))), numeric),
        "credit_score": _json(_pick(SCORE, n), numeric),
        "payment_history": history,
        "contracted_services": services,
    }
    # the texts come last and close the object: cutting one brace off a text's end costs more
    document = F.concat_ws(
        ",",
        *[F.concat(F.lit(f'"{name}":'), json) for name, json in members.items()],
        F.substring(F.to_json(texts), 2, 2**31 - 1),
    )
    return copies.select(
        F.parse_json(F.concat(F.lit("{"), document)).alias("data"),
        F.when((copy == 1) & (n % 34 == 0), F.lit(EARLIER_LOAD)).otherwise(F.lit(LOADED_AT)).cast("timestamp").alias("_loaded_at"),
        (F.col("account") * 2 + copy + 1).alias("_row_id"),
    )
