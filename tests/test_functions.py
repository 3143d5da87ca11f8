"""Column functions on literal cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abonados.functions import cleaning as C
from abonados.functions import documents as D
from abonados.functions import metrics as M
from abonados.functions import parsing as P


def outcomes(spark, function, inputs, schema):
    """What a function makes of each input row."""
    rows = [(i, *(value if isinstance(value, tuple) else (value,))) for i, value in enumerate(inputs)]
    frame = spark.createDataFrame(rows, f"i int, {schema}")
    columns = [F.col(name) for name in frame.columns[1:]]
    return [r.out for r in frame.select("i", function(*columns).alias("out")).orderBy("i").collect()]


TEXT_CASES = {
    C.clean_country: {
        "AR": "Argentina", " argentna ": "Argentina", "Argentinaxx": "Argentina", "méx": "México", "mejico": "México",
        "MEXICO": "México", "mx": "México", "colmbia": "Colombia", "co": "Colombia", "Colón": "Colombia",
        "pru": "Perú", "pero": "Perú", "pe": "Perú", "chle": "Chile", "chi": "Chile", "cl": "Chile", "br": "Desconocido", None: "Desconocido",
        "": "Desconocido", "x arg": "Desconocido",
    },
    C.clean_city: {
        "Bogotá": "Bogota", "bogta": "Bogota", "cal": "Cali", "Cali": "Cali", "calima": "Calima", "Coroba": "Cordoba", "CORDOBA": "Cordoba",
        "Córdoba": "Cordoba", "CDMX": "Ciudad de Mexico", "Ciudad Mexico": "Ciudad de Mexico", "ciudad real": "Ciudad Real",
        "mty": "Monterrey", "Monteria": "Monterrey", "stgo": "Santiago", "Santo Domingo": "Santiago", "santa fe": "Santa Fe",
        "trjllo": "Trujillo", "punta arenas": "Punta Arenas", "san-juan del río": "San-Juan Del Rio", "o'higgins 2nd": "O'Higgins 2nd",
        "gdl": "Guadalajara", "buenos_aires": "Buenos Aires", "rosrio": "Rosario", "lma": "Lima", "areqipa": "Arequipa",
        "valpo": "Valparaiso", "conce": "Concepcion", "medelin": "Medellin", "barranquila": "Barranquilla", None: None, "": "",
    },
    C.clean_operator: {
        "movstr": "MOVISTAR", "w0m": "WOM", "vom": "WOM", "tygo": "TIGO", "tgo x": "TIGO", "clr": "CLARO", "clarito": "CLARO", "xyz": "UNKNOWN", None: "UNKNOWN",
    },
    C.clean_plan_type: {
        "Pre-Pago": "PREPAGO", "pospago": "POSTPAGO", "posx": "POSTPAGO", "ctrl": "CONTROL", "contrrol": "CONTROL", "p": "UNKNOWN", None: "UNKNOWN",
    },
    C.clean_device_brand: {
        "samung": "Samsung", "samsg": "Samsung", "appel": "Apple", "aple": "Apple", "xaomi": "Xiaomi", "hauwei": "Huawei", "lg": "Unknown", None: "Unknown",
    },
    C.clean_device_model: {
        "Model 12": "Model 12", "Model  9": "Model  9", "Model-X7": "Model 7", "Model - 7": "Model 7", "Model 12 v3": "Model 123", "7": "Model 7",
        "Model": "Model Unknown", "n/a": "Model Unknown", "null": "Model Unknown", "  ": "Model Unknown", None: "Model Unknown", "S21+": "Model 21",
        "Model 12\n": "Model 12", "model 5": "Model 5",
    },
    C.clean_customer_status: {
        "activo": "ACTIVE", " INACTIVE ": "INACTIVE", "inactivo": "INACTIVE", "suspendido": "SUSPENDED", "x": "UNKNOWN", None: "UNKNOWN", "active\t": "UNKNOWN",
    },
    C.clean_payment_status: {
        "paid": "COMPLETED", "success": "COMPLETED", "processing": "PENDING", "declined": "FAILED", "error": "FAILED", "late": "LATE", "lately": "UNKNOWN", "x": "UNKNOWN", None: "UNKNOWN",
    },
}


@pytest.mark.parametrize("function", TEXT_CASES, ids=lambda f: f.__name__)
def test_text_cleaners(spark, function):
    cases = TEXT_CASES[function]
    assert outcomes(spark, function, list(cases), "t string") == list(cases.values())


@pytest.mark.parametrize("function", [C.clean_city, C.clean_operator, C.clean_device_brand, C.clean_customer_status])
def test_cleaning_twice_changes_nothing(spark, function):
    inputs = list(TEXT_CASES[function])
    once = outcomes(spark, function, inputs, "t string")
    assert outcomes(spark, function, once, "t string") == once


def test_country_of_city(spark):
    cases = {
        ("Perú", "Bogota"): "Colombia", ("Desconocido", "Lima"): "Perú", ("Chile", "Punta Arenas"): "Chile",
        ("México", "cal"): "Colombia", ("México", "Rosario"): "Argentina", ("Perú", "cdmx"): "México", ("Perú", "valpo"): "Chile",
        ("Chile", None): "Chile", (None, "Lima"): None,
    }
    assert outcomes(spark, C.country_of_city, list(cases), "c string, t string") == list(cases.values())


def test_phone(spark):
    cases = {
        ("+54 11-22", "Chile"): "+541122", ("0011 22", "Argentina"): "+541122", ("123", "Desconocido"): "+1123", ("123", None): "+1123",
        ("n/a", "Chile"): None, (" Unknown ", "Chile"): None, ("", "Chile"): None, (None, "Chile"): None, ("abc", "Chile"): "+56",
        ("57300", "Colombia"): "+5757300", ("9", "México"): "+529", ("9", "Perú"): "+519", ("+x5", "Perú"): "+515",
    }
    assert outcomes(spark, C.clean_phone, list(cases), "p string, c string") == list(cases.values())


def documents(spark, texts):
    rows = list(enumerate(texts, start=1))
    return spark.createDataFrame(rows, "_row_id long, json string").select(
        "_row_id", F.parse_json("json").alias("data"), F.lit("2024-01-01").cast("timestamp").alias("_loaded_at")
    )


def of_documents(spark, column, texts):
    return [r.out for r in documents(spark, texts).select("_row_id", column.alias("out")).orderBy("_row_id").collect()]


def test_json_access(spark):
    texts = ['{"k":1}', '{"k":"1"}', '{"k":null}', "{}", '{"k":[1,"a"]}', '{"k":{"b":2}}', '{"k":true}', '{"k":1.5}', '{"k":1e3}']
    data = F.col("data")
    assert of_documents(spark, D.has_field(data, "k"), texts) == [True, True, True, False, True, True, True, True, True]
    assert of_documents(spark, D.field_kind(data, "k"), texts) == [
        "number", "string", "null", None, "array", "object", "boolean", "number", "number"]
    assert of_documents(spark, D.field_text(data, "k"), texts)[:6] == ["1", "1", None, None, '[1,"a"]', '{"b":2}']
    assert of_documents(spark, D.is_number(D.field(data, "k")), texts) == [True, False, False, False, False, False, False, True, True]
    assert of_documents(spark, D.is_array(D.field(data, "k")), texts) == [False] * 4 + [True] + [False] * 4


def test_age_and_score(spark):
    texts = ['{"age":34.5}', '{"age":"34.5"}', '{"age":-1}', '{"age":"121"}', '{"age":"abc"}', '{"age":""}', '{"age":"-0.4"}',
             '{"age":120.4}', '{"age":null}', "{}", '{"age":1e1}', '{"age":"1e1"}', '{"age":" 5"}', '{"age":true}']
    assert of_documents(spark, P.age_field(F.col("data")), texts) == [35, 35, None, None, None, None, 0, 120, None, None, 10, None, None, None]
    texts = ['{"credit_score":"579.5"}', '{"credit_score":-5}', '{"credit_score":800}', '{"credit_score":"99999999999"}']
    assert of_documents(spark, P.credit_score_field(F.col("data")), texts) == [580, None, 800, None]


def test_numbers(spark):
    texts = ['{"n":-3.5}', '{"n":"-3.5"}', '{"n":"1e3"}', '{"n":1e3}', '{"n":"."}', '{"n":"7\\n"}', '{"n":"999999999999999999999"}']
    assert of_documents(spark, P.number_field(F.col("data"), "n"), texts) == [
        Decimal("-3.5"), Decimal("-3.5"), None, Decimal(1000), None, None, None]
    loose = ['{"n":"-34.6"}', '{"n":"bad"}', '{"n":5}', '{"n":null}']
    assert of_documents(spark, P.loose_number_field(F.col("data"), "n", P.MONEY), loose) == [Decimal("-34.6"), None, Decimal(5), None]


def test_customer_id(spark):
    texts = ['{"customer_id":7}', '{"customer_id":"08"}', '{"customer_id":"C-1"}', '{"customer_id":null}', "{}", '{"customer_id":"null"}',
             '{"customer_id":12.5}', '{"customer_id":1e3}', '{"customer_id":"99999999999999999999"}']
    data = F.col("data")
    assert of_documents(spark, P.given_customer_id(data), texts) == [7, 8, None, None, None, None, None, 1000, None]
    assert of_documents(spark, P.customer_id(data, F.col("_row_id")), texts) == [
        7, 8, 9000003, 9000004, 9000005, 9000006, None, 1000, 9000009]


def test_timestamps(spark):
    cases = {
        "2023-05-06T07:08:09": dt.datetime(2023, 5, 6, 7, 8, 9), "2023-05-06T07:08:09.5": dt.datetime(2023, 5, 6, 7, 8, 9, 500000),
        "2023-05-06T10:00:00-05:00": dt.datetime(2023, 5, 6, 10), "2023-05-06T10:00:00Z": dt.datetime(2023, 5, 6, 10),
        "05-06-2023": dt.datetime(2023, 5, 6), "2023-05-06": dt.datetime(2023, 5, 6), "06/05/2023": None, "13-45-2023": None,
        "2023-02-30": None, "2023-05-06\n": None, "2023-05-06 07:08": None, "": None, None: None,
    }
    assert outcomes(spark, P.parse_timestamp, list(cases), "t string") == list(cases.values())


@pytest.mark.parametrize("text", ["13-45-2023", "2023-02-30", "2023-13-01T00:00:00"])
def test_strict_timestamps_raise(spark, text):
    with pytest.raises(Exception, match="(?i)cast|parse"):
        outcomes(spark, lambda t: P.parse_timestamp(t, strict=True), [text], "t string")


def test_service_tokens(spark):
    cases = {
        '["VOICE","sms"]': ["VOICE", "sms"], "VOICE, SMS": ["VOICE", "SMS"], ' ["A b"]': ["A b"], "VOICE": ["VOICE"], "'[x]'": ["'x'"],
        '["A",null,1]': ["A", None, "1"], "[broken": None, "a,,b": ["a", "", "b"],
    }
    assert outcomes(spark, P.service_tokens, list(cases), "t string") == list(cases.values())


def test_buckets(spark):
    scores = {None: "UNKNOWN", 0: "POOR (<580)", 579: "POOR (<580)", 580: "FAIR (580-669)", 669: "FAIR (580-669)", 670: "GOOD (670-739)",
              739: "GOOD (670-739)", 740: "VERY GOOD (740-799)", 799: "VERY GOOD (740-799)", 800: "EXCELLENT (800+)"}
    assert outcomes(spark, M.credit_score_range, list(scores), "s int") == list(scores.values())
    ages = {None: "UNKNOWN", 17: "0-17", 18: "18-24", 24: "18-24", 25: "25-34", 34: "25-34", 35: "35-44", 44: "35-44", 45: "45-54", 54: "45-54", 55: "55+"}
    assert outcomes(spark, M.age_bucket, list(ages), "a int") == list(ages.values())


def test_months(spark):
    cases = {
        ("2024-02-29", "2024-01-31"): 0, ("2024-03-30", "2024-01-31"): 1, ("2024-01-10", "2024-03-15"): -2, ("2024-01-01", "2024-01-01"): 0,
        ("2024-01-01", "2020-02-29"): 46, ("2024-03-31", "2024-02-29"): 1, (None, "2024-01-01"): None, ("2024-01-01", None): None,
    }
    assert outcomes(spark, M.months_between, list(cases), "a string, b string") == list(cases.values())


def test_arpu(spark):
    cases = [(Decimal(10), 4, Decimal(3)), (Decimal(0), 4, Decimal(3)), (None, None, Decimal(3)), (None, 0, Decimal(-3)), (None, None, None)]
    assert outcomes(spark, M.arpu_estimated, cases, "r decimal(28,6), p long, b decimal(18,6)") == [Decimal("2.5"), Decimal(3), Decimal(3), None, None]
    cases = [(Decimal(10), 4), (Decimal(10), 0), (Decimal(10), -3), (None, 4)]
    assert outcomes(spark, M.arpu_real, cases, "r decimal(28,6), m int") == [2.5, None, None, None]


def test_cleaning_a_clean_city_again_does_not_multiply_the_rules(spark):
    """Rules read the outcome of the cleaning within, they do not repeat it."""
    frame = spark.createDataFrame([("arg", "Coroba"), (None, "mty"), ("x", None)], "country string, city string")
    home = C.country_of_city(C.clean_country(F.col("country")), C.clean_city(F.col("city")))
    found = frame.select(home.alias("home"))
    optimized = found._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("translate(") <= 2
    assert [r.home for r in found.collect()] == ["Argentina", "México", "Desconocido"]
