"""The rules in SQL, written apart from the engine, for the engine DuckDB.

``raw`` holds the documents as texts, ``cust_all`` the cleaned documents, then
come ``cust``, ``pay_all``, ``pay``, ``svc_tok``, ``svc``, ``ca`` and ``dim``.
"""

from __future__ import annotations

from contract import documents as docs


def _list(values: list) -> str:
    texts = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return "[" + ", ".join(texts) + "]"


def _pick(values: list, number: str) -> str:
    return f"({_list(values)})[(({number}) % {len(values)} + 1)::INT]"


_SERVICE_CASE = "CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN '{c}'" for p, c in docs.SERVICE_OF_PRIORITY.items()
) + " END"


def money(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(12,2)) AS VARCHAR), '\\.?0+$', '')"


def timestamp(t: str) -> str:
    return f"""CASE
      WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T') THEN TRY_CAST(replace(left({t}, 19), 'T', ' ') AS TIMESTAMP)
      WHEN regexp_matches({t}, '^\\d{{2}}-\\d{{2}}-\\d{{4}}$') THEN try_strptime({t}, '%m-%d-%Y')
      WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN TRY_CAST({t} AS TIMESTAMP) END"""


def dated(t: str) -> str:
    return f"(regexp_matches({t}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}(T|$)') OR regexp_matches({t}, '^\\d{{2}}-\\d{{2}}-\\d{{4}}$'))"


def number(t: str, places: int = 6) -> str:
    return f"CASE WHEN regexp_matches({t}, '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST({t} AS DECIMAL(18,{places})) END"


def text_of(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def country(x: str) -> str:
    c = f"lower(trim({x}))"
    return f"""CASE WHEN regexp_matches({c}, '^(ar$|arg)') THEN 'Argentina'
      WHEN regexp_matches({c}, '^(mx$|mex|méx|mejico$)') THEN 'México'
      WHEN regexp_matches({c}, '^(co$|col)') THEN 'Colombia'
      WHEN regexp_matches({c}, '^(pe$|per|pru)') THEN 'Perú'
      WHEN regexp_matches({c}, '^(cl$|ch[il])') THEN 'Chile'
      ELSE 'Desconocido' END"""


def plain(x: str) -> str:
    return f"translate(trim({x}), 'áéíóúüñÁÉÍÓÚÜÑ', 'aeiouunAEIOUUN')"


_CITY_PATTERNS = [
    ("Bogota", "Colombia", "^bog"), ("Medellin", "Colombia", "^medel"), ("Cali", "Colombia", "^cali?$"),
    ("Barranquilla", "Colombia", "^barran"), ("Buenos Aires", "Argentina", "^buenos"),
    ("Cordoba", "Argentina", "^(cor.*ba|coroba)$"), ("Rosario", "Argentina", "^(rosar|rosrio$)"),
    ("Ciudad de Mexico", "México", "^(ciudad.*mex|cdmx$|mexico city$)"),
    ("Guadalajara", "México", "^(guadal|gdl$)"), ("Monterrey", "México", "^(monter|mty$)"),
    ("Lima", "Perú", "^(lim|lma$)"), ("Arequipa", "Perú", "^(areq)"), ("Trujillo", "Perú", "^(truj|trjllo$)"),
    ("Santiago", "Chile", "^(sant.*go|stgo)$"), ("Valparaiso", "Chile", "^(valpar|valpo$)"),
    ("Concepcion", "Chile", "^(concep|conce$)"),
]


def city(x: str) -> str:
    c = f"lower({plain(x)})"
    whens = " ".join(f"WHEN regexp_matches({c}, '{p}') THEN '{name}'" for name, _, p in _CITY_PATTERNS)
    title = f"array_to_string(list_transform(regexp_extract_all({c}, '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)'), lambda w: upper(w[1]) || w[2:]), '')"
    return f"CASE {whens} WHEN {x} IS NULL THEN NULL ELSE {title} END"


def home(country_sql: str, city_sql: str) -> str:
    c = f"lower({plain(city_sql)})"
    whens = " ".join(f"WHEN regexp_matches({c}, '{p}') THEN '{land}'" for _, land, p in _CITY_PATTERNS)
    return f"CASE WHEN {country_sql} IS NULL THEN NULL {whens} ELSE {country_sql} END"


def phone(x: str, land: str) -> str:
    digits = f"regexp_replace(regexp_replace({x}, '[^0-9]', '', 'g'), '^0+', '')"
    return f"""CASE WHEN {x} IS NULL OR trim({x}) = '' OR lower(trim({x})) IN ('unknown', 'n/a') THEN NULL
      WHEN regexp_matches({x}, '^\\+[0-9]') THEN '+' || {digits}
      ELSE CASE {land} WHEN 'Argentina' THEN '+54' WHEN 'México' THEN '+52' WHEN 'Colombia' THEN '+57'
                       WHEN 'Perú' THEN '+51' WHEN 'Chile' THEN '+56' ELSE '+1' END || {digits} END"""


def operator(x: str) -> str:
    c = f"lower(trim({x}))"
    return f"""CASE WHEN regexp_matches({c}, '^(mov)|^movstr$') THEN 'MOVISTAR'
      WHEN regexp_matches({c}, '^(tig|tgo|tygo$)') THEN 'TIGO' WHEN regexp_matches({c}, '^(cla|clr$)') THEN 'CLARO'
      WHEN regexp_matches({c}, '^(wom|w0m|won|vom$|wm$)') THEN 'WOM' ELSE 'UNKNOWN' END"""


def plan(x: str) -> str:
    c = f"lower(trim({x}))"
    return f"""CASE WHEN {c} LIKE 'pre%' THEN 'PREPAGO' WHEN {c} LIKE 'pos%' THEN 'POSTPAGO'
      WHEN {c} LIKE 'ctrl%' OR {c} LIKE 'control%' OR {c} LIKE 'contrrol%' THEN 'CONTROL' ELSE 'UNKNOWN' END"""


def brand(x: str) -> str:
    c = f"lower(trim({x}))"
    return f"""CASE WHEN {c} LIKE 'sam%' THEN 'Samsung' WHEN {c} LIKE 'app%' OR {c} = 'aple' THEN 'Apple'
      WHEN {c} LIKE 'xia%' OR {c} IN ('xiomi', 'xaomi') THEN 'Xiaomi'
      WHEN {c} LIKE 'hua%' OR {c} IN ('hauwei', 'huwai', 'huwei') THEN 'Huawei' ELSE 'Unknown' END"""


def model(x: str) -> str:
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return f"""CASE WHEN regexp_matches({x}, '^Model\\s+[0-9]+$') THEN {x}
      WHEN {digits} <> '' THEN 'Model ' || {digits} ELSE 'Model Unknown' END"""


def customer_status(x: str) -> str:
    s = f"upper(trim({x}))"
    return f"""CASE WHEN {s} IN ('ACTIVE', 'ACTIVO') THEN 'ACTIVE' WHEN {s} IN ('INACTIVE', 'INACTIVO') THEN 'INACTIVE'
      WHEN {s} IN ('SUSPENDED', 'SUSPENDIDO') THEN 'SUSPENDED' ELSE 'UNKNOWN' END"""


def payment_status(x: str) -> str:
    s = f"upper(trim({x}))"
    return f"""CASE WHEN {s} IN ('PAID', 'COMPLETED', 'SUCCESS') THEN 'COMPLETED' WHEN {s} IN ('PENDING', 'PROCESSING') THEN 'PENDING'
      WHEN {s} IN ('FAILED', 'ERROR', 'DECLINED') THEN 'FAILED' WHEN {s} = 'LATE' THEN 'LATE' ELSE 'UNKNOWN' END"""


def rounded(t: str) -> str:
    return f"CAST(round({number(t)}, 0) AS INT)"


_RAW = f"""
acc AS (
  SELECT c.*, coalesce(o.block, 0) AS block, o.n_orders, coalesce(o.services, []) AS services, o.first_order, o.last_order
  FROM customer c LEFT JOIN (
    SELECT o_custkey, o_orderkey // {docs.BLOCK} AS block, count(*) AS n_orders,
           min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
           list_sort(list_distinct(list({_SERVICE_CASE}) FILTER (WHERE o_orderkey % 3 = 0))) AS services
    FROM orders GROUP BY 1, 2) o ON c.c_custkey = o.o_custkey),
docs AS (
  SELECT *, block * {docs.BLOCK_STRIDE} + c_custkey AS account, c_custkey + block * 7 AS n,
         coalesce(first_order, TIMESTAMP '2020-02-29') AS start,
         unnest(CASE WHEN (c_custkey + block * 7) % 17 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM acc),
raw AS (
  SELECT account * 2 + copy + 1 AS row_id, account, n, copy, n + copy AS m, block, c_custkey, n_orders,
    CASE WHEN copy = 1 AND n % 34 = 0 THEN TIMESTAMP '{docs.EARLIER_LOAD}' ELSE TIMESTAMP '{docs.LOADED_AT}' END AS loaded_at,
    CASE WHEN n % 23 = 5 THEN 'missing' WHEN n % 23 = 6 THEN 'null' WHEN n % 29 = 7 THEN 'word'
         WHEN n % 5 <> 1 THEN 'number' ELSE 'digits' END AS id_form,
    CASE WHEN n % 4 = 0 THEN ' ' || c_name || ' ' ELSE c_name END AS first_name,
    c_mktsegment AS last_name,
    CASE WHEN n % 37 <> 3 THEN c_name || '@Mail.COM ' END AS email,
    CASE WHEN n % 9 = 2 THEN '300-' || c_custkey ELSE {_pick(docs.PHONE, 'n')} END AS phone,
    {_pick(docs.AGE, 'n + copy')} AS age, {_pick(docs.COUNTRY, 'n + c_nationkey')} AS country,
    {_pick(docs.CITY, 'n * 5 + c_nationkey')} AS city, {_pick(docs.OPERATOR, 'n + copy')} AS operator,
    {_pick(docs.PLAN, 'n + copy')} AS plan, {_pick(docs.DATA_GB, 'n')} AS data_gb,
    CASE WHEN n % 47 = 1 AND n % 2 = 0 THEN '1000' -- the JSON number 1e3
         WHEN n % 47 = 1 THEN '1e3' ELSE {money('c_acctbal')} END AS bill,
    {_pick(docs.BRAND, 'n')} AS brand, {_pick(docs.MODEL, 'n + copy')} AS model,
    CASE WHEN n % 51 = 0 AND copy = 1 THEN '06/05/2023' WHEN n % 19 = 4 THEN '06/05/2023'
         WHEN n % 19 = 5 THEN '13-45-2023' WHEN n % 19 = 6 THEN strftime(start, '%Y-%m-%dT10:00:00-05:00')
         WHEN n % 3 = 0 THEN strftime(start, '%Y-%m-%dT07:08:09') WHEN n % 3 = 1 THEN strftime(start, '%m-%d-%Y')
         ELSE strftime(start, '%Y-%m-%d') END AS registered,
    strftime(last_order, '%m-%d-%Y') AS last_paid, {_pick(docs.STATUS, 'n')} AS status,
    {_pick(docs.LIMIT, 'n')} AS credit_limit, {_pick(docs.SCORE, 'n')} AS score,
    '12.345' AS usage, '-34.6037' || (n % 10) AS latitude, '-58.381592' AS longitude,
    md5(account || '-' || copy) AS record_uuid,
    CASE WHEN n % 71 = 3 THEN NULL
         WHEN n % 4 = 1 THEN lower(array_to_string(services, ', '))
         WHEN n % 4 = 3 THEN '["' || array_to_string(list_concat(services, ['FAX', ' voice ', 'VOICE', '']), '","') || '"]'
         WHEN len(services) = 0 THEN '[]'
         ELSE '["' || array_to_string(services, '","') || '"]' END AS listed,
    (n_orders IS NOT NULL AND n % 61 <> 9) AS has_payments
  FROM docs),
ids AS (
  SELECT *, CASE WHEN id_form IN ('number', 'digits') THEN account END AS given_id,
            CASE WHEN id_form IN ('number', 'digits') THEN account ELSE 9000000 + row_id END AS customer_id
  FROM raw)"""

_CUST_ALL = f"""
cust_all AS (
  SELECT *, {home('country_original', 'city')} AS country, {phone('phone', home('country_original', 'city'))} AS phone_number
  FROM (SELECT row_id, customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
    lower(trim(email)) AS email, phone,
    CASE WHEN {rounded('age')} BETWEEN 0 AND 120 THEN {rounded('age')} END AS age,
    {country('country')} AS country_original, {city('city')} AS city,
    TRY_CAST(latitude AS DECIMAL(12,8)) AS latitude, TRY_CAST(longitude AS DECIMAL(12,8)) AS longitude,
    {operator('operator')} AS operator, {plan('plan')} AS plan_type,
    CASE WHEN {number('data_gb')} >= 0 THEN {number('data_gb')} END AS monthly_data_gb,
    {number('bill')} AS monthly_bill_usd, {brand('brand')} AS device_brand, {model('model')} AS device_model,
    {timestamp('registered')} AS registration_date, {timestamp('last_paid')} AS last_payment_date,
    {customer_status('status')} AS customer_status, TRY_CAST(credit_limit AS DECIMAL(18,6)) AS credit_limit,
    CASE WHEN {rounded('score')} >= 0 THEN {rounded('score')} END AS credit_score,
    TRY_CAST(usage AS DECIMAL(18,6)) AS data_usage_current_month, record_uuid, loaded_at
  FROM ids))"""

_CUST = """
cust AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY loaded_at DESC, row_id DESC) AS rn FROM cust_all)
  WHERE rn = 1 AND registration_date IS NOT NULL)"""

PAY_DATE = """CASE WHEN o_orderkey % 41 = 0 THEN 'n/a' WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT10:11:12')
       WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%m-%d-%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
PAY_AMOUNT = f"""CASE WHEN o_orderkey % 43 = 0 THEN 'unknown' WHEN o_orderkey % 47 = 0 THEN '' WHEN o_orderkey % 53 = 0 THEN '-1'
       WHEN o_orderkey % 59 = 0 THEN '0' ELSE {money('o_totalprice')} END"""
PAY_STATUS = """CASE WHEN o_orderkey % 11 = 0 THEN ' Processing ' WHEN o_orderkey % 13 = 0 THEN 'DECLINED' WHEN o_orderkey % 31 = 0 THEN 'x'
       WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'paid' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'late' END"""

_ITEMS = f"""
items AS (
  SELECT *, CASE WHEN o_orderkey % 10 <> 9 THEN 'P' || o_orderkey END AS given_payment,
    '{{"amount":' || CASE WHEN o_orderkey % 2 = 0 AND regexp_matches(amount, '^-?[0-9]') THEN amount ELSE '"' || amount || '"' END
      || ',"date":"' || pay_date || '"'
      || CASE WHEN o_orderkey % 10 <> 9 THEN ',"payment_id":"P' || o_orderkey || '"' ELSE '' END
      || CASE WHEN status IS NOT NULL THEN ',"status":"' || status || '"' ELSE '' END || '}}' AS payment_json
  FROM (SELECT o_orderkey, o_custkey, o_orderkey // {docs.BLOCK} AS o_block, {PAY_DATE} AS pay_date, {PAY_AMOUNT} AS amount, {PAY_STATUS} AS status FROM orders))"""

_PAY = f"""
pay_docs AS (
  SELECT * FROM ids WHERE has_payments AND given_id IS NOT NULL AND {dated('registered')}),
pay_win AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY given_id ORDER BY loaded_at DESC, row_id DESC) AS rn FROM pay_docs) WHERE rn = 1),
pay_all AS (
  SELECT coalesce(i.given_payment, md5(w.given_id || '_' || i.payment_json)) AS payment_id, w.given_id AS customer_id,
    {timestamp('i.pay_date')} AS payment_date,
    {number('i.amount')} AS payment_amount, {payment_status('i.status')} AS payment_status, w.loaded_at
  FROM pay_win w JOIN items i ON i.o_custkey = w.c_custkey AND i.o_block = w.block),
pay AS (SELECT * FROM pay_all WHERE payment_date IS NOT NULL AND payment_amount > 0)"""

_SVC = f"""
dim AS (SELECT * FROM (VALUES (1, 'VOICE'), (2, 'SMS'), (3, 'DATA'), (4, 'ROAMING'), (5, 'INTERNATIONAL')) AS t(service_id, service_code)),
svc_tok AS (
  SELECT row_id, customer_id, loaded_at, {timestamp('registered')} AS registered_at, {customer_status('status')} AS status,
    unnest(CASE WHEN regexp_matches(listed, '^\\s*\\[') THEN list_transform(string_split(listed[2:-2], ','), lambda x: x[2:-2])
           ELSE string_split(regexp_replace(regexp_replace(listed, '[\\[\\]"]', '', 'g'), '\\s+', '', 'g'), ',') END) AS token
  FROM ids WHERE listed IS NOT NULL AND listed <> '' AND listed <> '[]'),
svc_match AS (
  SELECT t.customer_id, d.service_id, d.service_code, t.status, coalesce(t.registered_at, TIMESTAMP '{docs.AS_OF}') AS contracted_date, t.loaded_at, t.row_id
  FROM svc_tok t JOIN dim d ON d.service_code = upper(trim(t.token)) WHERE trim(t.token) <> ''),
svc AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, service_id
    ORDER BY loaded_at DESC, contracted_date DESC, row_id DESC) AS rn FROM svc_match) WHERE rn = 1)"""


def months(since: str) -> str:
    a, b = f"greatest({since}::DATE, DATE '{docs.AS_OF}')", f"least({since}::DATE, DATE '{docs.AS_OF}')"
    whole = f"((year({a}) - year({b})) * 12 + month({a}) - month({b}) - CASE WHEN day({a}) < day({b}) THEN 1 ELSE 0 END)"
    return f"CAST(CASE WHEN {since}::DATE <= DATE '{docs.AS_OF}' THEN {whole} ELSE -{whole} END AS INT)"


SCORE_RANGE = """CASE WHEN credit_score IS NULL THEN 'UNKNOWN' WHEN credit_score < 580 THEN 'POOR (<580)' WHEN credit_score < 670 THEN 'FAIR (580-669)'
    WHEN credit_score < 740 THEN 'GOOD (670-739)' WHEN credit_score < 800 THEN 'VERY GOOD (740-799)' ELSE 'EXCELLENT (800+)' END"""
AGE_BUCKET = """CASE WHEN age IS NULL THEN 'UNKNOWN' WHEN age < 18 THEN '0-17' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
    WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' ELSE '55+' END"""

# arpu10 is the estimated ARPU times 10^10 as a whole number, rounded half up, so
# that averages of it are exact.
_CA = f"""
pagg AS (
  SELECT customer_id, count(*) FILTER (WHERE payment_status = 'COMPLETED') AS payments_count,
    sum(payment_amount) FILTER (WHERE payment_status = 'COMPLETED') AS total_revenue,
    max(payment_date) AS last_payment_date, min(payment_date) AS first_payment_date,
    bool_or(payment_status IN ('FAILED', 'LATE')) AS has_payment_issues, bool_or(payment_status = 'PENDING') AS has_pending_payments
  FROM pay GROUP BY customer_id),
sagg AS (SELECT customer_id, count(DISTINCT service_id) AS services FROM svc GROUP BY customer_id),
ca AS (
  SELECT *, arpu10::DOUBLE / 1e10 AS arpu_estimated,
    CASE WHEN months_of_service > 0 THEN total_revenue::DOUBLE / months_of_service END AS arpu_real
  FROM (SELECT c.* EXCLUDE (last_payment_date), {SCORE_RANGE} AS credit_score_range, {AGE_BUCKET} AS age_bucket,
    p.total_revenue, p.payments_count, p.first_payment_date, p.last_payment_date, p.has_payment_issues, p.has_pending_payments,
    coalesce(s.services, 0) AS services, {months('c.registration_date')} AS months_of_service,
    CASE WHEN p.payments_count > 0 THEN (CAST(p.total_revenue * 1000000 AS HUGEINT) * 20000 + p.payments_count) // (2 * p.payments_count) END AS avg10,
    CASE WHEN p.total_revenue > 0 AND p.payments_count > 0 THEN (CAST(p.total_revenue * 1000000 AS HUGEINT) * 20000 + p.payments_count) // (2 * p.payments_count)
         WHEN c.monthly_bill_usd > 0 THEN CAST(c.monthly_bill_usd * 1000000 AS HUGEINT) * 10000 END AS arpu10
  FROM cust c LEFT JOIN pagg p USING (customer_id) LEFT JOIN sagg s USING (customer_id)))"""

_PARTS = [
    ("raw", _RAW), ("cust_all", _CUST_ALL), ("cust", _CUST), ("items", _ITEMS), ("pay", _PAY),
    ("svc", _SVC), ("ca", _CA),
]
_NEEDS = {
    "raw": ("raw",), "cust_all": ("raw", "cust_all"), "cust": ("raw", "cust_all", "cust"), "items": ("raw", "items"),
    "pay": ("raw", "items", "pay"), "svc": ("raw", "svc"),
    "ca": ("raw", "cust_all", "cust", "items", "pay", "svc", "ca"),
}


def with_parts(select: str, *parts: str) -> str:
    """A query with the common table expressions it reads."""
    wanted = {need for part in parts for need in _NEEDS[part]}
    return "WITH " + ",".join(text for name, text in _PARTS if name in wanted) + "\n" + select


def mean2(total: str, count: str) -> str:
    """Sum times 10^10 over a count, to two decimals, halves up."""
    return f"CAST((2 * CAST({total} AS HUGEINT) + {count} * 100000000) // (2 * {count} * 100000000) AS DOUBLE) / 100"


def percent(part: str, whole: str) -> str:
    return f"CAST((20000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}) AS DOUBLE) / 100"
