"""Fixed values of the cleaning rules.

The spellings, prefixes, labels, codes and formats below are given by the
data model: results are only right if they are exactly these. Order matters,
the first matching rule wins.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """Spellings of one canonical value.

    A key matches when it is one of ``words``, or when it begins with one of
    ``starts`` and also holds ``contains`` and finishes with ``ends``.
    """

    value: str
    words: tuple[str, ...]
    starts: tuple[str, ...] = ()
    contains: str = ""
    ends: str = ""


# --- fixed values: accents removed from city names ------------------------------
ACCENTED = "áéíóúüñÁÉÍÓÚÜÑ"
PLAIN = "aeiouunAEIOUUN"

# --- fixed values: countries ----------------------------------------------------
COUNTRIES = (
    Rule("Argentina", ("ar", "arg", "argentina", "argentin", "argentna"), ("arg",)),
    Rule("México", ("mx", "mex", "mexico", "méx", "mejico", "mexco"), ("mex", "méx")),
    Rule("Colombia", ("co", "col", "colombia", "colombi", "colomia", "colmbia"), ("col",)),
    Rule("Perú", ("pe", "per", "peru", "pru", "pero"), ("per", "pru")),
    Rule("Chile", ("cl", "chl", "chile", "chle", "chil", "chi"), ("chi", "chl")),
)
UNKNOWN_COUNTRY = "Desconocido"

# --- fixed values: cities, by the country they lie in ---------------------------
CITIES = {
    "Colombia": (
        Rule("Bogota", ("bogota", "bogta"), ("bog",)),
        Rule("Medellin", ("medellin", "medelin"), ("medel",)),
        Rule("Cali", ("cali", "cal")),
        Rule("Barranquilla", ("barranquilla", "barranquila"), ("barran",)),
    ),
    "Argentina": (
        Rule("Buenos Aires", ("buenos aires", "buenos_aires", "buenosaires"), ("buenos",)),
        Rule("Cordoba", ("cordoba", "coroba"), ("cor",), ends="ba"),
        Rule("Rosario", ("rosario", "rosrio"), ("rosar",)),
    ),
    "México": (
        Rule("Ciudad de Mexico", ("ciudad de mexico", "cdmx", "mexico city"), ("ciudad",), contains="mex"),
        Rule("Guadalajara", ("guadalajara", "guadaljara", "gdl"), ("guadal",)),
        Rule("Monterrey", ("monterrey", "monterey", "mty"), ("monter",)),
    ),
    "Perú": (
        Rule("Lima", ("lima", "lma"), ("lim",)),
        Rule("Arequipa", ("arequipa", "areqipa", "arequpa"), ("areq",)),
        Rule("Trujillo", ("trujillo", "trujilo", "trjllo"), ("truj",)),
    ),
    "Chile": (
        Rule("Santiago", ("santiago", "santigo", "stgo"), ("sant",), ends="go"),
        Rule("Valparaiso", ("valparaiso", "valpo"), ("valpar",)),
        Rule("Concepcion", ("concepcion", "conce"), ("concep",)),
    ),
}

# --- fixed values: dialling prefixes --------------------------------------------
DIALLING_PREFIXES = {
    "Argentina": "+54",
    "México": "+52",
    "Colombia": "+57",
    "Perú": "+51",
    "Chile": "+56",
}
OTHER_DIALLING_PREFIX = "+1"
NO_PHONE = ("unknown", "n/a")

# --- fixed values: operators, plans, devices ------------------------------------
OPERATORS = (
    Rule("MOVISTAR", ("movistar", "movistr", "movstr", "mov", "movi"), ("mov",)),
    Rule("TIGO", ("tigo", "tgo", "tig", "tygo"), ("tig", "tgo")),
    Rule("CLARO", ("claro", "cla", "clar", "clr"), ("cla",)),
    Rule("WOM", ("wom", "w0m", "vom", "wm", "won"), ("wom", "w0m", "won")),
)
PLAN_TYPES = (
    Rule("PREPAGO", ("pre", "pre-pago", "pre_pago", "prepago"), ("pre",)),
    Rule("POSTPAGO", ("post-pago", "post_pago", "pospago", "pos"), ("post", "pos")),
    Rule("CONTROL", ("ctrl", "control", "contrrol"), ("ctrl", "control", "contrrol")),
)
DEVICE_BRANDS = (
    Rule("Samsung", ("samsung", "samsun", "samsg", "samung"), ("sam",)),
    Rule("Apple", ("apple", "aple", "appl", "appel"), ("app",)),
    Rule("Xiaomi", ("xiaomi", "xiomi", "xiami", "xaomi"), ("xia",)),
    Rule("Huawei", ("huawei", "hauwei", "huwai", "huwei"), ("hua",)),
)
UNKNOWN = "UNKNOWN"
UNKNOWN_BRAND = "Unknown"
UNKNOWN_MODEL = "Model Unknown"

# --- fixed values: statuses (compared in upper case) ----------------------------
CUSTOMER_STATUSES = (
    Rule("ACTIVE", ("ACTIVE", "ACTIVO")),
    Rule("INACTIVE", ("INACTIVE", "INACTIVO")),
    Rule("SUSPENDED", ("SUSPENDED", "SUSPENDIDO")),
)
PAYMENT_STATUSES = (
    Rule("COMPLETED", ("PAID", "COMPLETED", "SUCCESS")),
    Rule("PENDING", ("PENDING", "PROCESSING")),
    Rule("FAILED", ("FAILED", "ERROR", "DECLINED")),
    Rule("LATE", ("LATE",)),
)

# --- fixed values: services ------------------------------------------------------
SERVICES = ((1, "VOICE"), (2, "SMS"), (3, "DATA"), (4, "ROAMING"), (5, "INTERNATIONAL"))

# --- fixed values: first surrogate customer id ----------------------------------
SURROGATE_BASE = 9_000_000

# --- fixed values: accepted shapes of text (Java regular expressions) -----------
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}T"
MONTH_DAY_YEAR = r"^\d{2}-\d{2}-\d{4}\z"
YEAR_MONTH_DAY = r"^\d{4}-\d{2}-\d{2}\z"
SIGNED_NUMBER = r"^-?[0-9]+(\.[0-9]+)?\z"
DIGITS = r"^[0-9]+\z"

# --- fixed values: buckets --------------------------------------------------------
# (upper bound inclusive, label); the last label has no upper bound.
CREDIT_SCORE_RANGES = (
    (579, "POOR (<580)"),
    (669, "FAIR (580-669)"),
    (739, "GOOD (670-739)"),
    (799, "VERY GOOD (740-799)"),
    (None, "EXCELLENT (800+)"),
)
AGE_BUCKETS = (
    (17, "0-17"),
    (24, "18-24"),
    (34, "25-34"),
    (44, "35-44"),
    (54, "45-54"),
    (None, "55+"),
)
