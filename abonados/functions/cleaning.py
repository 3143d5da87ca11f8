"""Normalisation of messy text fields.

``clean_x`` works on the text as it came. ``x_from_key`` works on a key that is
already normalised; builders project the keys first, so that each is computed
once and not once per rule.

Keys are compared by equality, prefix, infix and suffix rather than by regular
expression: these compile to byte comparisons, and they do not depend on how an
engine treats newlines at ``.`` and ``$``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from abonados.functions import vocabulary as V


def _spells(word: str, rule: V.Rule) -> bool:
    return word in rule.words or any(
        word.startswith(start) and rule.contains in word and word.endswith(rule.ends)
        for start in rule.starts
    )


def _begins(key: Column, rule: V.Rule) -> Column:
    """Whether a key matches one of the rule's beginnings."""
    tests = []
    for start in rule.starts:
        test = key.startswith(start)
        if rule.contains:
            test = test & key.contains(rule.contains)
        if rule.ends:
            test = test & key.endswith(rule.ends)
        tests.append(test)
    return reduce(or_, tests)


def first_match(key: Column, rules: tuple[V.Rule, ...], otherwise: Column) -> Column:
    """Value of the first rule the key matches.

    All listed words are looked up in one constant map, which holds for each the
    value of its first rule; only other keys are tried beginning by beginning.
    """
    words = {
        word: next(rule.value for rule in rules if _spells(word, rule))
        for rule in rules
        for word in rule.words
    }
    pairs = ", ".join(f"'{word}', '{value}'" for word, value in words.items())
    listed = F.try_element_at(F.expr(f"map({pairs})"), key)
    chain = F.when(listed.isNotNull(), listed)
    for rule in rules:
        if rule.starts:
            chain = chain.when(_begins(key, rule), rule.value)
    return chain.otherwise(otherwise)


def folded(text: Column) -> Column:
    return F.lower(F.trim(text))


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters and digits."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    capitalised = F.transform(
        runs,
        lambda run: F.concat(F.upper(F.substring(run, 1, 1)), run.substr(F.lit(2), F.length(run))),
    )
    return F.array_join(capitalised, "")


def country_from_key(key: Column) -> Column:
    return first_match(key, V.COUNTRIES, F.lit(V.UNKNOWN_COUNTRY))


def clean_country(country: Column) -> Column:
    """One of five countries, otherwise ``Desconocido``."""
    return country_from_key(folded(country))


def plain_city(city: Column) -> Column:
    """The city without outer spaces and accents."""
    return F.translate(F.trim(city), V.ACCENTED, V.PLAIN)


def city_from_key(key: Column, plain: Column) -> Column:
    rules = tuple(rule for rules in V.CITIES.values() for rule in rules)
    return first_match(key, rules, title_case(plain))


def clean_city(city: Column) -> Column:
    """Canonical city without accents; unlisted names in title case.

    The rules name their key many times, and a city may be the outcome of all rules
    itself, so text and key are computed first and the rules read what they are.
    """
    keyed = F.array(F.struct(plain_city(city).alias("plain")))
    keyed = F.transform(keyed, lambda c: F.struct(F.lower(c["plain"]).alias("key"), c["plain"].alias("plain")))
    return F.element_at(F.transform(keyed, lambda c: city_from_key(c["key"], c["plain"])), 1)


def home_of_city(country: Column, clean_city: Column) -> Column:
    """As ``country_of_city``, for a city that is already cleaned."""
    homes = {rule.value: home for home, rules in V.CITIES.items() for rule in rules}
    pairs = ", ".join(f"'{city}', '{home}'" for city, home in homes.items())
    home = F.try_element_at(F.expr(f"map({pairs})"), clean_city)
    return F.when(country.isNotNull(), F.coalesce(home, country))


def country_of_city(country: Column, city: Column) -> Column:
    """The country a listed city lies in, otherwise the given country.

    A NULL country stays NULL. Cleaning a city twice changes nothing, so the
    city may be given as it came or cleaned.
    """
    return home_of_city(country, clean_city(city))


def clean_phone(phone: Column, country: Column) -> Column:
    """International number: a given prefix is kept, otherwise the country's is added."""
    digits = F.regexp_replace(_only_digits(phone), "^0+", "")
    marker = folded(phone)
    prefix = F.when(phone.rlike(r"^\+[0-9]"), "+")
    for name, code in V.DIALLING_PREFIXES.items():
        prefix = prefix.when(country == name, code)
    number = F.concat(prefix.otherwise(V.OTHER_DIALLING_PREFIX), digits)
    return F.when(~((marker == "") | marker.isin(*V.NO_PHONE)), number)


def operator_from_key(key: Column) -> Column:
    return first_match(key, V.OPERATORS, F.lit(V.UNKNOWN))


def clean_operator(operator: Column) -> Column:
    return operator_from_key(folded(operator))


def plan_type_from_key(key: Column) -> Column:
    return first_match(key, V.PLAN_TYPES, F.lit(V.UNKNOWN))


def clean_plan_type(plan_type: Column) -> Column:
    return plan_type_from_key(folded(plan_type))


def device_brand_from_key(key: Column) -> Column:
    return first_match(key, V.DEVICE_BRANDS, F.lit(V.UNKNOWN_BRAND))


def clean_device_brand(brand: Column) -> Column:
    return device_brand_from_key(folded(brand))


def clean_device_model(model: Column) -> Column:
    """``Model <digits>``; text already in that form is kept as it is."""
    digits = _only_digits(model)
    return (
        F.when(model.isNull(), V.UNKNOWN_MODEL)
        .when(model.rlike(r"^Model\s+[0-9]+\z"), model)
        .when(digits != "", F.concat(F.lit("Model "), digits))
        .otherwise(V.UNKNOWN_MODEL)
    )


def status_key(status: Column) -> Column:
    return F.upper(F.trim(status))


def customer_status_from_key(key: Column) -> Column:
    return first_match(key, V.CUSTOMER_STATUSES, F.lit(V.UNKNOWN))


def clean_customer_status(status: Column) -> Column:
    return customer_status_from_key(status_key(status))


def payment_status_from_key(key: Column) -> Column:
    return first_match(key, V.PAYMENT_STATUSES, F.lit(V.UNKNOWN))


def clean_payment_status(status: Column) -> Column:
    return payment_status_from_key(status_key(status))
