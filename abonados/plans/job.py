"""The models, and running them layer by layer with a quality gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from abonados.operators import quality as Q
from abonados.operators import rejects as R
from abonados.plans import checks as K
from abonados.plans import gold, silver, views
from abonados.sources import bronze as B
from abonados.sources.tables import LayerStore

Tables = dict[str, DataFrame]
#: Table of each layer with the outcome of its checks.
CHECK_RESULTS = "check_results"
#: Tables of the silver layer about values that cleaning lost: counts, and the values.
REJECTED_VALUES, REJECTED_ROWS = "rejected_values", "rejected_rows"


@dataclass(frozen=True)
class Model:
    """How a table or view comes from others.

    ``inputs`` are handed to ``build`` in order, followed by ``as_of`` where
    ``dated`` is set. Tables that are joined by customer are stored in buckets of
    customers; ``gather`` says that the result is not partitioned that way yet.
    Models that ``convert`` raw values raise under ``strict`` where others give NULL.
    ``sliced`` ones can lose rows without being written whole (``cascade``).
    """

    name: str
    layer: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    tags: tuple[str, ...] = ()
    view: bool = False
    dated: bool = False
    bucket_by: str | None = None
    gather: bool = False
    converts: bool = False
    sliced: bool = False

    def apply(
        self, tables: Tables, as_of: Column | None = None, strict: bool = False, rejected: Observation | None = None
    ) -> DataFrame:
        given = [tables[name] for name in self.inputs]
        if self.dated:
            given.append(as_of)
        return self.build(*given, strict=strict, rejected=rejected) if self.converts else self.build(*given)


def _view(name: str, *tags: str, inputs: tuple[str, ...] = (K.ANALYTICS,)) -> Model:
    return Model(name, "gold", getattr(gold, name), inputs, ("gold", *tags), view=True)


_WITH_SERVICES = (K.SERVICES, K.DIM_SERVICES, K.ANALYTICS)

MODELS: dict[str, Model] = {
    model.name: model
    for model in (
        Model(K.CUSTOMERS, "silver", silver.customers, (K.BRONZE,), ("silver", "customers"), bucket_by="customer_id", converts=True),
        Model(K.PAYMENTS, "silver", silver.payments, (K.BRONZE,), ("silver", "payments"), bucket_by="customer_id", converts=True, sliced=True),
        Model(
            K.DIM_SERVICES, "silver", lambda raw: silver.dim_services(raw.sparkSession), (K.BRONZE,),
            ("silver", "services", "dimension"),
        ),
        Model(
            K.SERVICES, "silver", silver.customer_services, (K.BRONZE, K.DIM_SERVICES),
            ("silver", "customers", "services", "bridge"), dated=True, bucket_by="customer_id", gather=True,
            converts=True,
        ),
        Model(
            K.ANALYTICS, "gold", gold.customer_analytics, (K.CUSTOMERS, K.PAYMENTS, K.SERVICES),
            ("gold", "analytics", "customers"), dated=True, bucket_by="customer_id",
        ),
        _view("acquisition_trends_operator", "time", "operator"),
        _view("age_dist_country_operator", "age", "country_operator"),
        _view("age_distribution_by_plan", "age", "plan"),
        _view("arpu_by_plan_type", "kpi", "arpu"),
        _view("credit_score_distribution", "credit_score"),
        _view("credit_score_vs_payment_behavior", "credit_score", "payments", inputs=(K.PAYMENTS, K.ANALYTICS)),
        _view("customer_status_distribution", "status"),
        _view("customers_by_geo", "distribution", "geo"),
        _view("customers_by_operator", "distribution", "operator"),
        _view("customers_pending_payments", "payments"),
        _view("device_brand_by_country_operator", "device", "brand"),
        _view("device_brand_by_plan_type", "device", "brand", "plan"),
        _view("device_brand_popularity", "device", "brand"),
        _view("new_customers_over_time", "time"),
        _view("payment_issues_pct", "payments"),
        _view("revenue_by_geo", "revenue", "geo"),
        _view("revenue_stats_plan_operator", "revenue", "stats"),
        _view("service_combinations_popularity", "services", "combination", inputs=_WITH_SERVICES),
        _view("service_combo_revenue", "services", "revenue", inputs=_WITH_SERVICES),
        _view("services_popularity", "services", inputs=_WITH_SERVICES),
    )
}


def select_models(tag: str) -> list[Model]:
    """Models with a tag, each after the models it reads."""
    return [model for model in MODELS.values() if tag in model.tags]


def ingest(
    store: LayerStore, path, layout: str = "lines", mode: str = "FAILFAST", loaded_at: Column | None = None
) -> bool:
    """Replaces the raw documents; nothing changes if the source is empty."""
    read = {"lines": B.read_lines, "arrays": B.read_arrays}[layout]
    documents = read(store.spark, path, mode)
    return store.replace_unless_empty("bronze", K.BRONZE, B.as_bronze(documents, loaded_at))


def stored_tables(store: LayerStore) -> Tables:
    """Every stored table of the three layers, by its name."""
    layers = {K.BRONZE: "bronze", **{m.name: m.layer for m in MODELS.values() if not m.view}}
    return {name: store.read(layer, name) for name, layer in layers.items() if store.exists(layer, name)}


def build(
    store: LayerStore,
    models: list[Model],
    as_of: Column | None = None,
    strict: bool = False,
    checks: list[Q.Check] | None = None,
) -> Tables:
    """Writes the tables among the models and stores the views among them. Violations
    of ``checks`` on single rows are counted in the same pass, and so are values that got
    lost: their counts are the table ``rejected_values`` of the layer."""
    tables = stored_tables(store)
    lost: dict[str, list] = {}
    for model in models:
        rejected = Observation() if model.converts else None
        result = model.apply(tables, as_of, strict, rejected)
        if model.view:
            names = {name: store.name(MODELS[name].layer, name) for name in model.inputs}
            store.create_view(model.layer, model.name, views.text(model.name, names))
            tables[model.name] = result
        else:
            tables[model.name] = store.write(
                model.layer, model.name, result, model.bucket_by, model.gather,
                Q.conditions(checks or [], model.name), model.sliced,
            )
            if rejected:
                lost.setdefault(model.layer, []).extend(R.counted(model.name, rejected.get))
    for layer, rows in lost.items():
        # a row per field and reason
        store.write(layer, REJECTED_VALUES, store.spark.createDataFrame(rows, R.COUNTS_SCHEMA).coalesce(1))
    return tables


def quarantine(store: LayerStore) -> DataFrame:
    """Writes every rejected value of the stored documents as the table ``rejected_rows``."""
    return store.write("silver", REJECTED_ROWS, R.quarantine(store.read("bronze", K.BRONZE)))


def cascade(store: LayerStore) -> int:
    """Deletes stored payments whose customer is not stored. Not part of ``run``, which
    only reports them. Returns how many."""
    return store.delete_orphans("silver", K.PAYMENTS, K.CUSTOMERS, "customer_id")


def run_layer(
    store: LayerStore, layer: str, as_of: Column | None = None, gate: bool = True, strict: bool = False
) -> DataFrame:
    """Builds a layer and checks it. With ``gate``, failed checks of severity error raise.

    Every check is evaluated once: those on single rows while the rows are written, the
    others after it, before anything is published. All tables and views of the layer
    become current together. A layer that fails leaves the earlier one as it was; only its
    reports are kept, the tables ``check_results`` and ``rejected_values``.
    """
    checks = K.SILVER_CHECKS + K.KEY_CHECKS + K.DESCRIBED_CHECKS if layer == "silver" else K.GOLD_CHECKS
    models = select_models(layer)
    with store.publishing(layer) as block:
        tables = build(store, models, as_of, strict, checks)
        counts = {m.name: store.counts(layer, m.name) for m in models if not m.view}
        results = store.write(layer, CHECK_RESULTS, Q.run_checks(checks, tables, counts).coalesce(1))
        if gate:
            block.keep_only(CHECK_RESULTS, REJECTED_VALUES)
            Q.enforce(results)
    return results


def run(
    store: LayerStore,
    path,
    layout: str = "lines",
    mode: str = "FAILFAST",
    as_of: Column | None = None,
    gate: bool = True,
    strict: bool = False,
) -> dict[str, DataFrame]:
    """Documents to gold. A layer that fails its checks stops the layers after it."""
    ingest(store, path, layout, mode)
    day = F.current_date() if as_of is None else as_of
    return {layer: run_layer(store, layer, day, gate, strict) for layer in ("silver", "gold")}
