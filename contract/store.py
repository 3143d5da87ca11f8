"""Stored layers of one data folder, built once per application."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abonados.plans import checks as K
from abonados.plans.job import MODELS
from abonados.session import shared_dir
from abonados.sources.tables import LayerStore
from contract import documents

AS_OF = documents.AS_OF
_STORES: dict[tuple[str, str], LayerStore] = {}


def layer_store(spark: SparkSession, sf_dir: str) -> LayerStore:
    app = spark.sparkContext.applicationId
    if (app, sf_dir) not in _STORES:
        mark = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
        root = f"{shared_dir(spark)}/abonados-{app}-{mark}"
        _STORES[app, sf_dir] = LayerStore(spark, root, f"abonados_{mark}", sized_by=("bronze", K.BRONZE))
    return _STORES[app, sf_dir]


def scratch_store(spark: SparkSession) -> LayerStore:
    """A store of its own, for queries about writing."""
    mark = uuid.uuid4().hex[:12]
    return LayerStore(spark, f"{shared_dir(spark)}/abonados-scratch-{mark}", f"scratch_{mark}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table, built with all it reads if it is not there yet."""
    store = layer_store(spark, sf_dir)
    if name == K.BRONZE:
        if not store.exists("bronze", name):
            store.write("bronze", name, documents.bronze(spark, sf_dir))
        return store.read("bronze", name)
    model = MODELS[name]
    if not store.exists(model.layer, name):
        inputs = {needed: table(spark, sf_dir, needed) for needed in model.inputs}
        result = model.apply(inputs, F.lit(AS_OF))
        store.write(model.layer, name, result, model.bucket_by, model.gather, sliced=model.sliced)
    return store.read(model.layer, name)


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in names}
