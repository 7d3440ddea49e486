"""The model list and the functions that run it, layer by layer."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bazar import schemas
from bazar.operators.sorting import ordered, positions
from bazar.plans import gold, silver
from bazar.sources.csv import read_csv
from bazar.sources.lake import Lake
from bazar.sources.sqlite import read_sqlite

log = logging.getLogger(__name__)

LAYERS = ("bronze", "silver", "gold")


class CsvTable(NamedTuple):
    """A bronze table that comes from a CSV file."""

    name: str
    file: str
    schema: StructType | str | None
    multi_line: bool


class SqliteTable(NamedTuple):
    """A bronze table that comes from a table of a SQLite file."""

    name: str
    file: str
    table: str


class Model(NamedTuple):
    """A table computed from others. ``inputs`` are layer/name, in argument order."""

    layer: str
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


class Outcome(NamedTuple):
    layer: str
    table_name: str
    status: str
    message: str


def _silver(name: str, build: Callable[..., DataFrame], *inputs: str) -> Model:
    return Model("silver", name, inputs, build)


def _gold(name: str, build: Callable[..., DataFrame], *inputs: str) -> Model:
    return Model("gold", name, inputs, build)


ITEMS, ORDERS, REVIEWS = "silver/order_items_silver", "silver/orders_full_data_silver", "silver/order_reviews"
PAYMENTS, PRODUCTS, SELLERS = "silver/payments_silver", "silver/products_silver", "silver/sellers_silver"
CUSTOMERS, LOCATED_CUSTOMERS = "silver/customers_silver", "silver/aggregated_customers_silver"
LEADS, TRANSLATION = "silver/leads_qualified_silver", "bronze/product_category_name_translation_bronze"

# In an order where every input stands before the model that reads it.
MODELS: tuple[Model, ...] = (
    _silver("customers_silver", silver.customers, "bronze/customers_bronze"),
    _silver("geolocation_silver", silver.geolocation, "bronze/geolocation_bronze"),
    _silver("leads_closed_silver", silver.leads_closed, "bronze/leads_closed_bronze"),
    _silver("leads_qualified_silver", silver.leads_qualified, "bronze/leads_qualified_bronze"),
    _silver("order_items_silver", silver.order_items, "bronze/order_items_bronze"),
    _silver("orders_full_data_silver", silver.orders, "bronze/orders_bronze"),
    _silver("orders_only_delivered_silver", silver.delivered_orders, "bronze/orders_bronze"),
    _silver("payments_silver", silver.payments, "bronze/payments_bronze"),
    _silver("products_silver", silver.products, "bronze/products_bronze"),
    _silver("reviews_silver", silver.reviews, "bronze/reviews_bronze"),
    _silver("order_reviews", silver.order_reviews, "bronze/reviews_bronze"),
    _silver("sellers_silver", silver.sellers, "bronze/sellers_bronze"),
    _silver("aggregated_customers_silver", silver.aggregated_customers, CUSTOMERS, "silver/geolocation_silver"),
    _silver("aggregated_leads_silver", silver.aggregated_leads, "bronze/leads_qualified_bronze", "bronze/leads_closed_bronze"),
    _gold("agg_sellers_cancellation_rate", gold.agg_sellers_cancellation_rate, ITEMS, ORDERS, REVIEWS),
    _gold("agg_sellers_cancellation_rate_v2", gold.agg_sellers_cancellation_rate_v2, ITEMS, ORDERS, REVIEWS),
    _gold("freight_analysis", gold.freight_analysis, ITEMS, PRODUCTS, TRANSLATION),
    _gold("geo_sales", gold.geo_sales, ORDERS, ITEMS, CUSTOMERS),
    _gold("gold_customers_segmented", gold.gold_customers_segmented, ORDERS, PAYMENTS, LOCATED_CUSTOMERS),
    _gold("gold_payment_performance", gold.gold_payment_performance, PAYMENTS, ORDERS, ITEMS),
    _gold("gold_product_inventory_priority", gold.gold_product_inventory_priority, PRODUCTS, ITEMS),
    _gold("gold_product_profitability_analysis", gold.gold_product_profitability_analysis, ITEMS, PRODUCTS),
    _gold("gold_qualified_leads_priority", gold.gold_qualified_leads_priority, LEADS),
    _gold("gold_sellers_order_reviews_score", gold.gold_sellers_order_reviews_score, SELLERS, ITEMS, REVIEWS),
    _gold("gold_sellers_shipment_metrics", gold.gold_sellers_shipment_metrics, ORDERS, ITEMS, SELLERS),
    _gold("regional_demand_supply_balance", gold.regional_demand_supply_balance, LOCATED_CUSTOMERS, ORDERS, ITEMS, PAYMENTS),
    _gold("sales_by_category", gold.sales_by_category, ITEMS, PRODUCTS),
    _gold("seller_performance", gold.seller_performance, ITEMS, SELLERS),
)

BY_NAME = {model.name: model for model in MODELS}


class Given(NamedTuple):
    """What of a shared part the models take as ``parameter``."""

    parameter: str
    models: tuple[str, ...]
    read: Callable[[DataFrame], DataFrame] = lambda df: df


class Shared(NamedTuple):
    """A part that several models of a layer are given instead of computing it each. It is stored, not cached: a rank reads one
    exchange twice, which Spark does not reuse above a cached table.
    """

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    given: tuple[Given, ...]


SHARED: dict[str, tuple[Shared, ...]] = {
    "gold": (
        Shared(
            (ITEMS, ORDERS, REVIEWS, LOCATED_CUSTOMERS, PAYMENTS),
            gold.totals_and_activity,
            (
                Given(
                    "totals",
                    ("agg_sellers_cancellation_rate", "agg_sellers_cancellation_rate_v2", "gold_sellers_order_reviews_score", "gold_sellers_shipment_metrics"),
                    gold.totals_in,
                ),
                Given("activity", ("regional_demand_supply_balance",), gold.activity_in),
            ),
        ),
        Shared(
            (ITEMS,),
            gold.product_sales,
            (Given("sales", ("freight_analysis", "gold_product_inventory_priority", "gold_product_profitability_analysis", "sales_by_category")),),
        ),
    ),
}

# Other names tables are known by, per layer.
ALIASES = {
    "bronze": {"order_reviews": "reviews_bronze", "orders": "orders_bronze", "products": "products_bronze"},
    "silver": {"aggregated_customers": "aggregated_customers_silver", "products": "products_silver", "sellers": "sellers_silver"},
    "gold": {},
}


def default_sources(folder: str, prefix: str = "", database: str = "leads.sqlite") -> list[CsvTable | SqliteTable]:
    """The source files of a marketplace export in ``folder``."""
    folder = folder.rstrip("/")

    def csv(name: str, file: str, schema: str, multi_line: bool = False) -> CsvTable:
        return CsvTable(name, f"{folder}/{file}", schema, multi_line)

    return [
        csv("customers_bronze", f"{prefix}customers_dataset.csv", schemas.CUSTOMERS),
        csv("geolocation_bronze", f"{prefix}geolocation_dataset.csv", schemas.GEOLOCATION),
        csv("order_items_bronze", f"{prefix}order_items_dataset.csv", schemas.ORDER_ITEMS),
        csv("payments_bronze", f"{prefix}order_payments_dataset.csv", schemas.PAYMENTS),
        # review texts contain line breaks
        csv("reviews_bronze", f"{prefix}order_reviews_dataset.csv", schemas.REVIEWS, multi_line=True),
        csv("orders_bronze", f"{prefix}orders_dataset.csv", schemas.ORDERS),
        csv("products_bronze", f"{prefix}products_dataset.csv", schemas.PRODUCTS),
        csv("sellers_bronze", f"{prefix}sellers_dataset.csv", schemas.SELLERS),
        csv("product_category_name_translation_bronze", "product_category_name_translation.csv", schemas.CATEGORY_TRANSLATION),
        SqliteTable("leads_qualified_bronze", f"{folder}/{database}", "leads_qualified"),
        SqliteTable("leads_closed_bronze", f"{folder}/{database}", "leads_closed"),
    ]


def extract_csv(lake: Lake, file: str, name: str, mode: str = "overwrite", schema: StructType | str | None = None, *, multi_line: bool) -> None:
    """Land a CSV file as a bronze table."""
    lake.write(read_csv(lake.spark, file, schema, multi_line=multi_line), "bronze", name, mode)


def extract_sqlite(lake: Lake, file: str, table: str, name: str, mode: str = "overwrite") -> None:
    """Land a SQLite table as a bronze table."""
    lake.write(read_sqlite(lake.spark, file, table), "bronze", name, mode)


def table(lake: Lake, layer: str, name: str) -> DataFrame:
    """Read a lake table by its name or one of its other names."""
    return lake.read(layer, ALIASES[layer].get(name, name))


def sorted_table(lake: Lake, name: str, position: str | None = None) -> DataFrame:
    """A gold table in the order its report shows. ``position`` names a column for the place of each row, for readers that do not keep the order."""
    df = table(lake, "gold", name)
    if position is not None:
        return positions(df, gold.ORDER.get(name, ()), position)
    return ordered(df, gold.ORDER[name]) if name in gold.ORDER else df


def run_model(lake: Lake, model: str | Model, mode: str = "overwrite", **parameters: Any) -> None:
    """Build one model from the lake and store it."""
    model = BY_NAME[model] if isinstance(model, str) else model
    inputs = [lake.read(*source.split("/")) for source in model.inputs]
    lake.write(model.build(*inputs, **parameters), model.layer, model.name, mode)


def run_query(lake: Lake, sql: str, layer: str, name: str, mode: str = "overwrite") -> None:
    """Store the result of one SQL statement over the registered views."""
    lake.write(lake.spark.sql(sql), layer, name, mode)


def _attempt(layer: str, name: str, work: Callable[[], None], on_error: str) -> Outcome:
    log.info("%s/%s: start", layer, name)
    try:
        work()
    except Exception as error:
        if on_error == "raise":
            raise
        log.exception("%s/%s: failed, previous table kept", layer, name)
        return Outcome(layer, name, "failed", str(error).splitlines()[0])
    return Outcome(layer, name, "ok", "")


def _run_all(jobs: Iterable[tuple[str, str, Callable[[], None]]], on_error: str, parallel: int) -> list[Outcome]:
    """Run jobs that do not read each other. Several at once fill the cluster while one has few tasks left."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(lambda job: _attempt(*job, on_error), jobs))


def run_bronze(
    lake: Lake,
    sources: Iterable[CsvTable | SqliteTable],
    mode: str = "overwrite",
    on_error: str = "raise",
    parallel: int = 1,
    landed: Callable[[CsvTable | SqliteTable], None] | None = None,
) -> list[Outcome]:
    """``landed`` is called with each source whose table is stored, to archive or remove its file."""

    def land(source: CsvTable | SqliteTable) -> None:
        if isinstance(source, CsvTable):
            extract_csv(lake, source.file, source.name, mode, source.schema, multi_line=source.multi_line)
        else:
            extract_sqlite(lake, source.file, source.table, source.name, mode)
        if landed is not None:
            landed(source)

    return _run_all([("bronze", source.name, partial(land, source)) for source in sources], on_error, parallel)


@contextmanager
def _computed_once(
    lake: Lake, layer: str, parallel: int, parameters: Mapping[str, Mapping[str, Any]]
) -> Iterator[Mapping[str, Mapping[str, Any]]]:
    """The parameters of a layer with its shared parts added, stored beside the layers until this one is done.

    A model with parameters of its own computes its part itself, as do all where a part fails: then each fails, or not, by itself.
    """
    folder = f"{lake.root}/_shared/{uuid.uuid4().hex}"

    def stored(number: int, part: Shared) -> DataFrame | None:
        path = f"{folder}/{number}"
        try:
            df = part.build(*[lake.read(*source.split("/")) for source in part.inputs])
            df.write.parquet(path)
            return lake.spark.read.schema(df.schema).parquet(path)
        except Exception:
            log.exception("%s: %s not shared", layer, ", ".join(given.parameter for given in part.given))
            return None

    parts = SHARED.get(layer, ())
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            tables = list(pool.map(stored, range(len(parts)), parts))
        taken = [(given, df) for part, df in zip(parts, tables) if df is not None for given in part.given]
        yield {**parameters, **{name: {given.parameter: given.read(df)} for given, df in taken for name in given.models if not parameters.get(name)}}
    finally:
        if parts:
            lake.remove(folder)


def _run_layer(
    lake: Lake, layer: str, mode: str, on_error: str, parallel: int, parameters: Mapping[str, Mapping[str, Any]]
) -> list[Outcome]:
    models = [model for model in MODELS if model.layer == layer]
    # models that read their own layer come after all others
    later = [model for model in models if any(source.startswith(f"{layer}/") for source in model.inputs)]
    outcomes = []
    with _computed_once(lake, layer, parallel, parameters) as given:
        for wave in ([model for model in models if model not in later], later):
            jobs = [(layer, m.name, partial(run_model, lake, m, mode, **given.get(m.name, {}))) for m in wave]
            outcomes += _run_all(jobs, on_error, parallel)
    return outcomes


def run_silver(
    lake: Lake, mode: str = "overwrite", on_error: str = "raise", parallel: int = 1, run_at: dt.datetime | None = None
) -> list[Outcome]:
    return _run_layer(lake, "silver", mode, on_error, parallel, {"order_reviews": {"run_at": run_at}})


def run_gold(
    lake: Lake, mode: str = "overwrite", on_error: str = "raise", parallel: int = 1, **parameters: Mapping[str, Any]
) -> list[Outcome]:
    """``parameters`` are keyword arguments per model name."""
    return _run_layer(lake, "gold", mode, on_error, parallel, parameters)


def run_pipeline(
    lake: Lake,
    stage: str = "full",
    sources: Iterable[CsvTable | SqliteTable] = (),
    mode: str = "overwrite",
    on_error: str = "raise",
    parallel: int = 1,
    run_at: dt.datetime | None = None,
    landed: Callable[[CsvTable | SqliteTable], None] | None = None,
) -> list[Outcome]:
    """Run one layer, or all three for ``full``. ``landed`` is that of ``run_bronze``.

    The first failure stops the run; with ``on_error="skip"`` the failing table keeps its
    previous content, the rest is built, and the outcome list says which is which.
    """
    if stage not in ("full", *LAYERS):
        raise ValueError(f"unknown stage {stage!r}")
    outcomes: list[Outcome] = []
    if stage in ("full", "bronze"):
        outcomes += run_bronze(lake, sources, mode, on_error, parallel, landed)
    if stage in ("full", "silver"):
        outcomes += run_silver(lake, mode, on_error, parallel, run_at)
    if stage in ("full", "gold"):
        outcomes += run_gold(lake, mode, on_error, parallel)
    return outcomes


def outcome_table(spark: SparkSession, outcomes: Iterable[Outcome]) -> DataFrame:
    return spark.createDataFrame(list(outcomes), "layer string, table_name string, status string, message string")
