"""Names to DataFrames: raw sources, and the models built on them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tradeloom.plans.gold import FACT_DATES, GOLD_MODELS, ORDER_DATES
from tradeloom.plans.quality import observed, row_rules
from tradeloom.plans.silver import SILVER_MODELS, SPECS, silver, silver_keys
from tradeloom.sources.batches import commits, committed
from tradeloom.sources.buckets import Buckets
from tradeloom.sources.ingest import expected_bronze
from tradeloom.sources.keymap import KeyMaps
from tradeloom.sources.newest import NewestState
from tradeloom.sources.specs import SOURCES
from tradeloom.sources.warehouse import Warehouse, by_month

MODELS = {**SILVER_MODELS, **GOLD_MODELS}

# The input that a model reads once, as its only one or for few of its columns. The marts read facts that are stored:
# their distinct pairs combine better before the shuffle where rows of a month are together.
READ_ONCE = {
    **{name: spec.source for name, spec in SPECS.items()},
    "dim_channels": "fact_sales",
    "key_customers": "fact_sales",
    "key_orders": "fact_sales",
}


class Catalog(Mapping[str, DataFrame]):
    """Tables by name, each built once and stored.

    A table is written to ``folder`` when first needed and read back from there.
    Layers are then cut from each other as in a production run: a later model
    scans only the columns it needs, lineage stays short, and Spark knows each
    input's real size when it chooses between broadcast and sort-merge. Inputs
    named in ``READ_ONCE`` are not stored for such a reader alone: its rows come
    straight from their model, in the columns that the reader needs.
    """

    def __init__(self, spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], folder: str):
        self.spark = spark
        self._sources = sources
        self._folder = folder
        self._stored: dict[str, DataFrame] = {}

    def plan(self, name: str) -> DataFrame:
        """The model itself over its stored inputs, not stored."""
        return MODELS[name](self) if name in MODELS else self._sources[name]()

    def direct(self, name: str) -> DataFrame:
        """The same rows as ``plan``; an input that the model reads once is not stored for it."""
        return MODELS[name](ReadOnce(self, READ_ONCE.get(name, ()))) if name in MODELS else self._sources[name]()

    def once(self, name: str) -> DataFrame:
        """A table's rows for one reader: from its files if it is stored, else from its model."""
        return self[name] if name in self._stored or name not in self else self.direct(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        if name not in self._stored:
            path = f"{self._folder}/{name}"
            frame = self.direct(name)
            laid_out = by_month(frame, FACT_DATES[name]) if name in FACT_DATES else frame
            laid_out.write.mode("overwrite").parquet(path)
            self._stored[name] = self.spark.read.schema(frame.schema).parquet(path)
        return self._stored[name]

    def has(self, name: str) -> bool:
        """Whether a table is stored already."""
        return name in self._stored

    def folder_of(self, name: str) -> str:
        """Folder of a table's files, stored first if need be."""
        self[name]
        return f"{self._folder}/{name}"

    def __contains__(self, name: object) -> bool:
        return name in self._sources or name in MODELS

    def __iter__(self) -> Iterator[str]:
        return iter([*self._sources, *MODELS])

    def __len__(self) -> int:
        return len(self._sources) + len(MODELS)


class ReadOnce(Mapping[str, DataFrame]):
    """A catalog's tables for a reader that reads those named a single time."""

    def __init__(self, cat: Catalog, names: str | Iterable[str]):
        self._cat = cat
        self.spark = cat.spark
        self._names = {names} if isinstance(names, str) else set(names)

    def __getitem__(self, name: str) -> DataFrame:
        return self._cat.once(name) if name in self._names else self._cat[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._cat)

    def __len__(self) -> int:
        return len(self._cat)


# Columns that no two rows of a dimension share.
UNIQUE = {"dim_customers": "customer_id", "dim_products": "product_id", "dim_distributors": "distributor_id"}

# Silver tables whose rows are alike within an order.
TOGETHER = {name: ("order_id",) for name in ORDER_DATES if name in SPECS}


class Straight(Mapping[str, DataFrame]):
    """A catalog's tables for one reader that passes once through the named ones, and from each to the next.

    None of these is stored for it, at any depth, so that only the columns it needs are moved; one that is stored
    already is read from its files. A model gets the dimensions with their key ``declared``: where nobody reads the
    column that a lookup adds, Spark then leaves the lookup out, as it neither adds nor drops rows.
    """

    def __init__(
        self, cat: Catalog, names: Iterable[str], by_group: bool = False, declared: bool = False,
        stored: Mapping[str, DataFrame] | None = None,
    ):
        self._cat = cat
        self.spark = cat.spark
        self._names = frozenset(names)
        self._declared = declared
        #: Tables that are stored elsewhere, to be read from there.
        self._elsewhere = stored or {}
        #: Whether a mart brings the lines of a group together before it counts, as lines come in no order.
        self.by_group = by_group

    def __getitem__(self, name: str) -> DataFrame:
        if self._declared and name in UNIQUE:
            return self._cat[name].dropDuplicates([UNIQUE[name]])
        if name in self._elsewhere:
            return self._elsewhere[name]
        if name not in self._names or self._cat.has(name):
            return self._cat.once(name) if name.startswith("raw.") else self._cat[name]
        return self.model(name)

    def model(self, name: str) -> DataFrame:
        """A model over these tables, also where its own table is stored."""
        if name in TOGETHER:
            return silver(SPECS[name], self[SPECS[name].source], together=TOGETHER[name])
        return MODELS[name](Straight(self._cat, self._names, self.by_group, True, self._elsewhere))

    def __iter__(self) -> Iterator[str]:
        return iter(self._cat)

    def __len__(self) -> int:
        return len(self._cat)


class SilverKeys(Mapping[str, DataFrame]):
    """The key columns of a catalog's Silver tables, straight from their sources unless a table is stored already."""

    def __init__(self, cat: Catalog):
        self._cat = cat

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SPECS or self._cat.has(name):
            return self._cat[name]
        return silver_keys(SPECS[name], self._cat.once(SPECS[name].source), TOGETHER.get(name, ()))

    def __iter__(self) -> Iterator[str]:
        return iter(SILVER_MODELS)

    def __len__(self) -> int:
        return len(SILVER_MODELS)


class StoredTables(Mapping[str, DataFrame]):
    """The tables of a warehouse under the names the models use.

    A Bronze table has every column its model reads; one that no load brought yet is NULL. Batches that never got
    their audit row are not read. With ``states``, Silver models of one row per key are read from the states that
    ``refresh_silver`` keeps.
    """

    def __init__(self, warehouse: Warehouse, states: bool = False):
        self._warehouse = warehouse
        self._states = states
        #: Surrogate keys are stored beside the tables, so that a rebuild moves none.
        self.key_maps = KeyMaps(warehouse)

    @staticmethod
    def _place(name: str) -> tuple[str, str]:
        if name.startswith("raw."):
            return "raw", name.removeprefix("raw.")
        return ("staging" if name in SILVER_MODELS else "dwh"), name

    def __getitem__(self, name: str) -> DataFrame:
        table = name.removeprefix("raw.")
        if name != table and table in SOURCES:
            return expected_bronze(committed(self._warehouse, table), SOURCES[table])
        if self._states and name in SPECS:
            return silver_state(self._warehouse, name).rows()
        return self._warehouse.table(*self._place(name))

    def __iter__(self) -> Iterator[str]:
        return iter(MODELS)

    def __len__(self) -> int:
        return len(MODELS)


def silver_state(warehouse: Warehouse, model: str, parts: int = 64) -> NewestState:
    return NewestState(warehouse, model, SPECS[model].key, parts=parts)


def refresh_silver(warehouse: Warehouse, model: str, parts: int = 64) -> list[int]:
    """Merge the batches that came since the last refresh into a Silver model's state; returns the parts rewritten.

    Only these batches are read, cleaned and typed. The state then equals the model built from all batches.
    """
    source = SPECS[model].source.removeprefix("raw.")
    state = silver_state(warehouse, model, parts)
    had = state.merged()
    new = sorted(r.batch_id for r in commits(warehouse, source).collect() if r.batch_id not in had)  # one name a load
    if not new and state.exists():
        return []
    return state.merge(new_rows(warehouse, model, new), new)


def new_rows(warehouse: Warehouse, model: str, batches: list[str]) -> DataFrame:
    """A Silver model over some batches alone."""
    source = SPECS[model].source.removeprefix("raw.")
    return silver(SPECS[model], expected_bronze(committed(warehouse, source, batches), SOURCES[source]))


def build(
    warehouse: Warehouse, models: list[str] | None = None, incremental: bool = False, report: list[tuple] | None = None,
    order_buckets: int | None = None,
) -> StoredTables:
    """Rebuild models from a warehouse's Bronze tables, in dependency order.

    When ``incremental``, Silver models of one row per key take in new batches only. A list given as ``report`` gets
    the rows of the row rules, counted by the writes themselves; ``quality.report_of`` makes a table of them.
    With ``order_buckets``, the order tables are laid out in so many buckets of order ids instead of by month.
    """
    tables = StoredTables(warehouse, incremental)
    for name in models or MODELS:
        if incremental and name in SPECS:
            refresh_silver(warehouse, name)
            continue
        rows = write_checked(warehouse, name, MODELS[name](tables), report is not None, order_layout(name, order_buckets))
        if report is not None:
            report += rows
    return tables


def order_layout(name: str, count: int | None) -> Buckets | None:
    """Buckets by order id for the order tables, Silver and Gold; none for others."""
    return Buckets(("order_id",), count, (ORDER_DATES[name],)) if count and name in ORDER_DATES else None


def write_checked(
    warehouse: Warehouse, name: str, df: DataFrame, checked: bool = True, buckets: Buckets | None = None,
) -> list[tuple]:
    """Replace a model's table; the report rows of its row rules, as the write counted them."""
    rows: list[Callable[[], list[tuple]]] = []

    def watch(written: DataFrame) -> DataFrame:
        watched, found = observed(written, row_rules(name) if checked else [])
        rows.append(found)
        return watched

    layer, table = StoredTables._place(name)
    warehouse.materialize(df, layer, table, FACT_DATES.get(name), watch, buckets)
    return rows[0]()
