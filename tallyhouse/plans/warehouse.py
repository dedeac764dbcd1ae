"""The warehouse over the given tables: built once per session, then read by every query."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators.facts import laid_out
from tallyhouse.operators.members import Members
from tallyhouse.operators.rollups import ROLLUPS
from tallyhouse.plans.refresh import MONTHLY_MEMBERS, read_members, write_members, write_rollup
from tallyhouse.plans.store import TableStore
from tallyhouse.schemas import Star
from tallyhouse.session import shared_dir
from tallyhouse.sources import tables

DIMENSIONS = ("dates", "products", "customers", "stores", "retailers")


def _fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Changes when the input files do: size, number and age of what the tables consist of."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    seen = []
    for table in ("lineitem", "orders", "part"):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}.parquet")
        fs = path.getFileSystem(conf)
        content = fs.getContentSummary(path)
        changed = fs.getFileStatus(path).getModificationTime()
        seen += [content.getLength(), content.getFileCount(), changed]
    return tuple(seen)


def load_star(spark: SparkSession, folder: str, store: TableStore) -> Star:
    """Build the star schema from the given tables and write it. Lines are laid out before they become the wider facts."""
    facts = tables.as_facts(laid_out(tables.first_lines(spark, folder)))
    fact = store.write("fact_sales", facts, ["month_id"])
    star = tables.dimensions(spark, folder, fact)
    written = {name: store.write(f"dim_{name}", getattr(star, name)) for name in DIMENSIONS}
    return replace(star, **written)


class Views(Mapping[str, DataFrame]):
    """The persisted rollups by name; one that is missing is computed and written first."""

    def __init__(self, star: Star, store: TableStore):
        self._star = star
        self._store = store
        self._read: dict[str, tuple[str, DataFrame]] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in ROLLUPS:
            raise KeyError(name)
        path = self._store.path(name)
        if path is None:
            write_rollup(self._star, self._store, name)
            path = self._store.path(name)
        if name not in self._read or self._read[name][0] != path:
            self._read[name] = (path, self._store.read(name))
        return self._read[name][1]

    def __iter__(self) -> Iterator[str]:
        return iter(ROLLUPS)

    def __len__(self) -> int:
        return len(ROLLUPS)


class Warehouse:
    """Star schema and rollups of one set of given tables, kept for this session.

    ``first_day`` and ``as_of`` are the first and the last day of its orders. The star schema is built
    on first use: queries on landing files and on what is loaded from them have no need of it.

    They live in a folder of their own under the shared folder, so a lost executor loses nothing,
    and go when the driver ends.
    """

    def __init__(self, spark: SparkSession, folder: str):
        name = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
        self.store = TableStore(spark, f"{shared_dir(spark)}/tallyhouse/{name}")
        self.store.delete_on_exit()
        self.first_day, self.as_of = tables.span(spark, folder)
        self._spark, self._folder = spark, folder
        self._star: Star | None = None
        self._views: Views | None = None
        self._lock = threading.RLock()

    @property
    def star(self) -> Star:
        """The star schema, written on first use."""
        with self._lock:
            if self._star is None:
                self._star = load_star(self._spark, self._folder, self.store)
            return self._star

    @property
    def views(self) -> Views:
        """The rollups, each written on first use."""
        with self._lock:
            if self._views is None:
                self._views = Views(self.star, self.store)
            return self._views

    @property
    def members(self) -> Members:
        """The bitmaps of what was sold on each day and in each month, written on first use."""
        with self._lock:
            if not self.store.exists(MONTHLY_MEMBERS):
                return write_members(self.star, self.store)
        return read_members(self.store)


_OPEN: dict[tuple, Warehouse] = {}
_LOCK = threading.Lock()


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse of the tables in ``folder``: built on first use and when the tables change."""
    key = (spark.sparkContext.applicationId, folder, _fingerprint(spark, folder))
    with _LOCK:
        if key not in _OPEN:
            _OPEN[key] = Warehouse(spark, folder)
        return _OPEN[key]
