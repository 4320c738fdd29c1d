"""The layers over one directory of source tables, each stored once per session."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketworks.functions.hashing import key_hash
from docketworks.functions.rules import instant
from docketworks.plans import serving, silver
from docketworks.plans.star import StarBuilder
from docketworks.plans.versioned import VersionedStar
from docketworks.session import Sizing, prepare, spread
from docketworks.sources import feed
from docketworks.sources.hub import to_bronze
from docketworks.sources.scratch import Scratch
from docketworks.sources.snapshots import SnapshotStore

FEED_AS_OF = datetime(2024, 6, 1)
GROWING = {"orders", "customer", "lineitem", "documents"}


class Workspace:
    """Feed, bronze, silver and gold over ``sf_dir``, built when first asked for."""

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        as_of: datetime = FEED_AS_OF,
        sizing: Sizing | None = None,
    ):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = as_of
        self.sizing = sizing or Sizing()
        self._tables: dict[str, DataFrame] = {}
        orders = feed.read_table(spark, self.sf_dir, "orders")
        self.rows = orders.count()  # from the Parquet footers
        prepare(spark, self.rows, self.sizing)
        self.scratch = Scratch(spark)

    def table(self, name: str) -> DataFrame:
        """A source table; its schema is looked up once. Large ones use all cores."""
        if name not in self._tables:
            scan = feed.read_table(self.spark, self.sf_dir, name)
            self._tables[name] = spread(scan) if name in GROWING else scan
        return self._tables[name]

    # -- derived on the fly ----------------------------------------------------

    def events(self) -> DataFrame:
        return feed.court_events(
            self.table("orders"), self.table("customer"), self.table("nation"), self.as_of
        )

    def payload(self) -> DataFrame:
        return feed.as_payload(self.events())

    def bronze_of(self, payload: DataFrame) -> DataFrame:
        return to_bronze(feed.hub_records(payload), instant(self.as_of))

    def bronze(self) -> DataFrame:
        return self.bronze_of(self.payload())

    def parsed(self) -> DataFrame:
        return silver.parse(self.bronze())

    def clean(self, extras: bool = False) -> DataFrame:
        return silver.clean(self.parsed(), self.as_of, extras)

    # -- stored once -----------------------------------------------------------

    @cached_property
    def silver(self) -> DataFrame:
        return self.scratch.stage(self.clean(), "silver")

    def builder(self) -> StarBuilder:
        return StarBuilder(self.silver, self.as_of, self.scratch, self.rows, self.sizing)

    @cached_property
    def store(self) -> SnapshotStore:
        return SnapshotStore(self.spark, self.scratch.path("gold"))

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return self.builder().publish(self.store)

    @property
    def fact(self) -> DataFrame:
        return self.star[serving.FACT_TABLE]

    @cached_property
    def versioned(self) -> VersionedStar:
        """The versioned star schema after three loads in no order of time, the second delivered twice."""
        store = SnapshotStore(self.spark, self.scratch.path("versioned"))
        star = VersionedStar(store, self.as_of, self.scratch, self.rows, self.sizing)
        number = key_hash(F.col("case_id"), "load") % 3
        for load in (0, 1, 2, 1):
            star.load(self.silver.filter(number == load))
        return star

    def view(self) -> DataFrame:
        return serving.analytics_view(self.star)

    @cached_property
    def landing(self) -> str:
        """Hub records as files, for the streaming jobs."""
        target = self.scratch.path("landing")
        feed.hub_records(self.payload()).write.parquet(target)
        return target

    @cached_property
    def landing_with_copies(self) -> str:
        """The same records, every fifth delivered twice."""
        target = self.scratch.path("landing-copies")
        payload = self.payload()
        again = payload.filter(feed.key_hash(F.col("feed_key"), "dup") % 5 == 0)
        feed.hub_records(payload.unionByName(again)).write.parquet(target)
        return target


_OPEN: dict[tuple[str, str], Workspace] = {}


def open_workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of this application and directory; its stored layers are shared."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, sf_dir)
    prepare(spark, _OPEN[key].rows, _OPEN[key].sizing)
    return _OPEN[key]
