"""Source registry: ``src(system, table)`` resolves a logical raw table to a
DataFrame that conforms to its contract (``schemas.RAW``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monthwise.fixture import FIXTURE
from monthwise.params import Params
from monthwise.session import footer_counts
from monthwise.sources import schemas

Key = tuple[str, str]


class Sources:
    """Maps ``(system, table)`` to a zero-argument loader.

    DataFrames are created once per key and reused, so every model that reads
    the same raw table shares one logical scan (Spark reuses identical
    exchanges/subplans inside one query)."""

    def __init__(self, spark: SparkSession, loaders: dict[Key, Callable[[], DataFrame]],
                 params: Params | None = None):
        self.spark = spark
        self.params = params
        self._loaders = dict(loaders)
        self._frames: dict[Key, DataFrame] = {}

    def __call__(self, system: str, table: str) -> DataFrame:
        key = (system, table)
        if key not in self._frames:
            if key not in self._loaders:
                raise KeyError(f"unknown source {system}.{table}")
            self._frames[key] = self._loaders[key]()
        return self._frames[key]

    def counted(self, system: str, table: str) -> DataFrame:
        """The table through Spark's v2 file scan, which answers ``count`` from the Parquet
        footers (``PushedAggregation``) where no filter stands in between."""
        with footer_counts(self.spark):
            return self._loaders[(system, table)]()

    def register(self, system: str, table: str, loader: Callable[[], DataFrame]) -> None:
        self._loaders[(system, table)] = loader
        self._frames.pop((system, table), None)

    def replaced(self, system: str, table: str, frame: DataFrame) -> "Sources":
        """The same sources but for one table."""
        out = Sources(self.spark, self._loaders, self.params)
        out._frames = {**self._frames, (system, table): frame}
        out._loaders[(system, table)] = lambda: frame
        return out

    def keys(self) -> list[Key]:
        return sorted(self._loaders)

    # -- constructors -------------------------------------------------------
    @classmethod
    def from_test_tables(cls, spark: SparkSession, sf_dir: str, params: Params = FIXTURE) -> "Sources":
        """Raw tables derived from the driver's parquet test tables (FIXTURES.md)."""
        from monthwise.sources.adapters import ADAPTERS

        loaders = {k: (lambda f=f: f(spark, sf_dir, params)) for k, f in ADAPTERS.items()}
        src = cls(spark, loaders, params)

        def sessions():
            from monthwise.operators.sessions import app_sessions
            return schemas.conform(app_sessions(src("app_db", "events"), params), schemas.APP_SESSIONS)

        src.register("app_db", "sessions", sessions)
        # the order log itself (change history for N7, order totals for M9)
        from monthwise.sources.adapters import read_table
        for t in ("orders", "customer"):
            src.register("tpch", t, lambda t=t: read_table(spark, sf_dir, t))
        return src

    @classmethod
    def from_paths(cls, spark: SparkSession, root: str, fmt: str = "parquet",
                   params: Params | None = None) -> "Sources":
        """Raw tables stored as ``{root}/{system}/{table}``, read with their contract
        schema (no inference; filters and projections push into the scan)."""
        def loader(key: Key):
            return lambda: (spark.read.schema(schemas.RAW[key]).format(fmt)
                            .load(f"{root.rstrip('/')}/{key[0]}/{key[1]}"))
        return cls(spark, {k: loader(k) for k in schemas.RAW}, params)
