"""Access to the logical input tables of the reports.

A :class:`Tables` object hands out one lazily-built ``DataFrame`` per logical
table name (the reports' input contract, FIXTURES.md section 2).  Three
backings are provided:

* ``Tables.from_parquet_dir(spark, root)`` -- one parquet dataset per table
  under ``root/<name>`` (the production layout; partition pruning and
  predicate pushdown come from the scan);
* ``Tables.from_catalog(spark, database)`` -- tables of a metastore database;
* ``Tables.from_driver_data(spark, sf_dir)`` -- the logical tables derived from
  the TPC-H-like driver parquet (``driver_fixtures``), used by tests, the
  oracle check and the benchmark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from . import contract, driver_fixtures, schemas


# (session, source, table) whose contract check passed in this process
_VALIDATED: set[tuple] = set()


class Tables:
    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame], validate: bool = False,
                 source: str | None = None):
        self.spark = spark
        self._loader = loader
        self._validate = validate
        self._source = source
        self._cache: dict[str, DataFrame] = {}
        self._dims: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        key = name.lower()
        if key not in self._cache:
            df = self._loader(key)
            memo = (id(self.spark), self._source, key)
            if self._validate and (self._source is None or memo not in _VALIDATED):
                expected = contract.schema_of(key)
                if expected is not None:
                    contract.check(key, df, expected)
                if self._source is not None:
                    _VALIDATED.add(memo)
            self._cache[key] = df
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def dims(self, builders: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        """Dimension frames, built once per key for this set of tables.  Whether
        one is broadcast is left to the byte threshold and AQE."""
        for k, b in builders.items():
            if k not in self._dims:
                self._dims[k] = b()
        return {k: self._dims[k] for k in builders}

    def check_keys(self, names: Iterable[str] | None = None) -> None:
        """Read the tables with declared keys or single rows (all, or ``names``) and raise
        ``ContractError`` naming everything that is broken.  Opening a table does not do
        this: it is one job a table, asked for once per load of the data."""
        declared = sorted({*schemas.UNIQUE_KEYS, *schemas.SINGLE_ROWS})
        wanted = declared if names is None else [n for n in declared if n in {x.lower() for x in names}]
        problems = [p for name in wanted for p in contract.key_violations(name, self[name])]
        if problems:
            raise contract.ContractError("; ".join(problems))

    def with_overrides(self, frames: Mapping[str, DataFrame]) -> "Tables":
        """Same tables, with some replaced (used by unit tests)."""
        base = self
        over = {k.lower(): v for k, v in frames.items()}
        return Tables(self.spark, lambda n: over[n] if n in over else base[n], self._validate)

    # ---------------------------------------------------------------- factories
    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> "Tables":
        lowered = {k.lower(): v for k, v in frames.items()}

        def load(name: str) -> DataFrame:
            if name not in lowered:
                raise KeyError(f"logical table {name!r} not provided")
            return lowered[name]
        return cls(spark, load)

    @classmethod
    def from_parquet_dir(cls, spark: SparkSession, root: str, validate: bool = True) -> "Tables":
        """One parquet dataset per table under ``root``; each table is checked
        against the input contract when first used (``sources.contract``)."""
        return cls(spark, lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}"), validate,
                   source=f"parquet:{root.rstrip('/')}")

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, validate: bool = True) -> "Tables":
        return cls(spark, lambda name: spark.table(f"{database}.{name}"), validate, source=f"catalog:{database}")

    @classmethod
    def from_driver_data(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        drivers: dict[str, DataFrame] = {}

        def driver(name: str) -> DataFrame:
            if name not in drivers:
                drivers[name] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
            return drivers[name]

        defs = driver_fixtures.definitions(driver_fixtures.SPARK)

        def load(name: str) -> DataFrame:
            sql = defs[name]
            args = {t: driver(t) for t in driver_fixtures.referenced_driver_tables(sql)}
            return spark.sql(sql, **args)
        return cls(spark, load)
