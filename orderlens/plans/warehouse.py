"""Layered rebuild: raw lines, staging, fact, marts."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from orderlens.operators.staging import fact, stage
from orderlens.plans import marts
from orderlens.plans.marts import MARTS
from orderlens.sources.tables import (
    count_rows,
    counted,
    current,
    read_fact,
    read_table,
    replace,
    rows_counted,
    write_fact,
    write_table,
    written_aside,
)

RAW_TABLE = "raw_order_lines"
STAGING_VIEW = "stg_sales"
FACT_TABLE = "fct_sales"


@dataclass
class Warehouse:
    """Tables written under one folder; every read is lazy.

    A rebuild leaves every table readable: a new snapshot of it becomes current when it is
    whole. ``written`` has the rows of the tables that this object wrote.

    The files of the fact are listed on first use and again after each build, not
    for every query. When another process rebuilt the tables, make a new object.
    """

    spark: SparkSession
    folder: str
    _fact: DataFrame | None = field(default=None, repr=False, compare=False)
    written: dict = field(default_factory=dict, repr=False, compare=False)

    def _path(self, name):
        return f"{self.folder.rstrip('/')}/{name}"

    def build(self, raw: DataFrame, strict_dates=False, wide_amounts=False):
        """Replace everything. Each layer reads the written one below, not its lineage."""
        self.build_fact(raw, strict_dates, wide_amounts)
        self.build_marts()
        return self

    def build_fact(self, raw, strict_dates=False, wide_amounts=False):
        """Replace the raw table and the fact; the source is read once."""
        self._replace(RAW_TABLE, raw, write_table)
        staged = stage(self.raw(), strict_dates)
        staged.createOrReplaceTempView(STAGING_VIEW)
        # What follows the count is compiled apart from what comes before: in one piece both are
        # longer than what the JVM compiles, and run five times as long.
        self._replace(FACT_TABLE, staged, lambda df, folder: write_fact(fact(df, wide_amounts), folder), "order_ts")
        self._fact = None
        return self

    def _replace(self, name, df, write, column="*"):
        """Readers have the table before or the new one throughout; its rows are counted on the way."""
        seen = Observation()
        replace(self.spark, self._path(name), lambda folder: write(counted(df, seen, column), folder))
        self.written[name] = rows_counted(seen)

    def build_marts(self):
        """Replace the marts, all from one pass over the fact."""
        totals = written_aside(marts.totals_of_all(self.fact()))
        for name, mart in MARTS.items():
            self._replace(name, mart.rolled_up(totals), write_table)
        return self

    def raw(self):
        """The source's lines as they came, whatever their columns."""
        return self._read(RAW_TABLE)

    def _read(self, name):
        return read_table(self.spark, current(self.spark, self._path(name)))

    def undated_lines(self):
        """Number of raw lines that the fact lacks because they have no order date."""
        if {RAW_TABLE, FACT_TABLE} <= self.written.keys():
            return self.written[RAW_TABLE] - self.written[FACT_TABLE]
        return self.raw().count() - self.fact().count()

    def fact(self):
        if self._fact is None:
            self._fact = read_fact(self.spark, current(self.spark, self._path(FACT_TABLE)))
        return self._fact

    def mart(self, name):
        return self._read(name)

    def tables(self):
        return {RAW_TABLE: self.raw(), FACT_TABLE: self.fact(), **{name: self.mart(name) for name in MARTS}}

    def row_counts(self):
        """Rows per object, raw table included."""
        return count_rows(self.tables())
