"""Data-quality checks that run as Spark jobs and can gate a layer.

Every check yields its violations as a DataFrame. ``run_checks`` counts them:
all checks on single rows of a table share one scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """A check on one table. ``severity`` says whether it may stop a run."""

    table: str
    severity: str = ERROR

    @property
    def name(self) -> str:
        raise NotImplementedError

    def violations(self, tables: dict[str, DataFrame]) -> DataFrame:
        raise NotImplementedError

    def failures(self, tables: dict[str, DataFrame]) -> DataFrame:
        """One row, one column ``failures``."""
        return self.violations(tables).agg(F.count("*").alias("failures"))


@dataclass(frozen=True)
class RowCheck(Check):
    """A check that each row passes or fails by itself."""

    def violated(self) -> Column:
        raise NotImplementedError

    def violations(self, tables):
        return tables[self.table].filter(self.violated())


@dataclass(frozen=True)
class NotNull(RowCheck):
    column: str = ""

    @property
    def name(self):
        return f"not_null_{self.column}"

    def violated(self):
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues(RowCheck):
    """NULL passes."""

    column: str = ""
    values: tuple[str, ...] = ()

    @property
    def name(self):
        return f"accepted_values_{self.column}"

    def violated(self):
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class AcceptedRange(RowCheck):
    """NULL passes. Bounds belong to the range if ``inclusive``."""

    column: str = ""
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True

    @property
    def name(self):
        return f"accepted_range_{self.column}"

    def violated(self):
        value, outside = F.col(self.column), []
        if self.min_value is not None:
            outside.append(value < self.min_value if self.inclusive else value <= self.min_value)
        if self.max_value is not None:
            outside.append(value > self.max_value if self.inclusive else value >= self.max_value)
        return reduce(lambda a, b: a | b, outside)


@dataclass(frozen=True)
class RowsMatching(RowCheck):
    """Rows that fulfil a SQL condition are violations."""

    label: str = ""
    condition: str = ""

    @property
    def name(self):
        return self.label

    def violated(self):
        return F.expr(self.condition)


@dataclass(frozen=True)
class Unique(Check):
    """Violations are the keys that occur more than once; NULL keys are left out."""

    columns: tuple[str, ...] = ()

    @property
    def name(self):
        return "unique_" + "_".join(self.columns)

    def violations(self, tables):
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.columns])
        return (
            tables[self.table]
            .filter(present)
            .groupBy(*self.columns)
            .agg(F.count("*").alias("occurrences"))
            .filter("occurrences > 1")
        )


@dataclass(frozen=True)
class Relationship(Check):
    """Violations are rows whose key is missing in the parent; NULL keys pass."""

    column: str = ""
    parent: str = ""
    parent_column: str = ""

    @property
    def name(self):
        return f"relationships_{self.column}_{self.parent}"

    def _parents(self, tables):
        return tables[self.parent].select(F.col(self.parent_column).alias(self.column))

    def violations(self, tables):
        children = tables[self.table].filter(F.col(self.column).isNotNull())
        return children.join(self._parents(tables), self.column, "left_anti")

    def failures(self, tables):
        """Rows are counted per key before the join, so that hot keys are one row."""
        counted = (
            tables[self.table]
            .filter(F.col(self.column).isNotNull())
            .groupBy(self.column)
            .agg(F.count("*").alias("n"))
        )
        orphans = counted.join(self._parents(tables), self.column, "left_anti")
        return orphans.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("failures"))


def primary_key(table: str, *columns: str, severity: str = ERROR) -> list[Check]:
    """A key is unique and has no NULL part."""
    return [Unique(table, severity, columns), *[NotNull(table, severity, c) for c in columns]]


def conditions(checks: list[Check], table: str) -> dict[str, Column]:
    """What to count, by check, while the rows of a table are written."""
    return {c.name: c.violated() for c in checks if isinstance(c, RowCheck) and c.table == table}


def _row_checks_of(table: str, checks: list[RowCheck], tables: dict[str, DataFrame]) -> DataFrame:
    counted = tables[table].agg(
        *[F.count_if(check.violated()).alias(f"c{i}") for i, check in enumerate(checks)]
    )
    rows = F.array(*[_result(check, F.col(f"c{i}")) for i, check in enumerate(checks)])
    return counted.select(F.inline(rows))


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def run_checks(
    checks: list[Check], tables: dict[str, DataFrame], counts: dict[str, dict[str, int]] | None = None
) -> DataFrame:
    """``table_name``, ``check_name``, ``severity`` and ``failures``, a row per check.

    ``counts`` holds, by table, what was counted while it was written: checks on single
    rows of these tables read nothing again.
    """
    parts, by_table, known = [], {}, []
    for check in dict.fromkeys(checks):
        counted = (counts or {}).get(check.table) or {}
        if isinstance(check, RowCheck) and check.name in counted:
            known.append(_result(check, F.lit(counted[check.name])))
        elif isinstance(check, RowCheck):
            by_table.setdefault(check.table, []).append(check)
        else:
            parts.append(check.failures(tables).select(F.inline(F.array(_result(check, F.col("failures"))))))
    if known:
        some = next(iter(tables.values())).sparkSession.range(1)
        parts.append(some.select(F.inline(F.array(*known))))
    parts += [_row_checks_of(table, some, tables) for table, some in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


class QualityError(RuntimeError):
    """Raised when checks of severity ``error`` find violations."""


def enforce(results: DataFrame) -> None:
    """Raises if a check of severity ``error`` failed. Brings one row per check to the driver."""
    failed = results.filter((F.col("severity") == ERROR) & (F.col("failures") > 0)).collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r.table_name}.{r.check_name}: {r.failures} violations" for r in failed)
        )


def drop_orphans(children: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """Rows whose parent exists, as a cascading foreign key would leave them."""
    return children.join(parents.select(column), column, "left_semi")
