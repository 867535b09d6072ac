"""The quality gate: one aggregate per table, one result row per check."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.plans.contracts import QUALITY_RULES, QualityRules

STAMP_PATTERN = r"^\s*[+-]?\d{4}"

RESULT = (
    "check string, table string, column string, value double, threshold double, passed boolean, "
    "message string, missing_columns array<string>, negative_count bigint, extreme_count bigint, "
    "latest_record timestamp, cutoff timestamp"
)
_FIELDS = [part.strip().split(" ", 1) for part in RESULT.split(", ")]


def _result(**given: Column) -> Column:
    """One check as a struct in the result layout; what is not given is null."""
    return F.struct(
        *[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in _FIELDS]
    )


def _text(pattern: str, *args: Column) -> Column:
    return F.format_string(pattern, *args)


class _Plan:
    """Collects the aggregates a set of checks needs and the result rows built from them."""

    def __init__(self, df: DataFrame, table: str, rules: QualityRules, as_of: datetime | None):
        self.df, self.table, self.rules = df, table, rules
        self.now = F.current_timestamp() if as_of is None else F.lit(as_of)
        self.aggregates: list[Column] = [F.count(F.lit(1)).alias("rows")]
        self.results: list[Column] = []
        self.constants: list[Column] = []

    def _add(self, check: str, **given: Column) -> None:
        self.results.append(_result(check=F.lit(check), table=F.lit(self.table), **given))

    def _add_constant(self, check: str, **given: Column) -> None:
        """A result that follows from the schema."""
        self.constants.append(_result(check=F.lit(check), table=F.lit(self.table), **given))

    def row_count(self) -> None:
        rows = F.col("rows")
        self._add(
            "row_count",
            value=rows,
            threshold=F.lit(self.rules.min_rows),
            passed=rows >= self.rules.min_rows,
            message=_text(f"%d rows, at least {self.rules.min_rows} needed", rows),
        )

    def null_pct(self) -> None:
        limit = self.rules.max_null_pct
        for name in self.rules.critical:
            if name not in self.df.columns:
                self._add_constant(
                    "null_pct",
                    column=F.lit(name),
                    passed=F.lit(False),
                    message=F.lit(f"no column {name}"),
                )
                continue
            nulls = f"nulls_{name}"
            self.aggregates.append(F.count_if(F.col(name).isNull()).alias(nulls))
            share = F.coalesce(F.try_divide(F.col(nulls) * 100.0, F.col("rows")), F.lit(0.0))
            self._add(
                "null_pct",
                column=F.lit(name),
                value=F.round(share, 2),
                threshold=F.lit(limit),
                passed=share <= limit,
                message=_text(f"{name} is null in %.2f%% of the rows, at most {limit}%% allowed", share),
            )

    def schema(self) -> None:
        missing = sorted(set(self.rules.critical) - set(self.df.columns))
        self._add_constant(
            "schema",
            missing_columns=F.array(*[F.lit(m) for m in missing]),
            passed=F.lit(not missing),
            message=F.lit("missing " + ", ".join(missing) if missing else "all critical columns present"),
        )

    def value_range(self) -> None:
        name = self.rules.ranged_column
        if name is None or name not in self.df.columns:
            return
        number = F.col(name).try_cast("double")
        self.aggregates += [
            F.count_if(number < 0).alias("negative"),
            F.count_if(number > self.rules.max_value).alias("extreme"),
        ]
        negative, extreme = F.col("negative"), F.col("extreme")
        self._add(
            "value_range",
            column=F.lit(name),
            negative_count=negative,
            extreme_count=extreme,
            passed=(negative == 0) & (extreme == 0),
            message=_text(f"{name}: %d negative, %d above {self.rules.max_value}", negative, extreme),
        )

    def freshness(self) -> None:
        stamp = next((s for s in self.rules.stamps if s in self.df.columns), None)
        if stamp is None:
            self._add_constant("freshness", passed=F.lit(True), message=F.lit("no time stamp column, not checked"))
            return
        parsed = F.col(stamp).try_cast("timestamp")
        if isinstance(self.df.schema[stamp].dataType, T.StringType):
            # text that cannot be a time stamp is sorted out before the cast, which is slow on bad text
            parsed = F.when(F.col(stamp).rlike(STAMP_PATTERN), parsed)
        self.aggregates += [
            F.max(parsed).alias("latest"),
            F.count_if(F.col(stamp).isNotNull() & parsed.isNull()).alias("unreadable"),
        ]
        cutoff = self.now - F.expr(f"interval {self.rules.fresh_hours} hours")
        readable = F.col("unreadable") == 0
        self._add(
            "freshness",
            latest_record=F.when(readable, F.col("latest")),
            cutoff=F.when(readable, cutoff),
            # an empty table has no latest record and fails; unreadable stamps are let through
            passed=F.when(readable, F.coalesce(F.col("latest") >= cutoff, F.lit(False))).otherwise(True),
            message=F.when(
                readable,
                F.concat(
                    F.lit("latest "), F.coalesce(F.col("latest").cast("string"), F.lit("none")),
                    F.lit(", needed since "), cutoff.cast("string"),
                ),
            ).otherwise("time stamps cannot be read, not checked"),
        )


CHECKS = ("row_count", "null_pct", "schema", "value_range", "freshness")


def _plan(empty: DataFrame, table: str, as_of: datetime | None, rules: QualityRules | None, checks: Iterable[str]) -> _Plan:
    plan = _Plan(empty, table, rules or QUALITY_RULES.get(table, QualityRules(critical=())), as_of)
    for check in checks:
        getattr(plan, check)()
    return plan


def run_checks(
    df: DataFrame,
    table: str,
    as_of: datetime | None = None,
    rules: QualityRules | None = None,
    checks: Iterable[str] = CHECKS,
) -> DataFrame:
    """The named checks over the whole table, in one pass; checks of the schema alone need no scan."""
    plan = _plan(df, table, as_of, rules, checks)
    parts = []
    if plan.constants:
        parts.append(df.sparkSession.range(1).select(F.inline(F.array(*plan.constants))))
    if plan.results:
        parts.append(df.agg(*plan.aggregates).select(F.inline(F.array(*plan.results))))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], RESULT)


def check_states(
    df: DataFrame, table: str, by: Sequence[str], rules: QualityRules | None = None, checks: Iterable[str] = CHECKS
) -> DataFrame:
    """What the checks count, for each value of ``by``: counts and latest stamps, which add up over parts of a table."""
    return df.groupBy(*by).agg(*_plan(df, table, None, rules, checks).aggregates)


def checks_from_states(
    states: DataFrame, schema: T.StructType, table: str, as_of: datetime | None = None, rules: QualityRules | None = None,
    checks: Iterable[str] = CHECKS,
) -> DataFrame:
    """The same as ``run_checks`` on a table with ``schema`` whose ``check_states`` are given; no row of it is read."""
    spark = states.sparkSession
    plan = _plan(spark.createDataFrame([], schema), table, as_of, rules, checks)
    parts = [spark.range(1).select(F.inline(F.array(*plan.constants)))] if plan.constants else []
    if plan.results:
        kinds = {f.name: f.dataType for f in states.schema.fields}
        counted = [c for c in kinds if isinstance(kinds[c], T.LongType) and c not in schema.names]
        whole = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted]
        whole += [F.max(c).alias(c) for c in kinds if isinstance(kinds[c], T.TimestampType) and c not in schema.names]
        parts.append(states.agg(*whole).select(F.inline(F.array(*plan.results))))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RESULT)


def unreadable_table(spark: SparkSession, table: str, reason: str) -> DataFrame:
    failed = _result(
        check=F.lit("read_table"), table=F.lit(table), passed=F.lit(False), message=F.lit(reason)
    )
    return spark.range(1).select(F.inline(F.array(failed)))


def check_table(spark: SparkSession, name: str, table: str | None = None, **options) -> DataFrame:
    """Checks a catalog table; one that cannot be read becomes a failed check."""
    label = table or name.split(".")[-1]
    if not spark.catalog.tableExists(name):
        return unreadable_table(spark, label, "no such table")
    try:
        df = spark.table(name)
        df.schema  # a registered table may still be unreadable
    except AnalysisException as error:
        return unreadable_table(spark, label, error.getCondition() or "table cannot be read")
    return run_checks(df, label, **options)


def check_path(spark: SparkSession, path: str, table: str, **options) -> DataFrame:
    """Checks the Parquet table at ``path``; one that cannot be read becomes a failed check."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        return unreadable_table(spark, table, error.getCondition() or "table cannot be read")
    return run_checks(df, table, **options)


def summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if(F.col("passed")).alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
    )


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("passed"))
