"""Data checks: frames of offending rows (empty means passed), and rules that are compiled into one scan per frame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import FRESHNESS_HOURS
from tripmart.operators.joins import orphans

WARN, ERROR = "warn", "error"


class CheckFailed(Exception):
    """At least one check of severity ``error`` found offending rows."""


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys seen more than once, with their count. Keys with a NULL are exempt.

    The count is combined per task before the shuffle, so a hot key costs one row per task.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    counted = df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    """Values outside ``values``, with their count. NULL passes."""
    rejected = df.filter(~F.col(column).isin(*values))
    return rejected.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that name a parent which does not exist. NULL passes."""
    return orphans(child, key, parent, parent_key)


def freshness(df: DataFrame, loaded_at: str, as_of: dt.datetime, hours: int = FRESHNESS_HOURS) -> DataFrame:
    """One row: the newest ``loaded_at``, its age at ``as_of`` and ``pass`` or ``error``.

    The age is shown in whole seconds but judged exactly. An empty table has no newest row
    and is an error.
    """
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("as_of"))
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at")).withColumn("as_of", now)
    fresh = F.col("max_loaded_at") >= now - F.make_interval(hours=F.lit(hours))
    return newest.withColumn("age_seconds", age).withColumn(
        "status", F.when(fresh, F.lit("pass")).otherwise(F.lit("error"))
    )


def stale(df: DataFrame, loaded_at: str, as_of: dt.datetime, hours: int = FRESHNESS_HOURS) -> DataFrame:
    """:func:`freshness` as a check: one row when too old, none when fresh."""
    return freshness(df, loaded_at, as_of, hours).filter(F.col("status") == "error")


# ------------------------------------------------------------------ rules and their compilation


@dataclass(frozen=True)
class Rule:
    """What must hold of a frame. A ``key`` rule is judged by group, any other by row or by the whole frame."""

    name: str
    columns: tuple[str, ...]
    values: tuple[object, ...] = ()
    bound: dt.datetime | None = None

    @property
    def key(self) -> tuple[str, ...]:
        return self.columns if self.name in ("unique", "accepted_values") else ()

    def measure(self) -> Column:
        """What the whole frame adds up to, for a rule without a key."""
        column = F.col(self.columns[0])
        return F.max(column) if self.name == "freshness" else F.count_if(column.isNull())

    def offends(self, rows: Column) -> Column:
        """Whether a group of so many rows counts as a failure. A key with a NULL never does."""
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.columns])
        return present & (~F.col(self.columns[0]).isin(*self.values) if self.name == "accepted_values" else rows > 1)

    def failures(self, measured: Column) -> Column:
        if self.name == "freshness":
            fresh = measured >= F.lit(self.bound.isoformat(sep=" ")).cast("timestamp_ntz")
            return F.when(fresh, 0).otherwise(1)
        return F.coalesce(measured, F.lit(0))


def must_be_unique(*columns: str) -> Rule:
    return Rule("unique", columns)


def must_be_present(column: str) -> Rule:
    return Rule("not_null", (column,))


def must_be_one_of(column: str, values: Iterable[object]) -> Rule:
    return Rule("accepted_values", (column,), tuple(values))


def must_be_fresh(column: str, as_of: dt.datetime, hours: int = FRESHNESS_HOURS) -> Rule:
    return Rule("freshness", (column,), bound=as_of - dt.timedelta(hours=hours))


@dataclass(frozen=True)
class Check:
    """A rule over ``frame``, or a name for the offending rows that ``frame`` holds."""

    table: str
    name: str
    column: str
    severity: str
    frame: DataFrame
    rule: Rule | None = None


def ruled(table: str, frame: DataFrame, severity: str, *rules: Rule) -> list[Check]:
    return [Check(table, rule.name, ", ".join(rule.columns), severity, frame, rule) for rule in rules]


def measured(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: the failures of every rule, ``_0``, ``_1``, ..., from a single scan of the frame.

    Rules without a key are sums over all rows. Every key is a grouping set of the same aggregation, so a row meets
    all keys and sums in one pass, is combined per task, and one exchange serves them all. What
    is left after it, a row per group, is summed again.
    """
    keys = list(dict.fromkeys(r.key for r in rules if r.key))
    frame = _packed(frame, rules)
    sums = {i: r.measure().alias(f"_sum_{i}") for i, r in enumerate(rules) if not r.key}
    if not keys:
        whole = frame.agg(*sums.values())
        return whole.select(*[r.failures(F.col(f"_sum_{i}")).cast("bigint").alias(f"_{i}") for i, r in enumerate(rules)])
    columns = list(dict.fromkeys(c for key in keys for c in key))
    sets = [*keys, *([()] if sums else [])]
    groups = frame.groupingSets([list(s) for s in sets], *columns).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows"), *sums.values()
    )

    def number(key: Sequence[str]) -> int:
        """A bit for each column that is not part of the set, the first column's highest."""
        return sum(1 << len(columns) - 1 - i for i, c in enumerate(columns) if c not in key)

    totals = [
        F.count_if((F.col("_set") == number(r.key)) & r.offends(F.col("_rows"))).alias(f"_total_{i}")
        if r.key
        else F.max(F.when(F.col("_set") == number(()), F.col(f"_sum_{i}"))).alias(f"_total_{i}")
        for i, r in enumerate(rules)
    ]
    return groups.agg(*totals).select(
        *[r.failures(F.col(f"_total_{i}")).cast("bigint").alias(f"_{i}") for i, r in enumerate(rules)]
    )


def _packed(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The frame, with texts that only have to be unique or present as bytes: equal if and only if the texts are.

    Hex digests, which surrogate keys are, become the 16 bytes they spell and take half as much of the exchange. Other
    texts are their own bytes, and a zero more from 16 bytes on, so that none is as long as a digest.
    """
    judged = {c.lower() for r in rules if r.name not in ("unique", "not_null") for c in r.columns}
    grouped = {c.lower() for r in rules for c in r.key}
    texts = [c for c, t in frame.dtypes if t == "string" and c.lower() in grouped - judged]
    return frame.withColumns({c: _bytes(F.col(f"`{c}`")) for c in texts}) if texts else frame


def _bytes(text: Column) -> Column:
    spelt = F.when(F.octet_length(text) == 32, F.unhex(text))
    plain = text.cast("binary")
    longer = F.when(F.octet_length(text) >= 16, F.concat(plain, F.lit(b"\0"))).otherwise(plain)
    return F.when(F.lower(F.hex(spelt)) == text, spelt).otherwise(longer)


def report(checks: Iterable[Check]) -> DataFrame:
    """One row per check: ``table_name, check_name, column_name, severity, failures, status``.

    All rules over one frame are compiled into one aggregation, see :func:`measured`.
    """
    frames: dict[int, list[Check]] = {}
    for check in checks:
        frames.setdefault(id(check.frame), []).append(check)
    rows = []
    for group in frames.values():
        rules = [c for c in group if c.rule]
        counted = [(measured(rules[0].frame, [c.rule for c in rules]), rules)] if rules else []
        counted += [(c.frame.agg(F.count(F.lit(1)).alias("_0")), [c]) for c in group if not c.rule]
        for row, own in counted:
            entries = [
                F.struct(
                    F.lit(c.table).alias("table_name"),
                    F.lit(c.name).alias("check_name"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.severity).alias("severity"),
                    F.col(f"_{i}").alias("failures"),
                    F.when(F.col(f"_{i}") == 0, "pass").otherwise(c.severity).alias("status"),
                )
                for i, c in enumerate(own)
            ]
            rows.append(row.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionAll, rows)


def enforce(results: DataFrame) -> None:
    """Raise if an ``error`` check failed. Reads one small row per failed check."""
    failed = results.filter((F.col("severity") == ERROR) & (F.col("failures") > 0)).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures} rows" for r in failed))
