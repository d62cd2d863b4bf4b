"""Data-quality checks (each returns the failing rows) and a suite runner.

NULL handling follows the usual meaning of these generic tests: ``unique``
ignores NULLs, ``accepted_values`` lets NULLs pass, ``relationships`` lets
a NULL foreign key pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1: rows whose ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Q2: values of ``col`` that occur more than once, with their count.
    Partial aggregation keeps a hot value to one row per map task."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q3: rows whose non-NULL ``col`` is not one of ``values``."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def check_relationship(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL ``fk`` has no ``pk`` in ``parent``
    (left anti join; the parent is reduced to its distinct keys first)."""
    keys = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull()).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def check_unique_combo(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q5: combinations of ``cols`` that occur more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def stale_reject_violations(valid: DataFrame, rejected: DataFrame, op: str = ">=") -> DataFrame:
    """Stale rejects whose version is ``op`` the current valid version
    (``>=`` must return nothing). Inner equi-join on trade_id with a residual
    theta predicate; the valid side has one row per trade."""
    v = valid.select("trade_id", F.col("version").alias("valid_version"))
    r = (rejected.filter(F.col("reject_reason") == K.STALE_VERSION_LOWER_THAN_EXISTING)
         .select(F.col("trade_id").alias("_r_trade"), F.col("version").alias("rejected_version"), "reject_reason"))
    cond = {">=": F.col("rejected_version") >= F.col("valid_version"),
            "<": F.col("rejected_version") < F.col("valid_version")}[op]
    return (v.join(r, (v.trade_id == r._r_trade) & cond, "inner")
            .select("trade_id", "valid_version", "rejected_version", "reject_reason"))


# --- Q7: suite runner --------------------------------------------------------------
@dataclass
class TableChecks:
    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: dict[str, Sequence] = field(default_factory=dict)
    relationships: dict[str, tuple[str, str]] = field(default_factory=dict)  # fk -> (parent table, pk)
    unique_combos: Sequence[Sequence[str]] = ()


def _stack(df: DataFrame, table: str, values: Sequence[tuple[str, str, Column]], given: int) -> DataFrame:
    """(table, rule, column, value as text, given) for every listed value of every row."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("check_name"), F.lit(c).alias("column_name"), v.cast("string").alias("v"))
        for rule, c, v in values])).alias("s")).select("s.*", F.lit(given).alias("given")).filter(F.col("v").isNotNull())


def _values(t: TableChecks) -> list[tuple[str, str, Column]]:
    """The values of a table that its unique, relationship and combination checks count."""
    return ([("unique", c, F.col(c)) for c in t.unique] + [("relationships", c, F.col(c)) for c in t.relationships]
            + [("unique_combination", ",".join(cols), F.to_json(F.struct(*cols))) for cols in t.unique_combos])


def run_suite(spec: Sequence[TableChecks], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: (table_name, check_name, column_name, failures).

    All unique, combination and relationship checks of all tables are one
    aggregation: their values are stacked as (table, rule, column, value) and
    counted, with partial aggregation, so a hot value is one row a map task; the
    parents' keys of a relationship stand beside them as given rows, so a value
    without one is an orphan and no join is needed. The not_null and
    accepted_values checks of a table are one ``count_if`` each in a single row.
    """
    spark = next(iter(tables.values())).sparkSession
    parts, stacked, names = [], [], []
    for t in spec:
        df = tables[t.table]
        folded = [("not_null", c, F.count_if(F.col(c).isNull())) for c in t.not_null] + [
            ("accepted_values", c, F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(values)))) for c, values in t.accepted.items()]
        if folded:
            agg = df.agg(*[e.alias(f"f{i}") for i, (_, _, e) in enumerate(folded)])
            parts.append(agg.select(F.inline(F.array(*[
                F.struct(F.lit(t.table).alias("table_name"), F.lit(check).alias("check_name"), F.lit(c).alias("column_name"),
                         F.col(f"f{i}").cast("bigint").alias("failures")) for i, (check, c, _) in enumerate(folded)]))))
        values = _values(t)
        if values:
            names += [(t.table, rule, c) for rule, c, _ in values]
            stacked.append(_stack(df, t.table, values, 0))
        stacked += [_stack(tables[parent], t.table, [("relationships", c, F.col(pk))], 1) for c, (parent, pk) in t.relationships.items()]
    if stacked:
        every = stacked[0]
        for x in stacked[1:]:
            every = every.unionByName(x)
        key = ["table_name", "check_name", "column_name"]
        found = every.groupBy(*key, "v").agg(F.count_if(F.col("given") == 0).alias("n"), F.max("given").alias("given"))
        wrong = F.when(F.col("check_name") == "relationships", F.when(F.col("given") == 0, F.col("n")).otherwise(0)).otherwise(
            F.when(F.col("n") > 1, 1).otherwise(0))
        counts = found.groupBy(*key).agg(F.sum(wrong).cast("bigint").alias("failures"))
        # a check without a value has no failure; the list of checks is fixed
        listed = spark.createDataFrame(names, "table_name string, check_name string, column_name string")
        parts.append(listed.join(counts, key, "left").select(*key, F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
