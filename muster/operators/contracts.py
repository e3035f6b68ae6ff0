"""Counts of rows or keys that break the declared rules of tables.

All rules of all tables are one aggregation. A row gives an entry for each rule that it breaks by itself,
and for each key it has in a unique or reference rule; a table that others refer to gives its keys to
those rules, too. Entries of one rule and key are summed, and say whether the key is repeated, or has no
parent. So each table is scanned once and there is one shuffle, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions.text import clean_columns, overflows
from muster.schemas import Contract

_REPORT = "rule_id int, table_name string, column_name string, rule string, counted long"
_ROW, _UNIQUE, _REFERENCE = "row", "unique", "reference"


@dataclass
class _Rules:
    """The rules of some tables, and what entries each table gives."""

    rules: list[tuple[str, str, str]] = field(default_factory=list)
    kinds: list[str] = field(default_factory=list)
    counted: dict[int, int] = field(default_factory=dict)
    entries: dict[str, list[Column]] = field(default_factory=dict)

    def add(self, table: str, column: str, rule: str, kind: str) -> int:
        self.rules.append((table, column, rule))
        self.kinds.append(kind)
        return len(self.rules) - 1

    def entry(self, source: str, rule: int, when: Column, key: Column, parent: bool = False) -> None:
        values = F.struct(
            F.lit(rule).alias("rule_id"), key.alias("key"), F.lit(0 if parent else 1).alias("rows"),
            F.lit(parent).alias("parent"),
        )
        self.entries.setdefault(source, []).append(F.when(when, values))


def _key(columns: tuple[str, ...]) -> Column:
    """One text per key; of several columns each is preceded by its length, so that no two keys are alike."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*(p for t in texts for p in (F.length(t).cast("string"), F.lit(":"), t)))


def table_violations(
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, Contract],
    raw: Mapping[str, DataFrame] | None = None,
    overflowed: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """``table_name, column_name, rule, violations``: one row per rule of ``contracts``, 0 where it holds.

    ``tables`` has the tables of the contracts, and those that reference rules name; a rule whose parent is
    not among them is left out. Row and reference rules count rows, unique rules keys that occur more
    than once; a null is no key. A value that does not fit its column is null once typed, so
    fixed-point rules need ``raw``, the text rows behind a table, or ``overflowed``, the numbers per column
    that were counted while they were typed.
    """
    spark = next(iter(tables.values())).sparkSession
    found, none = _Rules(), F.lit(None).cast("string")
    sources = dict(tables)
    for table, contract in contracts.items():
        for c in contract.not_null:
            found.entry(table, found.add(table, c, "not_null", _ROW), F.col(c).isNull(), none)
        for c, n in contract.max_length:
            found.entry(table, found.add(table, c, f"max_length_{n}", _ROW), F.char_length(c) > n, none)
        for columns in contract.unique:
            key = _key(columns)
            found.entry(table, found.add(table, ",".join(columns), _UNIQUE, _UNIQUE), key.isNotNull(), key)
        for column, parent, parent_column in contract.references:
            if parent not in tables:
                continue
            rule = found.add(table, column, _REFERENCE, _REFERENCE)
            found.entry(table, rule, F.col(column).isNotNull(), _key((column,)))
            found.entry(parent, rule, F.col(parent_column).isNotNull(), _key((parent_column,)), parent=True)
        for column, p, s in contract.fixed_point:
            if table in (overflowed or {}):
                rule = found.add(table, column, f"fixed_point_{p}_{s}", _ROW)
                found.counted[rule] = overflowed[table].get(column, 0)
            elif table in (raw or {}):
                rule = found.add(table, column, f"fixed_point_{p}_{s}", _ROW)
                sources[f"raw {table}"] = clean_columns(raw[table], [c for c, _, _ in contract.fixed_point])
                found.entry(f"raw {table}", rule, overflows(column, p, s), none)
    parts = [
        sources[source].select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
        for source, entries in found.entries.items()
    ]
    listed = [(n, *rule, found.counted.get(n, 0)) for n, rule in enumerate(found.rules)]
    report = spark.createDataFrame(listed, _REPORT)
    if parts:
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionAll(part)
        keys = merged.groupBy("rule_id", "key").agg(F.sum("rows").alias("rows"), F.max("parent").alias("parent"))
        of = {kind: [n for n, k in enumerate(found.kinds) if k == kind] for kind in found.kinds}
        broken = (
            F.when(F.col("rule_id").isin(of.get(_UNIQUE, [])), (F.col("rows") > 1).cast("long"))
            .when(F.col("rule_id").isin(of.get(_REFERENCE, [])) & F.col("parent"), 0)
            .otherwise(F.col("rows"))
        )
        sums = keys.groupBy("rule_id").agg(F.sum(broken).alias("broken"))
        report = report.join(sums, "rule_id", "left")
    else:
        report = report.withColumn("broken", F.lit(0))
    return report.select(
        "table_name", "column_name", "rule", (F.col("counted") + F.coalesce("broken", F.lit(0))).alias("violations")
    )


def contract_violations(
    table: str,
    df: DataFrame,
    contract: Contract,
    parents: Mapping[str, DataFrame] | None = None,
    raw: DataFrame | None = None,
    overflowed: Mapping[str, int] | None = None,
) -> DataFrame:
    """``table_violations`` of one table; reference rules need ``parents``."""
    return table_violations(
        {**(parents or {}), table: df},
        {table: contract},
        None if raw is None else {table: raw},
        None if overflowed is None else {table: overflowed},
    )
