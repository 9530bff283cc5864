"""Declared data checks, compiled to few passes.

A check is declared as data.  Whatever their number, the checks of a table cost
one aggregate for what a row shows by itself (nulls, ranges, accepted values)
and two passes over its keys.  One pass is over keys that are only looked at for
uniqueness, one over those that relations compare: a parent's column and the
columns related to it are one domain, whose keys are counted for each of them
side by side, so that unique and unrelated ones are read off the same counts and
nothing is joined.  The key passes of all tables run together: a row hands over
all its keys at once, they are combined map-side, so a hot key is one row a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

RESULT = "check_name string, table_name string, violations bigint, status string"


@dataclass(frozen=True)
class Check:
    """One declared check of a table.

    ``kind``: not_null, range, accepted, unique, unique_together or related.
    Violations are rows, for the unique kinds keys that occur more than once.
    Nulls violate not_null and count as a value of unique_together only.
    """

    kind: str
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind} {', '.join(self.columns)}"


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", (c,)) for c in columns]


def key(*columns: str) -> list[Check]:
    """Unique and never null, each column by itself."""
    return [Check("unique", (c,)) for c in columns] + not_null(*columns)


def unique(column: str) -> Check:
    return Check("unique", (column,))


def unique_together(*columns: str) -> Check:
    return Check("unique_together", columns)


def in_range(column: str, low: float | None = None, high: float | None = None) -> Check:
    return Check("range", (column,), low=low, high=high)


def accepted(column: str, values: Sequence) -> Check:
    return Check("accepted", (column,), values=tuple(values))


def related(column: str, parent: str, parent_column: str | None = None) -> list[Check]:
    """Never null, and every value is a key of the parent table."""
    return [
        *not_null(column),
        Check("related", (column,), parent=parent, parent_column=parent_column or column),
    ]


def _row_violation(check: Check) -> Column:
    value = F.col(check.columns[0])
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "accepted":
        return F.coalesce(~value.isin(*check.values), F.lit(False))
    bad = F.lit(False)
    if check.low is not None:
        bad = bad | (value < check.low)
    if check.high is not None:
        bad = bad | (value > check.high)
    return F.coalesce(bad, F.lit(False))


def _row_checks(table: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """(counted, violations) of a table's row-wise checks, from one aggregate."""
    counts = table.agg(*[F.count_if(_row_violation(c)).alias(f"row {no}") for no, c in checks])
    return _upright(counts, [f"row {no}" for no, _ in checks])


def _upright(counts: DataFrame, names: Sequence[str], prefix: Column | None = None) -> DataFrame:
    """(counted, violations): a row for each of the named columns."""
    name = F.lit if prefix is None else lambda n: F.concat(prefix, F.lit(n))
    pairs = [F.struct(name(n).alias("counted"), F.col(n).alias("violations")) for n in names]
    return counts.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


@dataclass(frozen=True)
class _Use:
    """Columns of a table whose values are keys of a domain.

    ``domain`` is (parent table, its column) where relations compare the keys, and
    (kind of check, table, columns...) where they are looked at by themselves.
    """

    domain: tuple[str, ...]
    table: str
    columns: tuple[str, ...]

    @property
    def whole(self) -> bool:
        """Whether a null is a key too."""
        return self.domain[0] == "unique_together"


def _use(table: str, check: Check, related_to: dict[tuple[str, str], tuple[str, str]]) -> _Use:
    """Where a key check's keys are counted; a column that is related is counted there only."""
    if check.kind == "related":
        domain: tuple[str, ...] = (check.parent, check.parent_column)
    elif check.kind == "unique" and (table, check.columns[0]) in related_to:
        domain = related_to[table, check.columns[0]]
    else:
        domain = (check.kind, table, *check.columns)
    return _Use(domain, table, check.columns)


def _integral(table: DataFrame, column: str) -> bool:
    return isinstance(table.select(column).schema[0].dataType, IntegralType)


def _slots(columns: Sequence[str], numbers: Sequence[bool], width: tuple[int, int]) -> list[Column]:
    """A key in ``width`` slots for whole numbers and for texts, which all else is cast to."""
    whole = [F.col(c).cast("bigint") for c, n in zip(columns, numbers, strict=True) if n]
    texts = [F.col(c).cast("string") for c, n in zip(columns, numbers, strict=True) if not n]
    whole += [F.lit(None).cast("bigint")] * (width[0] - len(whole))
    return whole + texts + [F.lit(None).cast("string")] * (width[1] - len(texts))


def _key_rows(
    tables: dict[str, DataFrame], uses: Sequence[tuple[_Use, Sequence[int], Sequence[bool]]]
) -> tuple[DataFrame, list[str]]:
    """A row for each key of the uses (use, what marks its rows, which of its columns are whole
    numbers), from one pass over each table, and the names of the columns that make a key.
    """
    width = (max(sum(n) for *_, n in uses), max(len(n) - sum(n) for *_, n in uses))
    slots = [*(f"n{i}" for i in range(width[0])), *(f"t{i}" for i in range(width[1]))]
    marks = [f"m{i}" for i in range(len(uses[0][1]))]
    parts = []
    for name in dict.fromkeys(use.table for use, *_ in uses):
        mine = [
            [*map(F.lit, m), *_slots(u.columns, n, width)] for u, m, n in uses if u.table == name
        ]
        names = [*marks, *slots]
        if len(mine) == 1:
            parts.append(tables[name].select(*[c.alias(n) for c, n in zip(mine[0], names, strict=True)]))
        else:
            cells = [c for key in mine for c in key]
            parts.append(tables[name].select(F.stack(F.lit(len(mine)), *cells).alias(*names)))
    known = reduce(Column.__or__, [F.col(c).isNotNull() for c in slots])
    whole = [m[0] for u, m, _ in uses if u.whole]
    return _union(parts).filter(F.col("m0").isin(*whole) | known if whole else known), slots


def _alone(tables: dict[str, DataFrame], uses: Sequence[_Use], counted: dict[_Use, str]) -> DataFrame:
    """(counted, violations): keys that occur more than once, of uses no relation compares."""
    marked = [(u, (no,), [_integral(tables[u.table], c) for c in u.columns]) for no, u in enumerate(uses)]
    rows, slots = _key_rows(tables, marked)
    keys = rows.groupBy("m0", *slots).agg(F.count(F.lit(1)).alias("n"))
    found = keys.groupBy("m0").agg(F.count_if(F.col("n") > 1).alias("violations"))
    name = F.get(F.array(*[F.lit(counted[u]) for u in uses]), "m0")
    return found.select(name.alias("counted"), "violations")


def _compared(tables: dict[str, DataFrame], domains: dict[tuple[str, ...], list[_Use]]) -> DataFrame:
    """(counted, violations) of the uses that relations compare, a domain's first being its parent.

    A key is counted for each use of its domain by itself: ``unique`` counts the
    keys a use has more than once, ``related`` its rows whose key the parent lacks.
    """
    marked = []
    for no, uses in enumerate(domains.values()):
        # Keys of different types are compared as texts
        number = all(_integral(tables[u.table], c) for u in uses for c in u.columns)
        marked += [(u, (no, place), [number]) for place, u in enumerate(uses)]
    rows, slots = _key_rows(tables, marked)
    places = range(max(map(len, domains.values())))
    keys = rows.groupBy("m0", *slots).agg(
        *[F.count_if(F.col("m1") == p).alias(f"n_{p}") for p in places]
    )
    found = keys.groupBy("m0").agg(
        *[F.count_if(F.col(f"n_{p}") > 1).alias(f"unique {p}") for p in places],
        *[F.sum(F.when(F.col("n_0") == 0, F.col(f"n_{p}"))).alias(f"related {p}") for p in places],
    )
    names = [c for c in found.columns if c != "m0"]
    return _upright(found, names, F.concat(F.col("m0").cast("string"), F.lit(" ")))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def run_declared(
    tables: dict[str, DataFrame], declared: dict[str, Sequence[Check]]
) -> DataFrame:
    """(check_name, table_name, violations, status), one row for each declared check."""
    spark = next(iter(tables.values())).sparkSession
    numbered = [
        (no, table, check)
        for no, (table, check) in enumerate((t, c) for t, cs in declared.items() for c in cs)
    ]
    on_rows: dict[str, list[tuple[int, Check]]] = {}
    domains: dict[tuple[str, ...], list[_Use]] = {}
    related_to: dict[tuple[str, str], tuple[str, str]] = {}
    relations = [(t, c, (c.parent, c.parent_column)) for _, t, c in numbered if c.kind == "related"]
    for table, check, parent in relations:
        domains.setdefault(parent, [_Use(parent, check.parent, (check.parent_column,))])
        related_to.setdefault((table, check.columns[0]), parent)
    # A parent's own column is counted among its keys, whatever it is related to itself
    related_to |= {parent: parent for *_, parent in relations}
    counted: dict[int, str] = {}
    alone: dict[_Use, str] = {}
    for no, table, check in numbered:
        if check.kind in ("not_null", "range", "accepted"):
            on_rows.setdefault(table, []).append((no, check))
            counted[no] = f"row {no}"
            continue
        use = _use(table, check, related_to)
        if use.domain not in domains:
            counted[no] = alone.setdefault(use, f"alone {len(alone)}")
            continue
        uses = domains[use.domain]
        if use not in uses:
            uses.append(use)
        counted[no] = f"{list(domains).index(use.domain)} {check.kind} {uses.index(use)}"

    results = [_row_checks(tables[t], cs) for t, cs in on_rows.items()]
    if alone:
        results.append(_alone(tables, list(alone), alone))
    if domains:
        results.append(_compared(tables, domains))
    names = spark.createDataFrame(
        [(counted[no], check.name, table) for no, table, check in numbered],
        "counted string, check_name string, table_name string",
    )
    violations = F.coalesce("violations", F.lit(0)).cast("bigint")
    return names.join(_union(results), "counted", "left").select(
        "check_name",
        "table_name",
        violations.alias("violations"),
        F.when(violations == 0, "pass").otherwise("fail").alias("status"),
    )
