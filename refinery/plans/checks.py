"""Data checks as declarations, compiled to one query.

A check names a rule over logical table names; ``report`` turns any list of
checks into a DataFrame with one row each:

    Check(1, "customers have rows", Rows("silver.crm_customers"), expect_zero=False)
    Check(2, "amounts not negative", Count("silver.crm_sales", "sales_amount < 0"), warn_only=True)
    Check(3, "keys exist", Reference("gold.fact_sales", "product_key", "gold.dim_products"))

Every rule is made of metrics, and a metric that several rules use is computed
once.  Sums over the rows of a table (rows, rows that meet a predicate, totals)
share one pass.  A key rule groups a table by its key; the table's sums are taken
in the same pass, and keys that refer to each other are grouped together: rows of
child and parent are counted side by side per key, so repeated keys and orphans
come out of one aggregate and no join.  Groups are combined in the map tasks, so
neither a large table nor a hot key is shuffled whole.  A table without key rules
is scanned once, one with key rules once per key.

Sums can also be taken while a table is written (``sums_of`` gives them, for
``DataFrame.observe``); metrics that are already known cost no scan at all.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ["check_id", "check_name", "severity", "value", "status", "about"]


# --- metrics: what is measured ----------------------------------------------------------------------

@dataclass(frozen=True)
class Sum:
    """``expr`` (SQL, a whole number) summed over the rows of a table."""
    table: str
    expr: str

    def column(self) -> Column:
        return F.coalesce(F.sum(F.expr(self.expr)).cast("long"), F.lit(0).cast("long"))


@dataclass(frozen=True)
class Repeated:
    """Key values (NULL is one) that more than one row of a table has."""
    table: str
    key: tuple[str, ...]


@dataclass(frozen=True)
class Orphans:
    """Rows of a table whose key, if it is not NULL, the parent lacks."""
    table: str
    key: tuple[str, ...]
    parent: str
    parent_key: tuple[str, ...]


@dataclass(frozen=True)
class Answer:
    """The first column of the first row of any SQL query (0 without a row);
    ``{layer.table}`` stands for a table."""
    sql: str


Metric = Sum | Repeated | Orphans | Answer


def _key(key: str | Sequence[str]) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else tuple(key)


# --- rules: what is declared ------------------------------------------------------------------------

class Rule:
    """``metrics`` are what the rule needs, ``value`` combines them: a SQL
    expression over ``of(metric)``."""

    def metrics(self) -> list[Metric]:
        raise NotImplementedError

    def value(self, of: Callable[[Metric], str]) -> str:
        return of(self.metrics()[0])


@dataclass(frozen=True)
class Rows(Rule):
    """Rows of a table."""
    table: str

    def metrics(self):
        return [Sum(self.table, "1")]


@dataclass(frozen=True)
class Count(Rule):
    """Rows for which a predicate is true (not false, not NULL)."""
    table: str
    predicate: str

    def metrics(self):
        return [Sum(self.table, f"CASE WHEN {self.predicate} THEN 1 ELSE 0 END")]


@dataclass(frozen=True)
class Total(Rule):
    """An expression summed over the rows of one table or several."""
    tables: str | tuple[str, ...]
    expr: str

    def metrics(self):
        return [Sum(t, self.expr) for t in _key(self.tables)]

    def value(self, of):
        return " + ".join(of(m) for m in self.metrics())


@dataclass(frozen=True)
class Compare(Rule):
    """Row counts of two tables: ``=`` gives the difference, ``<=`` 1 when the
    left table has more rows, else 0."""
    left: str
    how: str
    right: str

    def metrics(self):
        return [Sum(self.left, "1"), Sum(self.right, "1")]

    def value(self, of):
        left, right = map(of, self.metrics())
        shapes = {"=": f"abs({left} - {right})", "<=": f"CASE WHEN {left} > {right} THEN 1 ELSE 0 END"}
        if self.how not in shapes:
            raise ValueError(f"row counts compare by = or <=, not {self.how}")
        return shapes[self.how]


@dataclass(frozen=True)
class Share(Rule):
    """1 when fewer than ``at_least`` percent of the rows meet a predicate, else
    0 (also for an empty table)."""
    table: str
    predicate: str
    at_least: float

    def metrics(self):
        return [*Count(self.table, self.predicate).metrics(), Sum(self.table, "1")]

    def value(self, of):
        met, rows = map(of, self.metrics())
        return f"CASE WHEN {met} * 100.0 / nullif({rows}, 0) < {self.at_least} THEN 1 ELSE 0 END"


@dataclass(frozen=True)
class Unique(Rule):
    """Key values that repeat."""
    table: str
    key: str | tuple[str, ...]

    def metrics(self):
        return [Repeated(self.table, _key(self.key))]


@dataclass(frozen=True)
class Reference(Rule):
    """Rows whose key (NULLs aside) is not in the parent table."""
    table: str
    key: str | tuple[str, ...]
    parent: str
    parent_key: str | tuple[str, ...] | None = None

    def metrics(self):
        return [Orphans(self.table, _key(self.key), self.parent, _key(self.parent_key or self.key))]


@dataclass(frozen=True)
class Query(Rule):
    """The number that any SQL query gives: for what the other rules cannot
    say.  It runs as written, so it shares no scan with them."""
    sql: str

    def metrics(self):
        return [Answer(self.sql)]


@dataclass(frozen=True)
class Check:
    """A rule with what is expected of its value: zero, or anything above it."""
    check_id: int
    name: str
    rule: Rule
    expect_zero: bool = True
    warn_only: bool = False
    about: str = ""          # what a failure means


KINDS: dict[str, type[Rule]] = {"rows": Rows, "count": Count, "total": Total, "compare": Compare, "share": Share,
                                "unique": Unique, "reference": Reference, "query": Query}


def from_dicts(entries: Iterable[Mapping], first_id: int = 1001) -> list[Check]:
    """Checks from plain mappings (a JSON file, say): ``rule`` names the kind,
    ``id``, ``name``, ``expect_zero``, ``warn_only`` and ``about`` describe the
    check, everything else goes to the rule."""
    out = []
    for i, entry in enumerate(entries):
        rest = {k: tuple(v) if isinstance(v, list) else v for k, v in entry.items()}
        kind = rest.pop("rule", None)
        if kind not in KINDS:
            raise ValueError(f"check {entry.get('name')!r}: rule must be one of {sorted(KINDS)}, not {kind!r}")
        told = {k: rest.pop(k) for k in ("expect_zero", "warn_only", "about") if k in rest}
        out.append(Check(int(rest.pop("id", first_id + i)), rest.pop("name"), KINDS[kind](**rest), **told))
    return out


# --- compiling --------------------------------------------------------------------------------------

def metrics_of(checks: Iterable[Check]) -> list[Metric]:
    """The distinct metrics that the checks need, in order."""
    return list(dict.fromkeys(m for c in checks for m in c.rule.metrics()))


def sums_of(checks: Iterable[Check], table: str) -> list[Sum]:
    """The sums over one table's rows, which can be taken while it is written."""
    return [m for m in metrics_of(checks) if isinstance(m, Sum) and m.table == table]


def _linked_keys(metrics: Sequence[Metric]) -> list[list[tuple[str, tuple[str, ...]]]]:
    """The (table, key) pairs that key rules use; pairs that refer to each
    other, directly or through others, are in one list."""
    groups: list[list] = []
    for m in metrics:
        pairs = [(m.table, m.key)] if isinstance(m, Repeated) else \
            [(m.table, m.key), (m.parent, m.parent_key)] if isinstance(m, Orphans) else []
        if not pairs:
            continue
        met = [g for g in groups if any(p in g for p in pairs)]
        joined = list(dict.fromkeys([p for g in met for p in g] + pairs))
        groups = [g for g in groups if g not in met] + [joined]
    return groups


def _key_frame(group: list, sums: dict[str, list[Sum]], metrics: Sequence[Metric], tables: Mapping[str, DataFrame],
               names: Mapping[Metric, str]) -> tuple[DataFrame, list[Metric]]:
    """One row with the metrics of linked keys: the member tables' rows side by
    side, counted per key value."""
    keys = [f"k{i}" for i in range(len(group[0][1]))]
    rows = {pair: f"n{i}" for i, pair in enumerate(group)}
    taken: dict[tuple, list[Sum]] = {}
    for pair in group:               # a table that is here with two keys gives its sums once
        taken[pair] = sums.pop(pair[0], [])
    counted = [names[s] for own in taken.values() for s in own]
    sides = None
    for pair in group:
        table, key = pair
        if len(key) != len(keys):
            raise ValueError(f"{group}: linked keys need the same number of columns")
        own = {names[s]: F.coalesce(F.expr(s.expr).cast("long"), F.lit(0).cast("long")) for s in taken[pair]}
        side = tables[table].select(*[F.col(c).alias(k) for c, k in zip(key, keys)],
                                    *[F.lit(int(p == pair)).alias(n) for p, n in rows.items()],
                                    *[own.get(n, F.lit(0).cast("long")).alias(n) for n in counted])
        sides = side if sides is None else sides.unionByName(side)
    per_key = sides.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in [*rows.values(), *counted]])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    out: dict[Metric, Column] = {s: F.sum(names[s]) for own in taken.values() for s in own}
    for m in metrics:
        if isinstance(m, Repeated) and (m.table, m.key) in rows:
            out[m] = F.count_if(F.col(rows[m.table, m.key]) > 1)
        elif isinstance(m, Orphans) and (m.table, m.key) in rows:
            alone = known & (F.col(rows[m.parent, m.parent_key]) == 0)
            out[m] = F.sum(F.when(alone, F.col(rows[m.table, m.key])))
    return per_key.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(names[m]) for m, c in out.items()]), list(out)


def _answer(m: Answer, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    used: dict[str, str] = {}
    sql = re.sub(r"\{([\w.]+)\}", lambda t: "{" + used.setdefault(t[1], f"t{len(used)}") + "}", m.sql)
    spark = next(iter(tables.values())).sparkSession
    found = spark.sql(sql, **{alias: tables[t] for t, alias in used.items()})
    first = found.limit(1).select(F.col(f"`{found.columns[0]}`").cast("long").alias("v"))
    return first.agg(F.coalesce(F.max("v"), F.lit(0)).alias(name))


def report(checks: Sequence[Check], tables: Mapping[str, DataFrame], known: Mapping[Metric, int] | None = None) -> DataFrame:
    """One row per check: check_id, check_name, severity (error or warn), value,
    status (pass, warn or fail) and about.  ``tables`` gives the logical names
    that the rules use; ``known`` holds metrics that are already measured.  A
    value that is NULL does not pass."""
    if len({c.check_id for c in checks}) != len(checks):
        raise ValueError("two checks share an id")
    known = dict(known or {})
    wanted = metrics_of(checks)
    open_ = [m for m in wanted if m not in known]
    names = {m: f"m{i}" for i, m in enumerate(wanted)}
    sums: dict[str, list[Sum]] = {}
    for m in open_:
        if isinstance(m, Sum):
            sums.setdefault(m.table, []).append(m)
    frames: list[tuple[DataFrame, list[str]]] = []
    for group in _linked_keys(open_):
        frame, got = _key_frame(group, sums, open_, tables, names)
        frames.append((frame, [names[m] for m in got]))
    for table, own in sums.items():
        frames.append((tables[table].agg(*[s.column().alias(names[s]) for s in own]), [names[s] for s in own]))
    frames += [(_answer(m, names[m], tables), [names[m]]) for m in open_ if isinstance(m, Answer)]

    long = None
    for frame, got in frames:
        pairs = ", ".join(f"'{n}', `{n}`" for n in got)
        part = frame.selectExpr(f"stack({len(got)}, {pairs}) AS (metric, value)")
        long = part if long is None else long.unionByName(part)
    if long is None:
        long = next(iter(tables.values())).sparkSession.sql("SELECT '' AS metric, 0L AS value")
    measured = [names[m] for m in open_]
    one_row = long.agg(F.count(F.lit(1)).alias("__n"), *[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in measured])

    def of(m: Metric) -> str:
        return f"CAST({int(known[m])} AS BIGINT)" if m in known else names[m]

    values = one_row.select(*[F.expr(c.rule.value(of)).cast("long").alias(f"c{i}") for i, c in enumerate(checks)])
    told = ", ".join(f"{c.check_id}, {_quoted(c.name)}, '{'warn' if c.warn_only else 'error'}', {str(c.expect_zero).lower()}, "
                     f"`c{i}`, {_quoted(c.about)}" for i, c in enumerate(checks))
    rows = values.selectExpr(f"stack({len(checks)}, {told}) AS (check_id, check_name, severity, expect_zero, value, about)")
    passed = F.when(F.col("expect_zero"), F.col("value") == 0).otherwise(F.col("value") > 0)
    status = (F.when(F.coalesce(passed, F.lit(False)), F.lit("pass"))
              .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))
    return rows.select(F.col("check_id").cast("int").alias("check_id"), "check_name", "severity", "value",
                       status.alias("status"), "about")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
