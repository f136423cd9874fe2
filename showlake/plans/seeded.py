"""Platform tables with every declared column and seeded violations, so that each rule has something to count.

One recipe gives the columns of both engines.  Columns that the derived tables
lack get values from their type; then parts of every column are NULLed or
replaced by a value that is too long, negative, out of its domain or without a
parent, and some rows are there twice.  Which ones depends on a hash of the
row's key, so violations grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import constraints, schemas
from ..sources.tables import Early, Tables

#: One row in so many is NULL, bad, or twice there; a column's place in its table decides which.
NULL, BAD, TWICE = 5, 7, 11

#: A number from the text of a row's key, in Spark SQL and in DuckDB.
NUMBER = {
    "spark": "cast(conv(substring(md5({key}), 1, 7), 16, 10) as bigint)",
    "duckdb": "cast('0x' || substring(md5({key}), 1, 7) as bigint)",
}
MOMENT = {"spark": "timestamp_ntz'1800-01-01 00:00:00'", "duckdb": "timestamp '1800-01-01 00:00:00'"}


def declared(table: str) -> dict[str, str]:
    """Columns of a table in either generation with their types."""
    out: dict[str, str] = {}
    for gen in (2, 1):
        if table in schemas.tables(gen):
            for field in schemas.schema(table, gen):
                out.setdefault(field.name, field.dataType.simpleString())
    return out


def _value(table: str, column: str, kind: str, dialect: str) -> str:
    """What a column that the derived table lacks holds."""
    allowed = constraints.DOMAINS.get(table, {}).get(column)
    if allowed:
        return f"case when _n % 2 = 0 then '{allowed[0]}' else '{allowed[-1]}' end"
    if kind == "string":
        return f"concat('{column[:1]}', _n % 89)"
    if kind == "boolean":
        return "_n % 2 = 0"
    if kind == "date":
        return "date '2020-01-01'"
    return MOMENT[dialect] if kind.startswith("timestamp") else f"cast(_n % 89 as {kind})"


def _bad(table: str, column: str, kind: str, dialect: str) -> str | None:
    """A value that breaks what is asked of a column, where anything is."""
    if kind == "string":
        limit = schemas.MAX_LENGTH.get(table, {}).get(column, 20)
        return f"repeat('x', {limit + 1})"
    if kind == "boolean":
        return None
    if kind == "date":
        return "date '1800-01-01'"
    return MOMENT[dialect] if kind.startswith("timestamp") else f"cast(-9 as {kind})"


def columns(table: str, held: list[str], dialect: str, n: str = "_n") -> list[str]:
    """Select expressions of a seeded table over a table that has ``held`` and ``_n``; cases are told by ``n``."""
    out = []
    for i, (column, kind) in enumerate(declared(table).items()):
        plain = column if column in held else _value(table, column, kind, dialect)
        bad = None if column == constraints.PRIMARY_KEYS[table][0] else _bad(table, column, kind, dialect)
        cases = f"when {n} % {NULL} = {i % NULL} then null"
        if bad is not None:
            cases += f" when {n} % {BAD} = {i % BAD} then {bad}"
        out.append(f"case {cases} else {plain} end as {column}")
    return out


def number(table: str, dialect: str) -> str:
    key = ", ".join(f"cast({c} as {'string' if dialect == 'spark' else 'varchar'})" for c in constraints.PRIMARY_KEYS[table])
    return NUMBER[dialect].format(key=f"concat_ws('|', {key})")


def seeded(T: Tables) -> Tables:
    """``T`` with every table seeded."""

    def numbered(name: str, rows: DataFrame) -> DataFrame:
        rows = rows.selectExpr("*", f"{number(name, 'spark')} as _n")
        return rows.selectExpr("*", f"explode(sequence(1, if(_n % {TWICE} = 0, 2, 1))) as _copy")

    def build(name: str, rows: DataFrame) -> DataFrame:
        return numbered(name, rows).selectExpr(*columns(name, rows.columns, "spark"))

    def build_early(name: str, mark: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Marks are made of the seeded values; joins need the others, and late columns no more of ``_n`` than ``_case``."""
        held, late = T[name].columns, T.early[name].late
        values = dict(zip(declared(name), columns(name, held, "spark"), strict=True))
        values |= {c: v for c, v in zip(declared(name), columns(name, held, "spark", "_case"), strict=True) if c in late}
        there = [v for c, v in values.items() if c not in late]
        marks: list[str] = []

        def spoil(rows: DataFrame) -> DataFrame:
            plain = [F.col(c).alias(f"_plain_{c}") for c in rows.columns]
            case = F.expr(f"_n % {NULL * BAD} as _case")
            spoilt = numbered(name, rows).select(*plain, "_n", case, *map(F.expr, there))
            marked = mark(spoilt)
            marks[:] = [c for c in marked.columns if c not in spoilt.columns]
            return marked.select(*[F.col(f"_plain_{c}").alias(c) for c in rows.columns], "_n", "_case", *marks)

        return T.early[name].build(spoil).selectExpr(*values.values(), *marks)

    names = [t for t in dict.fromkeys([*schemas.tables(2), *schemas.tables(1)]) if t in T]
    early = {
        name: Early(e.late, lambda mark, n=name: build_early(n, mark))
        for name, e in T.early.items()
        if name in names and not e.late & {*constraints.PRIMARY_KEYS[name]}
    }
    return Tables({name: (lambda n=name: build(n, T[n])) for name in names}, early)


def statement(table: str, held: Mapping[str, list[str]]) -> str:
    """The seeded table in DuckDB."""
    body = ", ".join(columns(table, held[table], "duckdb"))
    return f"""select {body} from (
        select *, unnest(range(case when _n % {TWICE} = 0 then 2 else 1 end)) as _copy
        from (select *, {number(table, 'duckdb')} as _n from {table}))"""
