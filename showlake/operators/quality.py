"""Data-quality rules: counts of violations and the offending rows.

``rules(gen)`` gives every rule of the model.  Rules on single rows are counted
in one pass per table.  Key rules are counted per key: those on unique keys after
their keys were dealt out to tasks, those on references with map-side sums, so a
parent that most rows name does not reach a task as rows.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import dealt, only_keys, split_join, union_all, without_keys
from ..sources import constraints, schemas
from ..sources.tables import Tables

END_OF_TIME = "9999-12-31"
#: Rules told in one number, a bigint.
BITS = 62


@dataclass(frozen=True)
class Rule:
    """One rule on one table.

    ``kind`` decides how it is checked: ``row`` by ``valid`` (SQL, NULL
    passes), ``unique`` by ``columns`` among rows satisfying ``where``,
    ``reference`` against ``parent``, ``overlap`` and ``cross`` by their own
    plan.
    """

    table: str
    name: str
    kind: str
    columns: tuple[str, ...] = ()
    valid: str = ""
    where: str | None = None
    parent: tuple[str, str] | None = None
    reads: tuple[str, ...] = field(default=())
    #: Columns that ``where`` names.
    needs: tuple[str, ...] = field(default=())

    def applies(self, columns: Mapping[str, set[str]]) -> bool:
        """Whether the tables and columns (by table) the rule reads are there."""
        tables = [self.table, *self.reads] + ([self.parent[0]] if self.parent else [])
        if not all(t in columns for t in tables) or not {*self.columns, *self.needs} <= columns[self.table]:
            return False
        return self.parent is None or self.parent[1] in columns[self.parent[0]]


def not_null_rules(gen: int = 2) -> list[Rule]:
    return [
        Rule(table, f"{f.name}_not_null", "row", (f.name,), f"{f.name} is not null")
        for table in schemas.tables(gen)
        for f in schemas.schema(table, gen)
        if not f.nullable
    ]


def length_rules(gen: int = 2) -> list[Rule]:
    return [
        Rule(table, f"{column}_at_most_{limit}", "row", (column,), f"length({column}) <= {limit}")
        for table in schemas.tables(gen)
        for column, limit in schemas.MAX_LENGTH.get(table, {}).items()
        if column in schemas.schema(table, gen).names
    ]


def primary_key_rules(gen: int = 2) -> list[Rule]:
    return [
        Rule(table, "primary_key", "unique", tuple(constraints.PRIMARY_KEYS[table]))
        for table in schemas.tables(gen)
    ]


def unique_rules(gen: int = 2) -> list[Rule]:
    keys = [(t, k) for t, many in constraints.UNIQUE_KEYS.items() for k in many]
    if gen == 1:
        keys += [(t, k) for t, many in constraints.UNIQUE_KEYS_GEN1.items() for k in many]
    return [
        Rule(t, "unique_" + "_".join(k), "unique", tuple(k)) for t, k in keys if t in schemas.tables(gen)
    ]


def partial_unique_rules(gen: int = 2) -> list[Rule]:
    sources = [constraints.PARTIAL_UNIQUE] + ([constraints.PARTIAL_UNIQUE_GEN2] if gen == 2 else [])
    return [
        Rule(
            table,
            f"one_{'_'.join(keys)}_where_{where.replace(' ', '_')}",
            "unique",
            tuple(keys),
            where=where,
            needs=tuple(c for c in schemas.schema(table, gen).names if c in where.replace("(", " ").split()),
        )
        for source in sources
        for table, many in source.items()
        for keys, where in many
    ]


def reference_rules(gen: int = 2) -> list[Rule]:
    return [
        Rule(fk.child, f"{fk.column}_in_{fk.parent}", "reference", (fk.column,), parent=(fk.parent, fk.parent_column))
        for fk in constraints.foreign_keys(gen)
    ]


def domain_rules(gen: int = 2) -> list[Rule]:
    return [
        Rule(
            table,
            f"{column}_allowed",
            "row",
            (column,),
            f"{column} in ({', '.join(repr(v) for v in values)})",
        )
        for table, columns in constraints.DOMAINS.items()
        if table in schemas.tables(gen)
        for column, values in columns.items()
    ]


def _row_rule(table: str, name: str, valid: str, gen: int) -> Rule | None:
    words = set(valid.replace("(", " ").replace(")", " ").replace(",", " ").split())
    known = schemas.schema(table, 2).names if table in schemas.GEN2 else []
    every = [*known, *schemas.schema(table, 1).names] if table in schemas.tables(1) else known
    columns = tuple(sorted(words & set(every)))
    if not set(columns) <= set(schemas.schema(table, gen).names):
        return None
    return Rule(table, name, "row", columns, valid)


def range_rules(gen: int = 2) -> list[Rule]:
    found = [
        _row_rule(table, valid.replace(" ", "_"), valid, gen)
        for table, many in constraints.RANGES.items()
        if table in schemas.tables(gen)
        for valid in many
    ]
    return [rule for rule in found if rule]


def row_rules(gen: int = 2) -> list[Rule]:
    found = [
        _row_rule(table, name, valid, gen)
        for table, many in constraints.ROW_RULES.items()
        if table in schemas.tables(gen)
        for name, valid in many.items()
    ]
    return [rule for rule in found if rule]


def overlap_rules(gen: int = 2) -> list[Rule]:
    columns = ("content_id", "country_code", "available_from", "available_to")
    return [Rule("content_availability", "windows_do_not_overlap", "overlap", columns)]


def application_rules(gen: int = 2) -> list[Rule]:
    """Rules the model leaves to the application."""
    episode = ("content_id", "episode_id")
    out = [
        Rule("users", "verified_is_not_pending", "row", ("account_status", "email_verified"),
             "not (email_verified and account_status = 'pending')"),
        Rule("subscriptions", "profiles_within_plan", "cross", ("user_id", "plan_id"),
             reads=("subscription_plans", "profiles")),
        Rule("watch_history", "episode_of_title", "cross", episode, reads=("episodes", "seasons")),
        Rule("downloads", "episode_of_title", "cross", episode, reads=("episodes", "seasons")),
    ]
    if gen == 2:
        out += [
            Rule("ratings", "season_of_title", "cross", ("content_id", "season_id"), reads=("seasons",)),
            Rule("ratings", "episode_of_title", "cross", episode, reads=("episodes", "seasons")),
            Rule("ratings", "part_of_title", "cross", ("content_id", "part_id"), reads=("content_parts",)),
            Rule("content_parts", "parts_only_for_movies", "cross", ("content_id",), reads=("content",)),
            Rule("user_devices", "device_in_plan", "cross", ("user_id", "device_type"),
                 reads=("subscriptions", "plan_allowed_devices")),
        ]
    return out


KINDS = {
    "v1": lambda gen: not_null_rules(gen) + length_rules(gen),
    "v2": primary_key_rules,
    "v3": unique_rules,
    "v4": partial_unique_rules,
    "v5": reference_rules,
    "v6": domain_rules,
    "v7": range_rules,
    "v8": row_rules,
    "v9": overlap_rules,
    "v10": application_rules,
}


def rules(gen: int = 2, *kinds: str) -> list[Rule]:
    """Rules of the given kinds (``v1`` .. ``v10``), or all."""
    return [rule for kind in (kinds or KINDS) for rule in KINDS[kind](gen)]


def _broken(rule: Rule) -> Column:
    return ~F.coalesce(F.expr(rule.valid), F.lit(True))


def _keyed(T: Tables, rule: Rule) -> DataFrame:
    rows = T[rule.table]
    if rule.where:
        rows = rows.filter(rule.where)
    for column in rule.columns:
        rows = rows.filter(F.col(column).isNotNull())
    return rows


def _repeated(T: Tables, rule: Rule) -> DataFrame:
    return (
        _keyed(T, rule).groupBy(*rule.columns).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)
    )


def _orphans(T: Tables, rule: Rule) -> tuple[DataFrame, str]:
    """Missing parent keys with the number of rows that name them."""
    column = rule.columns[0]
    parent, key = rule.parent
    named = _keyed(T, rule).groupBy(column).agg(F.count("*").alias("_n"))
    return named.join(T[parent].select(F.col(key).alias(column)), column, "left_anti"), column


def _busy_starts(T: Tables) -> DataFrame:
    """Per title, country and start date: rows, first id and whether an earlier window runs on.

    Windows are first merged per start date, so a key has at most one row per
    calendar day here however many windows it holds.
    """
    place = ["content_id", "country_code"]
    end = F.coalesce("available_to", F.lit(END_OF_TIME).cast("date"))
    starts = (
        _proper_windows(T)
        .groupBy(*place, "available_from")
        .agg(F.max(end).alias("_end"), F.count("*").alias("_n"), F.min("availability_id").alias("_first"))
    )
    earlier = Window.partitionBy(*place).orderBy("available_from").rowsBetween(Window.unboundedPreceding, -1)
    return starts.withColumn(
        "_covered", F.coalesce(F.max("_end").over(earlier) > F.col("available_from"), F.lit(False))
    ).drop("_end")


def _proper_windows(T: Tables) -> DataFrame:
    last = F.col("available_to")
    return T["content_availability"].filter(last.isNull() | (last > F.col("available_from")))


def _overlap_count(T: Tables) -> DataFrame:
    several = F.when(F.col("_covered"), F.col("_n")).otherwise(F.col("_n") - 1)
    return _busy_starts(T).agg(F.coalesce(F.sum(several), F.lit(0)).alias("violations"))


def _overlap_rows(T: Tables) -> DataFrame:
    """Windows that begin while another one runs; of equal starts the first id is spared."""
    place = ["content_id", "country_code", "available_from"]
    busy = _busy_starts(T).filter(F.col("_covered") | (F.col("_n") > 1)).select(*place, "_covered", "_first")
    rows = _proper_windows(T).join(busy, place)
    return rows.filter(F.col("_covered") | (F.col("availability_id") != F.col("_first"))).select(
        *T["content_availability"].columns
    )


def _cross_rows(T: Tables, rule: Rule) -> DataFrame:
    """Offending rows of a rule that reads several tables."""
    rows = T[rule.table]
    if rule.name == "profiles_within_plan":
        counts = T["profiles"].groupBy("user_id").agg(F.count("*").alias("_n"))
        limits = T["subscription_plans"].select("plan_id", "max_profiles")
        joined = rows.filter("status = 'active'").join(limits, "plan_id").join(counts, "user_id")
        return joined.filter("_n > max_profiles").select(*rows.columns)
    if rule.name == "parts_only_for_movies":
        series = T["content"].filter("content_type <> 'Movie'").select("content_id")
        return only_keys(rows, series)
    if rule.name == "device_in_plan":
        # A user has one active subscription, so this holds one row per user and device type.
        entitled = (
            T["subscriptions"]
            .filter("status = 'active'")
            .select("user_id", "plan_id")
            .join(T["plan_allowed_devices"], "plan_id")
            .select("user_id", "device_type")
        )
        subscribed = T["subscriptions"].filter("status = 'active'").select("user_id")
        return without_keys(only_keys(rows, subscribed), entitled)
    level = rule.columns[1]
    owners = {
        "season_id": lambda: T["seasons"].select("season_id", F.col("content_id").alias("_owner")),
        "episode_id": lambda: T["episodes"]
        .select("episode_id", "season_id")
        .join(T["seasons"].select("season_id", F.col("content_id").alias("_owner")), "season_id")
        .select("episode_id", "_owner"),
        "part_id": lambda: T["content_parts"].select("part_id", F.col("content_id").alias("_owner")),
    }[level]()
    joined = split_join(rows, owners, level)  # an episode or season may hold most rows
    return joined.filter("_owner <> content_id").select(*rows.columns)


def violations(T: Tables, rule: Rule) -> DataFrame:
    """The rows that break a rule."""
    rows = T[rule.table]
    if rule.kind == "row":
        return rows.filter(_broken(rule))
    if rule.kind == "unique":
        return only_keys(_keyed(T, rule), _repeated(T, rule).drop("_n"))
    if rule.kind == "reference":
        missing, column = _orphans(T, rule)
        return only_keys(rows, missing.select(column))
    if rule.kind == "overlap":
        return _overlap_rows(T)
    return _cross_rows(T, rule)


def _count(T: Tables, rule: Rule) -> DataFrame:
    out = _overlap_count(T) if rule.kind == "overlap" else _cross_rows(T, rule).agg(F.count("*").alias("violations"))
    return out.select(F.lit(rule.table).alias("table"), F.lit(rule.name).alias("rule"), F.col("violations").cast("bigint"))


def _text(rows: DataFrame, columns: Sequence[str]) -> Column:
    """The values of some columns as one text, which differs where they do: texts beside others have their length before them."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    kinds = dict(rows.dtypes)
    plain = {c: F.col(c).cast("string") for c in columns}
    return F.concat_ws(",", *[F.concat_ws(":", F.length(x).cast("string"), x) if kinds[c] == "string" else x for c, x in plain.items()])


def _named_keys(T: Tables, table: str, wanted: Sequence[Rule], *kinds: str) -> DataFrame:
    """``rule, key`` of every row and rule (of some kinds) of a table whose columns are all there, in one scan; ``rule`` is the place in ``wanted``."""
    each = []
    for i, rule in enumerate(wanted):
        if rule.table == table and rule.kind in (kinds or (rule.kind,)):
            counts = F.expr(rule.where) if rule.where else F.lit(True)
            for column in rule.columns:
                counts = counts & F.col(column).isNotNull()
            each.append(F.when(counts, F.struct(F.lit(i).alias("rule"), _text(T[table], rule.columns).alias("key"))))
    return T[table].select(F.explode(F.array(*each)).alias("_e")).filter(F.col("_e").isNotNull()).select("_e.rule", "_e.key")


def _count_key_rules(T: Tables, wanted: Sequence[Rule]) -> DataFrame:
    """Rows with a repeated key, or with a reference to nothing.

    Each table is read once for all of its unique keys, once for all of its
    references and once more as a parent.  Keys that should be unique are dealt
    out before they are counted, as sums per map task would hold nearly every
    row; named parents, which repeat, are summed before the shuffle, and only
    they meet the parents' keys.
    """
    unique, named = ({r.table: None for r in wanted if r.kind == kind} for kind in ("unique", "reference"))
    parts = []
    if unique:
        keys = union_all([_named_keys(T, t, wanted, "unique") for t in unique])
        parts.append(dealt(keys, "rule", "key").groupBy("rule", "key").agg(F.count("*").alias("_n")).filter("_n > 1"))
    if named:
        parents = list(dict.fromkeys(r.parent for r in wanted if r.kind == "reference"))
        place = F.create_map(*[F.lit(x) for i, r in enumerate(wanted) if r.parent for x in (i, parents.index(r.parent))])
        keys = union_all([_named_keys(T, t, wanted, "reference") for t in named])
        counted = keys.groupBy("rule", "key").agg(F.count("*").alias("_n")).withColumn("parent", place[F.col("rule")])
        held = union_all([T[t].select(F.lit(i).alias("parent"), F.col(k).cast("string").alias("key")) for i, (t, k) in enumerate(parents)])
        parts.append(counted.join(held, ["parent", "key"], "left_anti").select("rule", "key", "_n"))
    # Every rule reports, those without violations as well.
    names = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(r.table).alias("table"), F.lit(r.name).alias("name")) for i, r in enumerate(wanted)])
    none = parts[0].sparkSession.range(1).select(F.inline(names)).select("rule", F.lit(0).cast("bigint").alias("_n"))
    sums = union_all([none, *[p.select("rule", "_n") for p in parts]]).groupBy("rule").agg(F.sum("_n").alias("violations"))
    told = F.get(names, F.col("rule"))
    return sums.select(told["table"].alias("table"), told["name"].alias("rule"), "violations")


def _count_row_rules(T: Tables, table: str, wanted: Sequence[Rule]) -> DataFrame:
    """All single-row rules of a table in one scan.

    Where the table can be looked at before its joins (``Early``), rules on
    what its rows have there are told there as bits of a number or more, which
    the joins carry in place of the columns.
    """
    broken = [f"not coalesce({r.valid}, true)" for r in wanted]
    early = getattr(T, "early", {}).get(table)
    if early:
        first = [i for i, r in enumerate(wanted) if not early.late & {*re.findall(r"\w+", r.valid), *r.columns}]
        bits: dict[str, list[str]] = {}
        for k, i in enumerate(first):
            number, bit = f"_broken_{k // BITS}", 1 << k % BITS
            bits.setdefault(number, []).append(f"if({broken[i]}, {bit}L, 0L)")
            broken[i] = f"{number} & {bit}L <> 0L"
        rows = early.build(lambda rows: rows.selectExpr("*", *[f"{' | '.join(each)} as {number}" for number, each in bits.items()]))
    else:
        rows = T[table]
    sums = rows.selectExpr(*[f"count(case when {b} then 1 end) as c{i}" for i, b in enumerate(broken)])
    pairs = ", ".join(f"struct('{r.name}' as rule, c{i} as violations)" for i, r in enumerate(wanted))
    return sums.selectExpr(f"'{table}' as `table`", f"inline(array({pairs}))")


def validate(T: Tables, wanted: Sequence[Rule] | None = None) -> DataFrame:
    """``table, rule, violations`` of every rule; NULL violations where its tables or columns are not there."""
    wanted = rules() if wanted is None else wanted
    named = {t for r in wanted for t in (r.table, *r.reads, *(r.parent or ())[:1]) if t in T}
    columns = {t: set(T[t].columns) for t in named}
    absent = [rule for rule in wanted if not rule.applies(columns)]
    wanted = [rule for rule in wanted if rule.applies(columns)]
    per_table: dict[str, list[Rule]] = {}
    for rule in wanted:
        if rule.kind == "row":
            per_table.setdefault(rule.table, []).append(rule)
    parts = [_count_row_rules(T, table, many) for table, many in per_table.items()]
    keyed = [rule for rule in wanted if rule.kind in ("unique", "reference")]
    parts += [_count_key_rules(T, keyed)] if keyed else []
    parts += [_count(T, rule) for rule in wanted if rule.kind in ("overlap", "cross")]
    if not parts:
        raise ValueError("no rule applies to these tables")
    if absent:
        names = F.array(*(F.struct(F.lit(r.table).alias("table"), F.lit(r.name).alias("rule")) for r in absent))
        unknown = parts[0].sparkSession.range(1).select(F.inline(names))
        parts.append(unknown.withColumn("violations", F.lit(None).cast("bigint")))
    return union_all(parts)
