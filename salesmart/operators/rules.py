"""The declared rules of the layers as data, and their check with one scan per table and one shuffle."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class Unique:
    """No two rows agree in all columns; rows with NULL in one agree with none. ``blank`` columns count NULL as ''."""

    table: str
    columns: tuple[str, ...]
    blank: tuple[str, ...] = ()


@dataclass(frozen=True)
class Reference:
    """Every row finds its columns in the parent; rows with NULL in one refer to nothing."""

    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Required:
    """The column is never NULL."""

    table: str
    column: str


def _required(table: str, columns: str) -> list[Required]:
    return [Required(table, c) for c in columns.split()]


_IMPORT, _SHOP, _PLATFORM = ("import_file_id",), ("shop_id",), ("platform_id",)
_RAW = ("import_file_id", "row_number")

# The rules that the layers must keep. Surrogate row ids are replaced by import and row number.
UNIQUE = [
    Unique("platforms", ("platform_code",)),
    Unique("shops", ("platform_id", "shop_code")),
    Unique("source_file_types", ("platform_id", "file_type_code", "version")),
    Unique("import_file_sheets", ("import_file_id", "sheet_index")),
    Unique("import_file_sheets", ("import_file_id", "sheet_name")),
    Unique("raw_import_rows", ("import_file_id", "sheet_name", "row_number"), blank=("sheet_name",)),
    Unique("stg_shop_day", ("import_file_id", "source_row_number")),
    Unique("stg_sku_day", ("import_file_id", "source_row_number")),
    Unique("fact_shop_day", ("shop_id", "sales_date")),
    Unique("fact_sku_day", ("shop_id", "sales_date", "product_id", "sku_id", "merchant_sku_code", "product_specification")),
    Unique("spu_snapshot", ("shop_code", "sales_date", "spu_name", "campaign_name", "listing_name")),
]
REFERENCES = [
    Reference("shops", _PLATFORM, "platforms", _PLATFORM),
    Reference("source_file_types", _PLATFORM, "platforms", _PLATFORM),
    Reference("import_files", ("source_file_type_id",), "source_file_types", ("source_file_type_id",)),
    Reference("import_files", _PLATFORM, "platforms", _PLATFORM),
    Reference("import_files", _SHOP, "shops", _SHOP),
    Reference("import_file_sheets", _IMPORT, "import_files", _IMPORT),
    Reference("raw_import_rows", _IMPORT, "import_files", _IMPORT),
    Reference("stg_shop_day", _IMPORT, "import_files", _IMPORT),
    Reference("stg_shop_day", ("import_file_id", "source_row_number"), "raw_import_rows", _RAW),
    Reference("stg_shop_day", _SHOP, "shops", _SHOP),
    Reference("stg_sku_day", _IMPORT, "import_files", _IMPORT),
    Reference("stg_sku_day", ("import_file_id", "source_row_number"), "raw_import_rows", _RAW),
    Reference("stg_sku_day", _SHOP, "shops", _SHOP),
    Reference("fact_shop_day", _SHOP, "shops", _SHOP),
    Reference("fact_shop_day", _IMPORT, "import_files", _IMPORT),
    Reference("fact_sku_day", _SHOP, "shops", _SHOP),
    Reference("fact_sku_day", _IMPORT, "import_files", _IMPORT),
]
REQUIRED = [
    *_required("platforms", "platform_code platform_name"),
    *_required("shops", "platform_id shop_code is_active created_at"),
    *_required("source_file_types", "platform_id file_type_code file_type_name grain_code version is_active"),
    *_required("import_files", "source_file_type_id platform_id file_path file_name imported_at"),
    *_required("import_file_sheets", "import_file_id sheet_name sheet_index is_relevant"),
    *_required("raw_import_rows", "import_file_id row_number raw_payload"),
    *_required("stg_shop_day", "import_file_id shop_id source_row_number sales_date"),
    *_required("stg_sku_day", "import_file_id shop_id source_row_number sales_date"),
    *_required("fact_shop_day", "shop_id sales_date import_file_id source_row_number"),
    *_required("fact_sku_day", "shop_id sales_date product_id sku_id merchant_sku_code product_specification import_file_id source_row_count"),
    *_required("spu_snapshot", "shop_code sales_date spu_name campaign_name listing_name source_row_count"),
]
Rule = Unique | Reference | Required
RULES: list[Rule] = [*UNIQUE, *REFERENCES, *REQUIRED]


# References counted beside one copy of their parent's keys: each takes a counter in every key's entry.
CHILDREN = 2
# NULL flags that one number holds.
FLAGS = 60

_Keys = tuple[str, tuple[str, ...]]


def _families(rules: list[Rule]) -> tuple[list[list[_Keys]], dict[Rule, tuple[int, int]]]:
    """Key columns that are compared with each other, parent first, and the family and position of each rule's columns."""
    parents: dict[_Keys, dict[_Keys, list[Rule]]] = {}
    for r in rules:
        if isinstance(r, Reference):
            parents.setdefault((r.parent, r.parent_columns), {}).setdefault((r.table, r.columns), []).append(r)
    families: list[list[_Keys]] = []
    at: dict[Rule, tuple[int, int]] = {}
    for parent, children in parents.items():
        for i in range(0, len(children), CHILDREN):
            some = list(children)[i : i + CHILDREN]
            at |= {r: (len(families), n) for n, child in enumerate(some, 1) for r in children[child]}
            families.append([parent, *some])
    for r in rules:
        if isinstance(r, Unique):
            own = (r.table, r.columns)
            counted = next(((f, members.index(own)) for f, members in enumerate(families) if own in members), None)
            if counted is None:
                counted = (len(families), 0)
                families.append([own])
            at[r] = counted
    return families, at


def _slots(types: list[str]) -> list[tuple[str, int]]:
    """One typed slot for each key part, numbered within its type, so that families share slots."""
    return [(t, types[:i].count(t)) for i, t in enumerate(types)]


def _wide(name: str) -> str:
    """Whole numbers share the slots of the widest type."""
    return "bigint" if name in ("tinyint", "smallint", "int") else name


class _Entries:
    """The rows of one table as one entry per set of key columns: family, position in it and the key parts in typed slots.

    Keys with NULL are left out. The table is read once; unpivoting expands each row in its task.
    """

    def __init__(self, table: DataFrame):
        self.table, self.columns = table, {}
        self.groups: list[tuple[str, str, dict[tuple[str, int], str]]] = []

    def _named(self, name: str, column: Column) -> str:
        self.columns.setdefault(name, column.alias(name))
        return name

    def add(self, family: int, position: int, keys: dict[str, Column], types: list[str]) -> None:
        present = reduce(lambda a, b: a & b, [c.isNotNull() for c in keys.values()])
        group = self._named(f"family_{family}_{position}", F.when(present, F.lit(family)))
        parts = [self._named(f"key_{n}_{t}", c.cast(t)) for (n, c), t in zip(keys.items(), types, strict=True)]
        number = self._named(f"position_{position}", F.lit(position))
        self.groups.append((group, number, dict(zip(_slots(types), parts, strict=True))))

    def rows(self, slots: list[tuple[str, int]]) -> DataFrame:
        listed = [
            [group, number, *[parts.get(s) or self._named(f"none_{s[0]}", F.lit(None).cast(s[0])) for s in slots]]
            for group, number, parts in self.groups
        ]
        names = ", ".join(["family", "position", *_slot_names(slots)])
        groups = ", ".join("(" + ", ".join(f"`{c}`" for c in g) + ")" for g in listed)
        return self.table.sparkSession.sql(
            f"SELECT {names} FROM {{rows}} UNPIVOT INCLUDE NULLS (({names}) FOR entry IN ({groups})) WHERE family IS NOT NULL",
            rows=self.table.select(*self.columns.values()),
        )


def _slot_names(slots: list[tuple[str, int]]) -> list[str]:
    return [f"key_{i}" for i in range(len(slots))]


def _totals(tables: dict[str, DataFrame], rules: list[Rule], families: list[list[_Keys]], flags: dict[str, list[tuple[int, list[str]]]]) -> DataFrame:
    """Per family: keys and rows that occur twice and that lack a parent, by position; of NULL flags the rows of each combination."""
    blanks = {(r.table, c) for r in rules if isinstance(r, Unique) for c in r.blank}

    def keys_of(name: str, columns: tuple[str, ...]) -> dict[str, Column]:
        return {c: F.coalesce(F.col(c), F.lit("")) if (name, c) in blanks else F.col(c) for c in columns}

    entries = {name: _Entries(df) for name, df in tables.items()}
    slots: dict[tuple[str, int], None] = {}
    for family, members in enumerate(families):
        # The types in which all members of the family can be compared.
        common = reduce(DataFrame.union, [tables[name].select(*keys_of(name, columns).values()) for name, columns in members]).schema
        types = [_wide(f.dataType.simpleString()) for f in common.fields]
        slots |= dict.fromkeys(_slots(types))
        for position, (name, columns) in enumerate(members):
            entries[name].add(family, position, keys_of(name, columns), types)
    for name, parts in flags.items():
        for family, columns in parts:
            mask = reduce(lambda a, b: a + b, [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(0).cast("bigint") for i, c in enumerate(columns)])
            slots |= dict.fromkeys(_slots(["bigint"]))
            entries[name].add(family, 0, {f"flags_{family}": mask}, ["bigint"])
    order = list(slots)
    every = reduce(DataFrame.union, [e.rows(order) for e in entries.values() if e.groups])
    positions = range(max([len(members) for members in families], default=1))
    counts = [F.count_if(F.col("position") == p).alias(f"n_{p}") for p in positions]
    keys = every.groupBy("family", *_slot_names(order)).agg(*counts)

    def of(name: str, broken: list[Column]) -> list[Column]:
        return [
            F.array(*[F.count_if(b) for b in broken]).alias(f"{name}_keys"),
            F.array(*[F.coalesce(F.sum(F.when(b, F.col(f"n_{p}"))), F.lit(0)) for p, b in enumerate(broken)]).alias(f"{name}_rows"),
        ]

    mask = F.lit(None).cast("bigint")
    if ids := [family for parts in flags.values() for family, _ in parts]:
        mask = F.when(F.col("family").isin(ids), F.col(_slot_names(order)[order.index(("bigint", 0))]))
    twice = [F.col(f"n_{p}") > 1 for p in positions]
    lost = [(F.col(f"n_{p}") > 0) & (F.col("n_0") == 0) for p in positions]
    return keys.groupBy("family", mask.alias("flags")).agg(F.sum("n_0").alias("rows"), *of("twice", twice), *of("lost", lost))


def check(tables: dict[str, DataFrame], rules: list[Rule] = RULES) -> DataFrame:
    """One row per rule: kind, table, columns, parent, violating_keys, violating_rows (all rows of keys that occur twice,
    rows without parent, rows with NULL). Every table is read once, children and parents alike.

    Keys that are compared with each other are counted together, by table, in one aggregation over all tables: combined
    map-side, so a key with most of the rows is a few entries, and shuffled once. NULLs are counted by their combinations.
    """
    families, at = _families(rules)
    flags: dict[str, list[tuple[int, list[str]]]] = {}
    number = len(families)
    for name in tables:
        columns = list(dict.fromkeys(r.column for r in rules if isinstance(r, Required) and r.table == name))
        for i in range(0, len(columns), FLAGS):
            flags.setdefault(name, []).append((number, columns[i : i + FLAGS]))
            number += 1
    totals = materialise(_totals(tables, rules, families, flags))  # a few rows per family
    listed = []
    for n, r in enumerate(rules):
        if isinstance(r, Required):
            family, columns = next((f, c) for f, c in flags[r.table] if r.column in c)
            listed.append((n, "required", r.table, r.column, None, family, 0, 1 << columns.index(r.column)))
        elif isinstance(r, Unique):
            listed.append((n, "unique", r.table, ", ".join(r.columns), None, *at[r], 0))
        else:
            listed.append((n, "reference", r.table, ", ".join(r.columns), r.parent, *at[r], 0))
    shown = ["kind", "table", "columns", "parent"]
    types = {"rule": "int", **dict.fromkeys(shown, "string"), "family": "int", "position": "int", "flag": "bigint"}
    values = [F.struct(*[F.lit(v).cast(t).alias(c) for (c, t), v in zip(types.items(), r, strict=True)]) for r in listed]
    declared = totals.sparkSession.range(1).select(F.inline(F.array(*values)))
    unique, reference = F.col("kind") == "unique", F.col("kind") == "reference"
    keys = F.when(unique, F.get("twice_keys", "position")).when(reference, F.get("lost_keys", "position"))
    flagged = F.when(F.col("flags").bitwiseAND(F.col("flag")) != 0, F.col("rows"))
    rows = F.when(unique, F.get("twice_rows", "position")).when(reference, F.get("lost_rows", "position")).otherwise(flagged)
    found = declared.join(F.broadcast(totals), "family", "left").groupBy("rule", *shown)
    sums = {"violating_keys": keys, "violating_rows": rows}
    return found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()]).select(*shown, *sums)


def require(tables: dict[str, DataFrame], rules: list[Rule] = RULES) -> None:
    """Fail with the rules that are broken."""
    broken = check(tables, rules).filter("violating_rows > 0").collect()  # one row per rule at most
    if broken:
        raise ValueError("rules are broken: " + "; ".join(f"{r['table']} {r['kind']} ({r['columns']}): {r['violating_rows']} rows" for r in broken))
