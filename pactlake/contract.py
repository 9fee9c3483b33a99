"""Contract documents: one product, its tables, columns, partitioning, rules, owner and service levels.

A document is a YAML mapping.  ``parse_product`` turns it into the dataclasses below and raises
``ContractError`` naming every problem it found, not only the first.

Differences a reader of older documents should know:

* ``freshness_hours: 24`` and ``row_count_between: [1, 100]`` are understood as parameters;
* parameters may sit next to ``columns`` or under ``params``;
* a rule without the parameter it needs is an error, as is a rule or partition on an unknown column;
* ``truncate`` partitions take a ``width``; tables may name their ``inputs``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

# Fixed values of the contract format.
TIERS = ("bronze", "silver", "gold")
COLUMN_TYPES = (
    "string", "integer", "long", "double", "float", "boolean", "timestamp",
    "date", "decimal", "binary", "array", "map", "struct",
)
RULE_KINDS = (
    "not_null", "unique", "email_format", "regex", "accepted_values",
    "min_value", "max_value", "row_count_between", "freshness_hours",
)
TRANSFORMS = ("identity", "year", "month", "day", "hour", "bucket", "truncate")
PRODUCT_NAME_PATTERN = r"^[a-z][a-z0-9_]*$"
VERSION_PATTERN = r"^\d+\.\d+\.\d+$"
IDENTIFIER_PATTERN = r"^[a-zA-Z_][a-zA-Z0-9_]*$"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
MAX_FRESHNESS_HOURS = 8760

REQUIRED_PARAMS = {
    "regex": ("pattern",),
    "accepted_values": ("values",),
    "min_value": ("min",),
    "max_value": ("max",),
    "freshness_hours": ("hours",),
}
#: Types that say more than their name, so that as elements they are written as a column without a name.
NESTED_TYPES = ("decimal", "array", "map", "struct")
TABLE_LEVEL_RULES = ("row_count_between", "freshness_hours")


class ContractError(ValueError):
    def __init__(self, problems: list[str]):
        self.problems = problems
        super().__init__("; ".join(problems))


@dataclass(frozen=True)
class Rule:
    kind: str
    columns: tuple[str, ...] = ()
    params: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Partition:
    column: str
    transform: str = "identity"
    num_buckets: int | None = None
    width: int | None = None

    @property
    def field_name(self) -> str:
        """Name of the directory column; the column itself for identity."""
        return self.column if self.transform == "identity" else f"__p_{self.column}_{self.transform}"

    def __str__(self) -> str:
        size = self.num_buckets or self.width
        return f"{self.transform}({self.column}{'' if size is None else f', {size}'})"


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = True
    pii: bool = False
    description: str | None = None
    tags: tuple[str, ...] = ()
    precision: int | None = None
    scale: int | None = None
    element: str | Column = "string"
    fields: tuple[Column, ...] = ()


@dataclass(frozen=True)
class Table:
    name: str
    tier: str
    columns: tuple[Column, ...]
    description: str | None = None
    partitions: tuple[Partition, ...] = ()
    rules: tuple[Rule, ...] = ()
    tags: tuple[str, ...] = ()
    inputs: tuple[str, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def pii_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.pii]

    @property
    def required_columns(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


@dataclass(frozen=True)
class Product:
    name: str
    version: str
    team: str
    email: str
    freshness_hours: int
    tables: tuple[Table, ...]
    availability_pct: float = 99.9
    min_row_count: int | None = None
    max_row_count: int | None = None
    description: str | None = None
    slack_channel: str | None = None
    tags: tuple[str, ...] = ()
    enabled: bool = True

    @property
    def namespace(self) -> str:
        return self.name.replace("-", "_")

    def bucket(self, prefix: str = "") -> str:
        """Object-store bucket name: underscores are not allowed there."""
        return prefix + self.name.replace("_", "-")

    def fqn(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def location(self, root: str, table: str) -> str:
        return f"{root.rstrip('/')}/{self.name}/{self.table(table).tier}/{table}"

    def table(self, name: str) -> Table:
        return next(t for t in self.tables if t.name == name)

    def in_tier_order(self) -> list[Table]:
        """Bronze to gold, and every table after the tables it reads."""
        return _by_inputs(self.tables)

    @property
    def bronze_retention_days(self) -> int:
        """Seven freshness periods, in whole days, at least one."""
        return max(1, self.freshness_hours * 7 // 24)


def _by_inputs(tables: Iterable[Table]) -> list[Table]:
    """Tables in tier order, each after its inputs; those of a circle are left out."""
    left, out = sorted(tables, key=lambda t: TIERS.index(t.tier)), []
    names = {t.name for t in left}
    while ready := next((t for t in left if not (set(t.inputs) & names) - {o.name for o in out}), None):
        left.remove(ready)
        out.append(ready)
    return out


def load_product(path: str | Path) -> Product:
    document = yaml.safe_load(Path(path).read_text())
    return parse_product(document)


def parse_product(document: Any) -> Product:
    product, problems = examine(document)
    if problems:
        raise ContractError(problems)
    return product


def examine(document: Any) -> tuple[Product, list[str]]:
    """What can be read of a document, and everything that is wrong with it."""
    problems: list[str] = []
    if not isinstance(document, dict):
        problems, document = ["a contract must be a mapping"], {}

    def check(ok: bool, message: str) -> None:
        if not ok:
            problems.append(message)

    owner, sla = _mapping(document.get("owner"), "owner", check), _mapping(document.get("sla"), "sla", check)
    name, version = str(document.get("name", "")), str(document.get("version", ""))
    check(bool(re.fullmatch(PRODUCT_NAME_PATTERN, name)), f"bad product name {name!r}")
    check(bool(re.fullmatch(VERSION_PATTERN, version)), f"bad version {version!r}")
    check(bool(owner.get("team")), "owner.team is missing")
    check(bool(re.fullmatch(EMAIL_PATTERN, str(owner.get("email", "")))), "owner.email is not an email address")
    hours, share = sla.get("freshness_hours"), sla.get("availability_pct", 99.9)
    check(_is_int(hours) and 0 < hours <= MAX_FRESHNESS_HOURS, "sla.freshness_hours must be in 1..8760")
    check(_is_number(share) and 0 <= share <= 100, "sla.availability_pct must be in 0..100")

    tables = [_parse_table(t, check) for t in _mappings(document.get("tables"), "tables", check)]
    check(bool(tables), "a product needs at least one table")
    for double in _repeated(t.name for t in tables):
        problems.append(f"duplicate table {double!r}")
    if not problems:
        check(len(_by_inputs(tables)) == len(tables), "tables read each other in a circle")
    product = Product(
        name=name, version=version, team=owner.get("team"), email=owner.get("email"),
        slack_channel=owner.get("slack_channel"), freshness_hours=hours, availability_pct=float(share) if _is_number(share) else share,
        min_row_count=sla.get("min_row_count"), max_row_count=sla.get("max_row_count"),
        tables=tuple(tables), description=document.get("description"),
        tags=tuple(document.get("tags") or ()), enabled=document.get("enabled", True),
    )
    return product, problems


def _mapping(value: Any, what: str, check) -> dict:
    check(value is None or isinstance(value, dict), f"{what} must be a mapping")
    return value if isinstance(value, dict) else {}


def _mappings(value: Any, what: str, check) -> list[dict]:
    check(value is None or isinstance(value, list), f"{what} must be a list")
    return [_mapping(v, f"an entry of {what}", check) for v in value] if isinstance(value, list) else []


def _parse_table(doc: dict, check) -> Table:
    name, tier = str(doc.get("name", "")), doc.get("tier")
    check(bool(re.fullmatch(IDENTIFIER_PATTERN, name)), f"bad table name {name!r}")
    check(tier in TIERS, f"{name}: unknown tier {tier!r}")
    columns = tuple(_parse_column(c, name, check) for c in _mappings(doc.get("schema"), f"{name}: schema", check))
    check(bool(columns), f"{name}: a table needs at least one column")
    for double in _repeated(c.name for c in columns):
        check(False, f"{name}: duplicate column {double!r}")
    declared = {c.name for c in columns}

    partitions = []
    for p in _mappings(doc.get("partition_by"), f"{name}: partition_by", check):
        spec = Partition(p.get("column", ""), p.get("transform", "identity"), p.get("num_buckets"), p.get("width"))
        check(spec.column in declared, f"{name}: partition on unknown column {spec.column!r}")
        check(spec.transform in TRANSFORMS, f"{name}: unknown transform {spec.transform!r}")
        if spec.transform == "bucket":
            check(_is_int(spec.num_buckets) and spec.num_buckets > 0, f"{name}: bucket needs num_buckets > 0")
        if spec.transform == "truncate":
            check(_is_int(spec.width) and spec.width > 0, f"{name}: truncate needs width > 0")
        partitions.append(spec)

    rules = tuple(_parse_rule(r, name, check) for r in doc.get("quality_rules") or [])
    for rule in rules:
        for column in rule.columns:
            check(column in declared, f"{name}: {rule.kind} on unknown column {column!r}")
    return Table(
        name=name, tier=tier, columns=columns, description=doc.get("description"),
        partitions=tuple(partitions), rules=rules, tags=tuple(doc.get("tags") or ()),
        inputs=tuple(doc.get("inputs") or ()),
    )


def _parse_column(doc: dict, table: str, check) -> Column:
    name, kind = str(doc.get("name", "")), doc.get("type")
    where = f"{table}.{name}"
    check(bool(re.fullmatch(IDENTIFIER_PATTERN, name)), f"bad column name {where!r}")
    check(kind in COLUMN_TYPES, f"{where}: unknown type {kind!r}")
    precision, scale = doc.get("decimal_precision"), doc.get("decimal_scale")
    if kind == "decimal":
        check(precision is not None and scale is not None, f"{where}: decimal needs precision and scale")
    fields = tuple(_parse_column(f, where, check) for f in _mappings(doc.get("fields"), f"{where}: fields", check))
    if kind == "struct":
        check(bool(fields), f"{where}: struct needs fields")
    element = doc.get("element_type", "string")
    if kind in ("array", "map"):
        if isinstance(element, dict):
            element = _parse_column({"name": "element", **element}, where, check)
        else:
            check(element in COLUMN_TYPES, f"{where}: unknown element type {element!r}")
            check(element not in NESTED_TYPES, f"{where}: element type {element!r} needs a mapping with its details")
    return Column(
        name=name, type=kind, nullable=doc.get("nullable", True), pii=doc.get("pii", False),
        description=doc.get("description"), tags=tuple(doc.get("tags") or ()),
        precision=precision, scale=scale, element=element, fields=fields,
    )


def _parse_rule(doc: Any, table: str, check) -> Rule:
    if isinstance(doc, dict) and "rule_type" in doc:
        kind, body = doc["rule_type"], {k: v for k, v in doc.items() if k != "rule_type"}
    elif isinstance(doc, dict) and len(doc) == 1:
        kind, body = next(iter(doc.items()))
    else:
        check(False, f"{table}: cannot read rule {doc!r}")
        return Rule("unreadable")

    if isinstance(body, dict):
        params = {k: v for k, v in body.items() if k not in ("columns", "params")}
        params.update(body.get("params") or {})
        columns = body.get("columns") or []
        columns = [columns] if isinstance(columns, str) else columns
    elif kind == "freshness_hours":
        columns, params = [], {"hours": body}
    elif kind == "row_count_between":
        low, high = (list(body) + [None, None])[:2] if isinstance(body, list) else (body, None)
        columns, params = [], {"min": low, "max": high}
    else:
        columns, params = (body if isinstance(body, list) else [body]), {}
    if kind == "freshness_hours" and not columns and "column" in params:
        columns = [params["column"]]

    check(kind in RULE_KINDS, f"{table}: unknown rule {kind!r}")
    for param in REQUIRED_PARAMS.get(kind, ()):
        check(params.get(param) is not None, f"{table}: {kind} needs {param!r}")
    if kind == "row_count_between":
        check(any(params.get(p) is not None for p in ("min", "max")), f"{table}: {kind} needs 'min' or 'max'")
    elif kind in RULE_KINDS:
        check(bool(columns), f"{table}: {kind} needs a column")
    return Rule(kind, tuple(str(c) for c in columns), params)


def _is_int(value: Any) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def _is_number(value: Any) -> bool:
    return isinstance(value, float) or _is_int(value)


def _repeated(names) -> list[str]:
    seen: set[str] = set()
    return [n for n in names if n in seen or seen.add(n)]
