"""Column contracts: types, nullability, allowed values and row rules, checked in one aggregate."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


class ContractError(ValueError):
    """A frame doesn't keep its contract."""


@dataclass(frozen=True)
class Invariant:
    """A rule that every row keeps; rows where it is false or unknown violate it."""

    name: str
    rule: str


@dataclass(frozen=True)
class ColumnRule:
    name: str
    kind: str
    nullable: bool = True
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    """Columns in order, row rules, and columns that must not appear."""

    name: str
    columns: tuple[ColumnRule, ...]
    invariants: tuple[Invariant, ...] = ()
    forbidden: tuple[str, ...] = ()

    def schema(self) -> StructType:
        return StructType([StructField(c.name, _parse_datatype_string(c.kind), c.nullable, {"contract": self.name}) for c in self.columns])

    def to_json(self) -> str:
        columns = [{"name": c.name, "type": c.kind, "nullable": c.nullable, "allowed": list(c.allowed)} for c in self.columns]
        return json.dumps({"name": self.name, "columns": columns, "invariants": [[i.name, i.rule] for i in self.invariants], "forbidden": list(self.forbidden)}, sort_keys=True, ensure_ascii=False)

    @classmethod
    def from_json(cls, text: str) -> Contract:
        x = json.loads(text)
        return cls(x["name"], tuple(ColumnRule(c["name"], c["type"], c["nullable"], tuple(c["allowed"])) for c in x["columns"]), tuple(Invariant(*i) for i in x["invariants"]), tuple(x["forbidden"]))

    @classmethod
    def load(cls, path: str | Path) -> Contract:
        return cls.from_json(Path(path).read_text(encoding="utf-8"))

    def shape_errors(self, df: DataFrame) -> list[str]:
        """What is wrong with names, order, types or forbidden columns; no data is read."""
        out = [f"forbidden column {c}" for c in df.columns if c in self.forbidden]
        wanted = [(c.name, _parse_datatype_string(c.kind).simpleString()) for c in self.columns]
        if [tuple(x) for x in df.dtypes] != wanted:
            out.append(f"columns are {df.dtypes}, not {wanted}")
        return out

    def rules(self) -> list[Invariant]:
        """Row rules, with those of nullability and allowed values."""
        out = [Invariant(f"{c.name} is set", f"`{c.name}` IS NOT NULL") for c in self.columns if not c.nullable]
        for c in self.columns:
            if c.allowed:
                values = ", ".join("'" + v.replace("'", "''") + "'" for v in c.allowed)
                out.append(Invariant(f"{c.name} is allowed", f"`{c.name}` IS NULL OR `{c.name}` IN ({values})"))
        return out + list(self.invariants)

    def require(self, df: DataFrame) -> DataFrame:
        """df itself; raises ContractError with the names and counts of broken rules, never with values."""
        errors = self.shape_errors(df)
        if errors:
            raise ContractError("; ".join(errors))
        broken = [f"{r.invariant}: {r.violations}" for r in violations(df, self.rules()).where("violations > 0").collect()]
        if broken:
            raise ContractError("; ".join(broken))
        return df


def tagged(df: DataFrame, contract: Contract) -> DataFrame:
    """df with the contract's name in the metadata of its columns, so that a written build carries it in every footer."""
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={**df.schema[c].metadata, "contract": contract.name}) for c in df.columns])


def violations(df: DataFrame, invariants: Iterable[Invariant]) -> DataFrame:
    """(invariant, violations long): one scan for all rules."""
    rules = list(invariants)
    counted = df.agg(*[F.count_if(~F.coalesce(F.expr(i.rule), F.lit(False))).alias(f"r{n}") for n, i in enumerate(rules)])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(i.name).alias("invariant"), F.col(f"r{n}").alias("violations")) for n, i in enumerate(rules)])))


def check_rules(document: Mapping, rules: Sequence[tuple[str, str, object]]) -> list[str]:
    """Messages of the rules that a JSON document breaks. A rule is (dotted path, operator, value).

    Operators: eq, ne, in, ge, le, type (name of a Python type), sum_of (the value lists paths that add up to it).
    """

    def at(path: str):
        x = document
        for part in path.split("."):
            x = x.get(part) if isinstance(x, Mapping) else None
        return x

    tests = {
        "eq": lambda x, v: x == v and type(x) is type(v),
        "ne": lambda x, v: x != v,
        "in": lambda x, v: x in v,
        "ge": lambda x, v: x is not None and x >= v,
        "le": lambda x, v: x is not None and x <= v,
        "type": lambda x, v: type(x).__name__ == v,
        "sum_of": lambda x, v: all(at(p) is not None for p in v) and x == sum(at(p) for p in v),
    }
    return [f"{path} {op} {value!r} fails" for path, op, value in rules if not tests[op](at(path), value)]


def readiness(gates: Mapping[str, bool | None]) -> tuple[str, list[str]]:
    """READY, BLOCKED (a gate is false) or UNDECIDED (a gate is unknown), with the gates at fault."""
    closed, unknown = [g for g, ok in gates.items() if ok is False], [g for g, ok in gates.items() if ok is None]
    return ("BLOCKED", closed) if closed else ("UNDECIDED", unknown) if unknown else ("READY", [])
