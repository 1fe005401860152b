"""Quality contracts: the documented tables, columns and tests of a warehouse."""

import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Rule:
    """One declared test; ``options`` holds what the test needs (values, min, ...)."""

    table: str
    column: str
    test: str
    options: dict


@dataclass(frozen=True)
class TableDoc:
    table: str
    description: str
    grain: str
    documented_columns: int


@dataclass(frozen=True)
class ColumnDoc:
    table: str
    column: str
    type: str
    description: str


@dataclass(frozen=True)
class Contract:
    tables: list
    rules: list
    columns: list = field(default_factory=list)


def _as_rule(table, column, declared):
    # A test is a bare name or a mapping whose first key is the name.
    if isinstance(declared, str):
        return Rule(table, column, declared, {})
    name = next(iter(declared))
    return Rule(table, column, name, dict(declared[name] or {}))


def parse_contract(document):
    docs, rules, documented = [], [], []
    for table in document["tables"]:
        columns = table.get("columns") or []
        text = " ".join(table.get("description", "").split())
        docs.append(TableDoc(table["name"], text, table.get("grain", ""), len(columns)))
        for column in columns:
            about = " ".join(column.get("description", "").split())
            documented.append(ColumnDoc(table["name"], column["name"], column.get("type", ""), about))
            for declared in column.get("tests") or []:
                rules.append(_as_rule(table["name"], column["name"], declared))
    return Contract(docs, rules, documented)


def contract_from_text(text, yaml=False):
    if not yaml:
        return parse_contract(json.loads(text))
    try:
        from yaml import safe_load
    except ImportError as missing:
        raise ImportError("YAML contracts need PyYAML; JSON contracts need nothing") from missing
    return parse_contract(safe_load(text))


def read_contract(spark, path):
    """Read a JSON or YAML contract from any file system the cluster knows.

    A contract is a hand-written file of a few rules; it belongs on the driver,
    where it decides which columns the quality scan computes.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    return contract_from_text(text, yaml=path.endswith((".yml", ".yaml")))
