"""Settings and small in-code relations, read on the driver."""

from __future__ import annotations

import json
import os
from collections.abc import MutableMapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def read_config(path: str | Path, defaults: dict | None = None) -> dict:
    """A JSON configuration over its defaults."""
    found = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(found, dict):
        raise ValueError("a configuration is a JSON object")
    return (defaults or {}) | found


def parse_env(text: str) -> dict[str, str]:
    """NAME=VALUE lines; comments, blank lines and lines without a name are left out, quotes go."""
    out = {}
    for line in map(str.strip, text.splitlines()):
        name, found, value = line.partition("=")
        if found and name.strip() and not line.startswith("#"):
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def load_env(path: str | Path, into: MutableMapping[str, str] = os.environ) -> dict[str, str]:
    """Variables of the file that are not set yet; a missing file sets none."""
    file = Path(path)
    own = parse_env(file.read_text(encoding="utf-8")) if file.exists() else {}
    fresh = {k: v for k, v in own.items() if k not in into}
    into.update(fresh)
    return fresh


def _tool(name: str, about: str, required: str, **parameters: str) -> dict:
    shape = {"type": "object", "properties": {k: {"type": v} for k, v in parameters.items()}, "required": required.split()}
    return {"type": "function", "function": {"name": name, "description": about, "parameters": shape}}


def tool_schemas(prefix: str = "tool_", with_introspection: bool = False) -> list[dict]:
    """The calls an agent may make; with_introspection adds those that describe models."""
    own = [
        _tool(prefix + "search_read", "Rows of a model that satisfy a domain.", "model", model="string", domain="array", fields="array", limit="integer", order="string"),
        _tool(prefix + "read_group", "Groups of rows with totals and counts.", "model groupby", model="string", domain="array", groupby="array", aggregates="array"),
        _tool(prefix + "create", "A new row.", "model values", model="string", values="object"),
        _tool(prefix + "write", "New values for rows.", "model ids values", model="string", ids="array", values="object"),
        _tool(prefix + "unlink", "Removal of rows.", "model ids", model="string", ids="array"),
        _tool(prefix + "execute_method", "A method of rows.", "model method", model="string", method="string", ids="array", kwargs="object"),
    ]
    more = [
        _tool(prefix + "fields_get", "Fields of a model.", "model", model="string"),
        _tool(prefix + "methods_get", "Methods of a model.", "model", model="string"),
    ]
    return own + more if with_introspection else own


def tool_relation(spark: SparkSession, prefix: str = "tool_", with_introspection: bool = False) -> DataFrame:
    """(position, name, schema) of the calls."""
    rows = [(k, t["function"]["name"], json.dumps(t)) for k, t in enumerate(tool_schemas(prefix, with_introspection))]
    return spark.createDataFrame(rows, "position int, name string, schema string")
