"""Scans of source trees: modules with their manifests, and the classes, fields and methods of
their Python files as rows.

Files come through Spark's file sources, one row each, and are parsed where they are read; nothing
of them is ever executed.
"""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITIES = (
    "path string, model string, kind string, name string, type string, comodel string, label string, doc string, required boolean, readonly boolean, compute string, related string, "
    "selection array<struct<value:string,label:string>>, decorators array<string>, signature string, transient boolean, position int, error string"
)
MODULES = "path string, module string, name string, category string, description string, depends array<string>"
RELATIONAL = ("Many2one", "One2many", "Many2many")
_ARROW = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "array<struct<value:string,label:string>>": pa.list_(pa.struct([("value", pa.string()), ("label", pa.string())]))}
_SCHEMA = pa.schema([(n, _ARROW[t]) for n, t in (c.split(" ", 1) for c in ENTITIES.split(", "))])


def _value(node):
    return node.value if isinstance(node, ast.Constant) else None


def _text(node) -> str | None:
    value = _value(node)
    return None if value is None else str(value)


def _pairs(node) -> list[dict] | None:
    if not isinstance(node, (ast.List, ast.Tuple)):
        return None
    return [{"value": _text(e.elts[0]) or "", "label": _text(e.elts[1]) or ""} for e in node.elts if isinstance(e, (ast.List, ast.Tuple)) and len(e.elts) > 1]


def _dotted(node) -> str | None:
    """a or a.b, of a decorator with or without arguments."""
    if isinstance(node, ast.Call):
        node = node.func if isinstance(node.func, ast.Attribute) else None
    if isinstance(node, ast.Attribute):
        return f"{node.value.id if isinstance(node.value, ast.Name) else ''}.{node.attr}"
    return node.id if isinstance(node, ast.Name) else None


def _field(name: str, call: ast.Call) -> dict | None:
    """A declaration fields.Kind(...) or Kind(...)."""
    owner = call.func.value if isinstance(call.func, ast.Attribute) else None
    if owner is not None and not (isinstance(owner, ast.Name) and owner.id == "fields"):
        return None
    kind = call.func.attr if owner is not None else getattr(call.func, "id", None)
    if not kind:
        return None
    given = {k.arg: k.value for k in call.keywords if k.arg}
    first = _text(call.args[0]) if call.args else None
    linked = kind in RELATIONAL
    return {
        "kind": "field", "name": name, "type": kind,
        "comodel": _text(given.get("comodel_name")) or (first if linked else None),
        "label": _text(given.get("string")) or (None if linked else first),
        "required": bool(_value(given.get("required"))), "readonly": bool(_value(given.get("readonly"))),
        "compute": _text(given.get("compute")), "related": _text(given.get("related")), "selection": _pairs(given.get("selection")),
    }


def _members(cls: ast.ClassDef) -> Iterator[tuple[str, ast.AST]]:
    for node in cls.body:
        if isinstance(node, ast.Assign):
            yield from ((t.id, node.value) for t in node.targets[:1] if isinstance(t, ast.Name))
        elif isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            yield node.name, node


def _class(cls: ast.ClassDef) -> Iterator[dict]:
    own = dict(_members(cls))
    inherited = own.get("_inherit")
    listed = inherited.elts if isinstance(inherited, (ast.List, ast.Tuple)) else [inherited]
    parents = [p for p in map(_text, listed) if p]
    model = _text(own.get("_name")) or next(iter(parents), None)
    if not model:
        return
    about = _text(own.get("_description"))
    passing = any(isinstance(b, ast.Attribute) and b.attr == "TransientModel" for b in cls.bases)
    yield {"model": model, "kind": "model", "name": about or model, "doc": about, "transient": passing}
    for parent in parents:
        yield {"model": model, "kind": "inherits", "name": parent}
    for name, node in own.items():
        if isinstance(node, ast.Call) and not name.startswith("_"):
            field = _field(name, node)
            if field:
                yield field | {"model": model}
        elif isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            marks = [d for d in map(_dotted, node.decorator_list) if d]
            yield {"model": model, "kind": "method", "name": name, "doc": ast.get_docstring(node), "decorators": marks, "signature": f"def {name}(...)"}


def entities_of(path: str, source: bytes | str) -> list[dict]:
    """Rows of one file, in its order; a file that does not parse is one row with its error."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError, RecursionError) as e:
        return [{"path": path, "kind": "error", "error": str(e)}]
    found = (row for node in ast.walk(tree) if isinstance(node, ast.ClassDef) for row in _class(node))
    return [row | {"path": path, "position": k} for k, row in enumerate(found)]


def parse_sources(files: DataFrame) -> DataFrame:
    """Entities of files (path, content): a row for each model, parent, field and method."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_pylist(entities_of(path.as_py(), content.as_py()), schema=_SCHEMA)

    return files.select("path", "content").mapInArrow(parse, ENTITIES)


def manifest_of(source: bytes | str) -> dict:
    """The literal dictionary of a manifest; what is none, or does not parse, is empty."""
    try:
        found = ast.literal_eval(source if isinstance(source, str) else source.decode())
    except (SyntaxError, ValueError, TypeError, UnicodeDecodeError, RecursionError):
        return {}
    return found if isinstance(found, dict) else {}


def module_of(path: Column) -> Column:
    """The name of the folder that holds a file."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def parse_manifests(files: DataFrame) -> DataFrame:
    """Modules of manifest files (path, content); of modules of one name that of the last path counts."""

    schema = pa.schema([*[(n, pa.string()) for n in ("path", "name", "category", "description")], ("depends", pa.list_(pa.string()))])

    def row(path: str, content: bytes | str) -> dict:
        own = manifest_of(content)
        named = {n: own.get(n) for n in ("name", "category")} | {"description": own.get("description") or own.get("summary")}
        depends = own.get("depends", [])
        return {n: None if v is None else str(v) for n, v in named.items()} | {"path": path, "depends": [str(x) for x in depends] if isinstance(depends, (list, tuple)) else []}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(p.as_py(), c.as_py()) for p, c in zip(batch.column(0), batch.column(1))]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    shape = "path string, name string, category string, description string, depends array<string>"
    own = files.select("path", "content").mapInArrow(parse, shape).withColumn("module", module_of(F.col("path")))
    last = own.groupBy("module").agg(F.max_by(F.struct("path", "name", "category", "description", "depends"), "path").alias("m"))
    filled = {"name": F.coalesce("m.name", "module"), "category": F.coalesce("m.category", F.lit("Uncategorized")), "description": F.coalesce("m.description", F.lit(""))}
    return last.select("m.path", "module", *[c.alias(n) for n, c in filled.items()], "m.depends")


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")


def scan_tree(spark: SparkSession, path: str) -> DataFrame:
    """Entities of all Python files below the path; files whose names begin with an underscore
    (manifests, package markers) declare none."""
    return parse_sources(_files(spark, path, "*.py"))


def scan_modules(spark: SparkSession, path: str) -> DataFrame:
    """Modules below the path: folders with a manifest.  Manifests' names begin with an underscore,
    which Spark's file sources take for hidden; the driver reads them through the file system, one
    short text for each module."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, rows = fs.listFiles(root, True), []
    while found.hasNext():
        at = found.next().getPath()
        if at.getName() == "__manifest__.py":
            stream = fs.open(at)
            try:
                rows.append((at.toString(), spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
            finally:
                stream.close()
    return parse_manifests(spark.createDataFrame(rows, "path string, content string"))


def _plain(path: Column) -> Column:
    """A path without its scheme and host, which readers spell in different ways."""
    return F.regexp_replace(path, "^[a-z0-9+.-]+:/*(?=/)", "")


def in_modules(entities: DataFrame, modules: DataFrame) -> DataFrame:
    """entities with the module whose folder holds their file, the innermost of nested ones; files
    outside modules go.  A file is matched by its folders' names, not by a comparison with each
    module."""
    folder = F.regexp_replace(_plain(F.col("path")), r"/[^/]+$", "")
    parts = F.split(folder, "/")
    own = entities.select("path").distinct().withColumn("_p", parts)
    prefixes = F.transform(F.sequence(F.lit(1), F.size("_p")), lambda k: F.array_join(F.slice("_p", F.lit(1), k), "/"))
    at = own.select("path", F.explode(prefixes).alias("_root"))
    roots = modules.select("module", F.regexp_replace(_plain(F.col("path")), r"/[^/]+$", "").alias("_root"))
    found = at.join(roots, "_root").groupBy("path").agg(F.max_by("module", F.length("_root")).alias("module"))
    return entities.join(found, "path")


def states_of(entities: DataFrame) -> DataFrame:
    """(model, state, label) of the choices of fields named state."""
    chosen = entities.where("kind = 'field' and name = 'state'").select("model", F.inline("selection"))
    return chosen.select("model", F.col("value").alias("state"), "label")


def read_access(spark: SparkSession, path: str) -> DataFrame:
    """Access rules: the CSV files with a header below the path, all columns as text."""
    return spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "ir.model.access.csv").csv(path)


def edges_of(entities: DataFrame) -> DataFrame:
    """Relations between models: relational fields, inheritance, and states as transitions of the
    model to itself."""
    none = F.lit(None).cast("string")
    edge = lambda rows, target, kind, field, extra: rows.select(F.col("model").alias("source_model"), target.alias("target_model"), kind.alias("rel_type"), field.alias("field_name"), extra.alias("extra_info"))
    fields = edge(entities.where("kind = 'field' and comodel is not null"), F.col("comodel"), F.col("type"), F.col("name"), none)
    parents = edge(entities.where("kind = 'inherits'"), F.col("name"), F.lit("INHERITS"), F.lit("_inherit"), none)
    states = edge(states_of(entities), F.col("model"), F.lit("STATE_TRANSITION"), F.lit("state"), F.to_json(F.struct("state", "label")))
    return fields.unionByName(parents).unionByName(states)
