"""The read API: list-style domains, reads and grouped reads, run by Catalyst."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fk column -> (table, key): how dotted paths are followed
Relations = dict[str, tuple[DataFrame, str]]


def _term(field: Column, op: str, value) -> Column:
    if op in ("=", "=="):
        return field.isNull() if value is False or value is None else field == value
    if op in ("!=", "<>"):
        return field.isNotNull() if value is False or value is None else (field != value) | field.isNull()
    if op in ("in", "not in"):
        inside = F.coalesce(field.isin(list(value)), F.lit(False))
        return inside if op == "in" else ~inside
    if op in ("like", "ilike", "not like", "not ilike"):
        text = field if op.endswith(" like") or op == "like" else F.lower(field)
        wanted = value if op in ("like", "not like") else value.lower()
        found = F.coalesce(text.contains(wanted), F.lit(False))
        return ~found if op.startswith("not") else found
    simple = {">": lambda: field > value, ">=": lambda: field >= value, "<": lambda: field < value, "<=": lambda: field <= value}
    if op not in simple:
        raise ValueError(f"unknown operator {op!r}")
    return simple[op]()


def apply_domain(df: DataFrame, domain: list, relations: Relations | None = None) -> DataFrame:
    """Rows that satisfy all [field, op, value] terms.  'fk.field' follows a relation, and so does
    each step of a longer path (relations by the whole path so far, else by the step's name); keys
    of a relation are unique.  Prefix operators ('|', '&', '!') combine the terms after them."""
    relations = relations or {}
    base = df.columns
    followed: dict[str, DataFrame] = {}
    for term in domain:
        steps = [] if isinstance(term, str) else term[0].split(".")[:-1]
        for depth in range(len(steps)):
            at = ".".join(steps[: depth + 1])
            if at not in followed:
                other, key = relations[at] if at in relations else relations[steps[depth]]
                own = F.col(f"`__{at}`") if depth else F.col(at)
                followed[at] = other
                df = df.join(other.select(*[F.col(c).alias(f"__{at}.{c}") for c in other.columns]), own == F.col(f"`__{at}.{key}`"), "left")

    def column(name: str) -> Column:
        return F.col(f"`__{name}`") if "." in name else F.col(name)

    stack: list[Column] = []
    for t in reversed(domain):
        if t in ("&", "|"):
            a, b = stack.pop(), stack.pop()
            stack.append(a & b if t == "&" else a | b)
        elif t == "!":
            stack.append(~stack.pop())
        else:
            stack.append(_term(column(t[0]), t[1], t[2]))
    return (df.where(reduce(lambda a, b: a & b, stack)) if stack else df).select(*base)


def search_read(df: DataFrame, domain: list, fields: list[str], *, order: list | None = None, limit: int | None = None, offset: int = 0, relations: Relations | None = None, id_field: str | None = None) -> DataFrame:
    """The id first, then the fields, of matching rows."""
    out = apply_domain(df, domain, relations)
    if order:
        out = out.orderBy(*order)
    if offset:
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out.select(*([id_field] if id_field else []), *[f for f in fields if f != id_field])


def read_group(df: DataFrame, domain: list, groupby: list[str], aggregates: list[str], relations: Relations | None = None) -> DataFrame:
    """Groups with 'field:function' aggregates (sum, avg, min, max, count, count_distinct) and the
    number of rows in __count."""
    functions = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count, "count_distinct": F.count_distinct}
    aggs = [F.count("*").alias("__count")]
    for a in aggregates:
        if a != "__count":
            field, fn = a.split(":")
            aggs.append(functions[fn](field).alias(f"{field}_{fn}"))
    return apply_domain(df, domain, relations).groupBy(*groupby).agg(*aggs)


def drop_pinned(domain: list, group: str) -> list:
    """The domain without terms on the group column; ['id' > 0] where nothing is left."""
    return [t for t in domain if isinstance(t, str) or t[0] != group] or [["id", ">", 0]]


def first_of_total(df: DataFrame, order: list, limit: int) -> DataFrame:
    """The first rows in the order, each with the number of all rows as `total`."""
    return df.orderBy(*order).limit(limit).withColumn("total", df.select(F.count("*")).scalar())
