"""Texts made from calls, results and schemas, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHOWN = 1400
READABLE = {"partner_id": "customer", "user_id": "owner", "company_id": "company", "product_id": "product", "amount_total": "total", "date_order": "order date"}


def steps_text(steps: Column) -> Column:
    """Steps (name, arguments, payload, ok) as numbered lines; long payloads are cut in the view."""

    def line(s: Column, i: Column) -> Column:
        payload = F.when(F.length(s["payload"]) > SHOWN, F.concat(F.substring(s["payload"], 1, SHOWN), F.lit(" …(cut)"))).otherwise(s["payload"])
        status = F.when(s["ok"], "OK").otherwise("RAISED")
        return F.concat(F.lit("Step "), (i + 1).cast("string"), F.lit(" ["), status, F.lit("]  "), s["name"], F.lit("("), s["arguments"], F.lit(")\n         returned: "), payload)

    return F.array_join(F.transform(steps, line), "\n")


def schema_text(model: Column, fields: Column, methods: Column, most: int = 22) -> Column:
    """A model's fields (name, type, comodel, required, label) in three groups and its methods."""

    def field(f: Column) -> Column:
        target = F.coalesce(F.concat(F.lit(" -> "), f["comodel"]), F.lit(""))
        return F.concat(F.lit("  "), f["name"], F.lit(" ("), f["type"], target, F.lit(")"), F.when(f["required"], " [required]").otherwise(""), F.lit(": "), F.coalesce(f["label"], F.lit("")))

    def method(m: Column) -> Column:
        moves = F.concat(F.lit(" ["), m["from_state"], F.lit(" -> "), m["to_state"], F.lit("]"))
        return F.concat(F.lit("  "), m["name"], F.lit("()"), F.coalesce(moves, F.when(m["returns_action"], " [opens a wizard]"), F.lit("")), F.lit(": "), m["intent"])

    def group(title: str, rows: Column, n: int) -> Column:
        return F.when(F.size(rows) > 0, F.concat(F.lit(title + "\n"), F.array_join(F.transform(F.slice(rows, 1, n), field), "\n")))

    needed = lambda f: F.coalesce(f["required"], F.lit(False))
    linked = lambda f: f["comodel"].isNotNull()
    return F.concat_ws(
        "\n",
        F.concat(F.lit("=== Schema of "), model, F.lit(" ===")),
        group("Required fields:", F.filter(fields, needed), 10),
        group("Relations:", F.filter(fields, linked), 10),
        group("Other fields:", F.filter(fields, lambda f: ~needed(f) & ~linked(f)), most),
        F.concat(F.lit("Methods:\n"), F.array_join(F.transform(methods, method), "\n")),
    )


def readable(field: Column, domain: Column) -> Column:
    """A column's name for people; the partner is a vendor in purchases and a contact in HR."""
    out = F.when((field == "partner_id") & (domain == "purchase"), "vendor").when((field == "partner_id") & (domain == "hr"), "contact")
    for name, word in READABLE.items():
        out = out.when(field == name, word)
    return out.otherwise(F.replace(F.regexp_replace(field, "_id", ""), F.lit("_"), F.lit(" ")))


def query_text(label: Column, domain: Column, arguments: Column) -> Column:
    """What the JSON arguments of a read or a grouped read ask for, in words."""
    got = lambda path, shape: F.from_json(F.get_json_object(arguments, path), shape)
    group = F.get(got("$.groupby", "array<string>"), F.lit(0))
    measures = F.transform(F.filter(got("$.aggregates", "array<string>"), lambda a: a != "__count"), lambda a: readable(F.substring_index(a, ":", 1), domain))
    counted = F.concat(F.lit("a count of "), label, F.lit(" records by "), readable(group, domain))
    totals = F.concat(label, F.lit(" records totalled by "), readable(group, domain), F.lit(", with "), F.array_join(measures, " and "))
    fields = F.slice(F.filter(got("$.fields", "array<string>"), lambda f: f != "id"), 1, 5)
    listed = F.concat(F.lit("a list of "), label, F.lit(" records with "), F.array_join(F.transform(fields, lambda f: readable(f, domain)), ", "))
    head = F.when(group.isNull(), listed).when(F.size(measures) > 0, totals).otherwise(counted)

    def condition(t: Column) -> Column:
        field, op, value = F.get(t, F.lit(0)), F.get(t, F.lit(1)), F.get(t, F.lit(2))
        name = readable(field, domain)
        text = (
            F.when(op == "=", F.concat(F.lit("where "), name, F.lit(" is "), value))
            .when((op == ">=") & value.rlike("^[0-9]{4}-"), F.concat(F.lit("dated "), value, F.lit(" or later")))
            .when(op == ">", F.concat(F.lit("with "), name, F.lit(" above "), value))
            .when(op == "ilike", F.concat(F.lit("matching '"), value, F.lit("'")))
        )
        return F.when((F.size(t) == 3) & (field != "id"), F.concat(F.lit("only those "), text))

    terms = F.array_compact(F.transform(F.coalesce(got("$.domain", "array<array<string>>"), F.array().cast("array<array<string>>")), condition))
    return F.concat(F.array_join(F.concat(F.array(head), terms), "; "), F.lit("."))
