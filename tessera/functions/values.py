"""Reproducible draws and JSON values as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

TODAY = "2026-03-17"
COMPANIES = ("Alder & Finch", "Brightwater Mills", "Corvid Optics", "Dunmore Freight", "Elmstead Foods", "Fenwick Tools")
PRODUCTS = ("Oak desk", "Steel shelf", "Task lamp", "Paper tray", "Cable drum", "Packing tape")
NAMES = ("Quarterly review", "Site survey", "Line inspection", "Stock count", "Price update", "Contract renewal")
CITIES = ("Utrecht", "Bremen", "Lyon", "Turin", "Malmo", "Leeds")


@dataclass(frozen=True)
class Draws:
    """Choices that follow from a seed and a row's keys, whatever the partitioning."""

    seed: str
    keys: tuple[Column, ...]

    def bits(self, salt: str | Column) -> Column:
        return F.xxhash64(F.concat_ws("|", F.lit(self.seed), *[k.cast("string") for k in self.keys], F.lit(salt) if isinstance(salt, str) else salt))

    def integer(self, salt, lo: int, hi: int) -> Column:
        return F.pmod(self.bits(salt), F.lit(hi - lo + 1)) + lo

    def real(self, salt, lo: float, hi: float) -> Column:
        return F.round(lo + F.pmod(self.bits(salt), F.lit(1_000_000)) / 1e6 * (hi - lo), 2)

    def chance(self, salt, share: float) -> Column:
        return F.pmod(self.bits(salt), F.lit(1_000_000)) < int(share * 1e6)

    def pick(self, salt, options: Column) -> Column:
        """An element; null of an empty or null array."""
        return F.get(options, F.pmod(self.bits(salt), F.greatest(F.size(options), F.lit(1))).cast("int"))

    def choice(self, salt, options) -> Column:
        return self.pick(salt, F.array(*[F.lit(o) for o in options]))

    def date(self, salt, lo: int, hi: int) -> Column:
        return F.date_format(F.date_add(F.lit(TODAY).cast("date"), self.integer(salt, lo, hi).cast("int")), "yyyy-MM-dd")

    def moment(self, salt, lo: int, hi: int) -> Column:
        quarter = F.pmod(F.shiftright(self.bits(salt), 20), F.lit(4)) * 15
        hour = F.pmod(F.shiftright(self.bits(salt), 28), F.lit(11)) + 7
        return F.concat(self.date(salt, lo, hi), F.format_string(" %02d:%02d:00", hour, quarter))


def json_text(c: Column) -> Column:
    """The JSON of a scalar, struct, map or array; null as null."""
    inside = F.to_json(F.array(c))
    return F.substring(inside, F.lit(2), F.length(inside) - 2)


def json_object(**parts: Column) -> Column:
    """An object of parts that are JSON text already."""
    out = [F.concat(F.lit(f'{", " if i else ""}"{k}": '), F.coalesce(v, F.lit("null"))) for i, (k, v) in enumerate(parts.items())]
    return F.concat(F.lit("{"), *out, F.lit("}"))


def json_list(parts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))


def _lines(d: Draws, salt: Column, most: int, quantity: str, price: float | None) -> Column:
    """Command triples that create one to `most` lines."""

    def line(i: Column) -> Column:
        own = F.concat_ws("/", salt, i.cast("string"))
        parts = {"product_id": d.integer(F.concat(own, F.lit("p")), 50, 4200).cast("string"), quantity: d.integer(F.concat(own, F.lit("q")), 1, 120).cast("double").cast("string")}
        if price:
            parts["price_unit"] = d.real(F.concat(own, F.lit("u")), 4, price).cast("string")
        return F.concat(F.lit("[0, 0, "), json_object(**parts), F.lit("]"))

    return json_list(F.transform(F.sequence(F.lit(1), d.integer(salt, 1, most).cast("int")), line))


def generators(d: Draws, salt: Column) -> dict[str, Column]:
    """JSON text by value kind."""
    number = lambda c: c.cast("string")
    word = lambda options: json_text(d.choice(salt, options))
    tagged = lambda head, lo, hi: json_text(F.concat(F.lit(head), d.integer(salt, lo, hi).cast("string")))
    out = {
        "amount": number(d.real(salt, 180, 48000)), "cost": number(d.real(salt, 40, 12000)),
        "quantity": number(d.integer(salt, 1, 250).cast("double")), "quantity_large": number(d.integer(salt, 300, 2000).cast("double")),
        "probability": number(d.choice(salt, (10.0, 25.0, 40.0, 55.0, 70.0, 85.0))), "bool_true": F.lit("true"),
        "partner_ref": number(d.integer(salt, 120, 9800)), "vendor_ref": number(d.integer(salt, 120, 9800)), "product_ref": number(d.integer(salt, 50, 4200)), "small_id": number(d.integer(salt, 1, 40)),
        "user_list": F.concat(F.lit("[[6, 0, ["), d.integer(salt, 2, 45).cast("string"), F.lit("]]]")),
        "priority": word(("0", "1", "2", "3")), "move_type": word(("out_invoice", "in_invoice", "out_refund", "in_refund")),
        "payment_type": word(("inbound", "outbound")), "product_type": word(("consu", "service", "combo")), "maintenance_type": word(("corrective", "preventive")),
        "date_recent": json_text(d.date(salt, -45, -1)), "date_future": json_text(d.date(salt, 3, 60)), "date_future_later": json_text(d.date(salt, 61, 90)),
        "datetime_recent": json_text(d.moment(salt, -30, -1)), "datetime_future": json_text(d.moment(salt, 2, 40)),
        "company_name": word(COMPANIES), "product_name": word(PRODUCTS), "city": word(CITIES),
        "street": tagged("Mill Lane ", 1, 180), "lot_name": tagged(f"LOT-{TODAY[:4]}-", 10000, 99999), "payment_ref": tagged("SEPA CT ", 100000, 999999),
        "email": json_text(F.concat(d.choice(salt, ("info", "accounts", "orders")), F.lit("@example.com"))), "phone": tagged("+31 ", 100000000, 999999999), "vat": tagged("NL", 100000000, 999999999),
        "sale_lines": _lines(d, salt, 3, "product_uom_qty", 1800), "purchase_lines": _lines(d, salt, 3, "product_qty", 900),
        "invoice_lines": _lines(d, salt, 3, "quantity", 2400), "stock_moves": _lines(d, salt, 2, "product_uom_qty", None), "expense_lines": _lines(d, salt, 4, "quantity", 640),
    }
    return out | {k: word(NAMES) for k in ("task_name", "opportunity_name", "expense_name", "ticket_name", "maintenance_name")}


def value_of(kind: Column, d: Draws, salt: Column) -> Column:
    """JSON text for a value kind; an unknown kind fails the query."""
    out = None
    for name, column in generators(d, salt).items():
        out = F.when(kind == name, column) if out is None else out.when(kind == name, column)
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown value kind "), kind)))


def field_value(field: Column, d: Draws, salt: Column, reference: Column, state: Column) -> Column:
    """JSON text for a column of a record, by the column's name."""
    pair = F.concat(F.lit("["), d.integer(salt, 1, 9800).cast("string"), F.lit(", "), json_text(d.choice(salt, COMPANIES + PRODUCTS)), F.lit("]"))
    ids = json_list(F.transform(F.sequence(F.lit(1), d.integer(salt, 1, 3).cast("int")), lambda i: d.integer(F.concat_ws("/", salt, i.cast("string")), 1, 400).cast("string")))
    return (
        F.when(field.isin("name", "display_name", "payment_ref"), json_text(reference))
        .when(field == "state", json_text(state))
        .when(field.endswith("_ids"), ids)
        .when(field.endswith("_id"), pair)
        .when(field.rlike(r"amount|revenue|price|balance|debit|credit"), d.real(salt, 120, 42000).cast("string"))
        .when(field.rlike(r"qty|quantity|hours|days"), d.integer(salt, 0, 480).cast("double").cast("string"))
        .when(field == "probability", d.choice(salt, (10.0, 25.0, 40.0, 60.0, 80.0)).cast("string"))
        .when(field.rlike(r"deadline|planned|scheduled|due"), json_text(d.date(salt, 2, 60)))
        .when(field.rlike(r"date"), json_text(d.date(salt, -75, -1)))
        .when(field == "payment_state", json_text(d.choice(salt, ("not_paid", "partial", "in_payment", "paid"))))
        .when(field == "invoice_status", json_text(d.choice(salt, ("no", "to invoice", "invoiced", "upselling"))))
        .when(field == "priority", json_text(d.choice(salt, ("0", "1", "2"))))
        .when(field.rlike(r"^(?:is_)?reconciled$|^active$"), d.chance(salt, 0.6).cast("string"))
        .otherwise("null")
    )
