"""Secret scans by multipart credential linking, in DataFrame functions throughout.

Strong patterns are secrets by themselves.  Weak candidates (account names, values of words like
"pwd", service addresses) mean little alone: an interval join within a document links them to
complementary parts no more than SCOPE code points away, and only linked ones are reported.  An
identifier needs a secret nearby, a secret an identifier, and an address both.

Offsets come from the lengths of a pattern's matches and of the text between them, so that the
regular-expression engine does all the scanning; sums run over chunks and stay linear in practice
for texts with very many matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import set_aside
from .store import materialize

SCOPE = 200
#: (kind, pattern, group of which the length counts, least length, part)
STRONG = (
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, "secret"),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, "identifier"),
    ("hex", r"[0-9a-f]+", 0, 24, "secret"),
)
WEAK = (
    ("ident", r"""\b(?i:user|username|user_?id|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9][A-Za-z0-9@._+-]{2,}""", 0, 0, "identifier"),
    ("weak", r"""\b(?i:pass|pwd|passphrase|credential|auth|private_?key|access_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=!@#$%^&*-]{6,}""", 0, 0, "secret"),
    ("endpoint", r"""\b(?i:https?|ftp|ssh|jdbc:[a-z]{2,12}|postgres|mysql|redis|mongodb)://[A-Za-z0-9][A-Za-z0-9.:@/_-]{3,}""", 0, 0, "endpoint"),
)
_SPAN = "array<struct<start:bigint,order:int,end:bigint,kind:string,part:string>>"
_CHUNK = 256
#: hex digits are everywhere; runs that cannot reach the least length need not be matched
_GATE = {"hex": r"[0-9a-f]{24}"}


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: lambdas would compute it for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda s, v: s + v)


def _running(steps: Column) -> Column:
    """Sums of all earlier elements, chunk by chunk."""

    def cut(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / _CHUNK).cast("int")), lambda c: F.slice(s, c * _CHUNK + 1, F.lit(_CHUNK)))

    def within(chunk: Column, base: Column) -> Column:
        return F.transform(chunk, lambda _, i: base + _total(F.slice(chunk, F.lit(1), i)))

    def over(chunks: Column) -> Column:
        return _let(F.transform(chunks, _total), lambda sums: F.flatten(F.transform(chunks, lambda c, k: _let(_total(F.slice(sums, F.lit(1), k)), lambda base: within(c, base)))))

    return _let(steps, lambda s: _let(cut(s), over))


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, part: str, order: int) -> Column:
    """The matches of a pattern as spans, leftmost and non-overlapping, short ones dropped."""
    regex = F.lit(pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    counted = F.regexp_extract_all(text, regex, F.lit(group)) if group else found
    bound = F.struct(found.alias("m"), counted.alias("c"), F.split(text, pattern, -1).alias("g"))

    def measure(b: Column) -> Column:
        size = lambda c: F.length(c).cast("bigint")
        return F.transform(b["m"], lambda m, i: F.struct(size(m).alias("match"), size(F.get(b["c"], i)).alias("counted"), size(F.get(b["g"], i)).alias("gap")))

    def put(rows: Column, before: Column) -> Column:
        placed = F.transform(rows, lambda r, i: F.struct(r["counted"].alias("counted"), (F.get(before, i) + r["gap"]).alias("start"), r["match"].alias("match")))
        return F.transform(
            F.filter(placed, lambda p: p["counted"] >= least),
            lambda p: F.struct(p["start"].alias("start"), F.lit(order).alias("order"), (p["start"] + p["match"]).alias("end"), F.lit(kind).alias("kind"), F.lit(part).alias("part")),
        )

    spans = _let(bound, lambda b: _let(measure(b), lambda rows: _let(_running(F.transform(rows, lambda r: r["match"] + r["gap"])), lambda before: put(rows, before))))
    return F.when(text.rlike(_GATE.get(kind, pattern)), spans).otherwise(F.array().cast(_SPAN))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def scan_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE, keep_text: bool = True) -> DataFrame:
    """docs with columns base and secrets added (columns of those names are replaced): arrays of
    struct(start, order, end, kind, part) in order of start, then kind; base has the strong
    patterns' spans, secrets also the linked weak ones.  Offsets are code points, ends exclusive.

    A null text counts as empty and has no spans; weak candidates that overlap a strong span link
    others but are not reported themselves; texts of any length are scanned whole; repeated rows are
    scanned each for itself; other columns, whatever their names, stay as they are; an empty table
    gives an empty result.
    """
    own, back = set_aside(docs.drop("base", "secrets"), ("_weak", "_covered", "_row", "_linked"))
    whole = F.coalesce(F.col(text), F.lit(""))
    strong = [_spans(whole, *p, i) for i, p in enumerate(STRONG)]
    weak = [_spans(whole, *p, len(STRONG) + i) for i, p in enumerate(WEAK)]
    found = own.withColumns({"base": F.concat(*strong), "_weak": F.concat(*weak)})
    covered = lambda w: F.exists("base", lambda b: _overlaps(w, b))
    found = found.withColumns({"_weak": F.filter("_weak", lambda w: ~covered(w)), "_covered": F.filter("_weak", covered)})
    found = found if keep_text else found.drop(text)
    found = materialize(found.withColumns({"base": F.array_sort("base"), "_row": F.monotonically_increasing_id()}), "secrets")

    open_ = found.where("size(_weak) > 0")
    weak = open_.select("_row", F.inline("_weak"))
    parts = weak.unionByName(open_.select("_row", F.inline("base"))).unionByName(open_.select("_row", F.inline("_covered")))
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))
    parts = parts.where("part <> 'endpoint'").select(F.col("_row").alias("p_row"), F.col("part").alias("p_part"), F.col("start").alias("p_start"), F.col("end").alias("p_end"), bins(F.col("start"), F.col("end")).alias("p_bin"))
    seeking = weak.withColumn("needs", F.expr("case part when 'identifier' then array('secret') when 'secret' then array('identifier') else array('identifier', 'secret') end"))
    seeking = seeking.withColumn("need", F.explode("needs")).withColumn("bin", bins(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope))
    near = (F.col("_row") == F.col("p_row")) & (F.col("need") == F.col("p_part")) & (F.col("bin") == F.col("p_bin")) & (F.col("p_start") <= F.col("end") + scope) & (F.col("start") <= F.col("p_end") + scope)
    met = seeking.join(parts, near, "left_semi").groupBy("_row", "start", "order", "end", "kind", "part", F.size("needs").alias("n")).agg(F.count_distinct("need").alias("got"))
    linked = met.where("got = n").groupBy("_row").agg(F.collect_list(F.struct("start", "order", "end", "kind", "part")).alias("_linked"))
    more = F.coalesce("_linked", F.array().cast(_SPAN))
    joined = found.join(linked, "_row", "left")
    return back(joined.withColumn("secrets", F.array_sort(F.concat("base", more))).drop("_row", "_weak", "_covered", "_linked"))


def span_text(spans: Column | str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """text with every span of `secrets` replaced by the mask, overlapping spans by one."""
    start = F.struct(F.lit("").alias("out"), text.alias("rest"), F.lit(0).cast("bigint").alias("pos"))

    def step(acc: Column, s: Column) -> Column:
        clear = F.greatest(s["start"] - acc["pos"], F.lit(0))
        upto = F.greatest(s["end"], acc["pos"])
        inside = (s["start"] < acc["pos"]) & (acc["pos"] > 0)
        return F.struct(
            F.concat(acc["out"], F.substring(acc["rest"], F.lit(1), clear.cast("int")), F.when(inside, "").otherwise(mask)).alias("out"),
            F.substring(acc["rest"], (upto - acc["pos"] + 1).cast("int"), F.length(acc["rest"])).alias("rest"),
            upto.alias("pos"),
        )

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], acc["rest"]))).otherwise(text)
