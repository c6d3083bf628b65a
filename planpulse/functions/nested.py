"""Nested-document expressions for the JSON feed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from planpulse import constants as K

# ISO-8601: extended or basic date, optional time (any number of fraction digits), optional offset.
_ISO_PATTERN = (r"^(\d{4})-?(\d{2})-?(\d{2})"
                r"(?:[T ](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?)?"
                r"(?:Z|[+-](?:[01]\d|2[0-3]):?(?:[0-5]\d)?)?$")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_local_date(c) -> Column:
    """Calendar date of an ISO timestamp in its own offset (F20, trap T13).

    The date part is taken as written; converting to a timestamp first would
    move records near midnight to another day.  Impossible dates, times
    (``25:99``) and offsets, and any other text, give NULL.
    """
    # A text that is no timestamp stays as it is, and is then no date either.
    return F.try_to_date(F.regexp_replace(_c(c).cast("string"), _ISO_PATTERN, "$1$2$3"), "yyyyMMdd")


def _scalar_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _nonempty(s: Column) -> Column:
    return s.isNotNull() & (s != "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


# Parts of a compact JSON text: strings, brackets, and what stands between them.
_JSON_PARTS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{}]|[^"\[\]{}]+'


def list_leaves(json: Column) -> Column:
    """The elements of a JSON list, lists among them opened to any depth, as JSON texts in order.

    One pass over the text's parts: brackets of lists outside every object are left out, an
    object is kept whole.
    """
    def step(a: Column, part: Column) -> Column:
        inside = a.inside + F.when(part == "{", 1).when(part == "}", -1).otherwise(0)
        scalars = F.filter(F.split(part, ","), lambda x: x != "")
        leaves = (F.when((part == "}") & (inside == 0), F.array_append(a.leaves, F.concat(a.now, part)))
                   .when((inside > 0) | (a.inside > 0) | part.isin("[", "]"), a.leaves)
                   .when(part.startswith('"'), F.array_append(a.leaves, part))
                   .otherwise(F.concat(a.leaves, scalars)))
        return F.struct(inside.alias("inside"), F.when(inside > 0, F.concat(a.now, part)).otherwise(F.lit("")).alias("now"),
                        leaves.alias("leaves"))

    none = F.struct(F.lit(0).alias("inside"), F.lit("").alias("now"), F.array().cast("array<string>").alias("leaves"))
    return F.aggregate(F.regexp_extract_all(json, F.lit(_JSON_PARTS), F.lit(0)), none, step).leaves


def variant_text(c, keys=K.FEED_NAME_KEYS, sep: str = K.LIST_SEPARATOR) -> Column:
    """Readable text of a nested value.

    Scalar -> its text; object -> the text of the first of ``keys`` whose value
    counts (not empty, null, false or zero), else its non-empty values joined;
    list -> each item's text, empties dropped, joined.  NULL, '' and [] -> ''.
    Lists may be nested to any depth: as items are joined alike at every level,
    a list is its elements in order with the inner lists opened.  Objects
    inside objects print as JSON (trap T22).
    """
    def text(v: Column, json: Column) -> Column:
        def leaf(x: Column) -> Column:
            return (F.when(x.startswith("{"), _leaf_text(F.parse_json(x), keys, sep))
                     .when(x.startswith('"'), _scalar_text(F.parse_json(x))).when(x != "null", x).otherwise(F.lit("")))

        flat = F.instr(F.substring(json, 2, 1 << 30), "[") == 0
        texts = F.when(flat, F.transform(v.try_cast("array<variant>"), lambda x: _leaf_text(x, keys, sep))) \
                 .otherwise(F.transform(list_leaves(json), leaf))
        return F.array_join(F.filter(texts, lambda p: p != ""), sep)

    def one(x: Column) -> Column:
        v, json = x["v"], x["json"]
        return F.when(json.startswith("["), text(v, json)).otherwise(_leaf_text(v, keys, sep))

    v = _c(c)
    return _let(F.struct(v.alias("v"), F.coalesce(F.to_json(v), F.lit("null")).alias("json")), one)


def _counts(text: Column) -> Column:
    """Whether a scalar's text would count as a value: not '', false or a zero."""
    return _nonempty(text) & (F.lower(text) != "false") & ~text.rlike(r"^-?0(\.0*)?$")


def _leaf_text(v: Column, keys, sep: str) -> Column:
    """The text of a scalar or an object."""
    def object_text(obj: Column) -> Column:
        named = F.coalesce(*[_let(F.try_variant_get(v, f"$.{k}", "string"), lambda t: F.when(_counts(t), t)) for k in keys])
        values = F.transform(F.map_values(obj), lambda x: F.coalesce(_scalar_text(x), F.to_json(x)))
        joined = F.array_join(F.filter(values, lambda p: p.isNotNull() & (p != "") & (p != "[]")), sep)
        return F.coalesce(named, joined)

    scalar = F.coalesce(_scalar_text(v), F.lit(""))
    return F.when(v.isNull() | F.is_variant_null(v), F.lit("")).otherwise(
        _let(v.try_cast("map<string,variant>"), lambda obj: F.when(obj.isNotNull(), object_text(obj)).otherwise(scalar)))
