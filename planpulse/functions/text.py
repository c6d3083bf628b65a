"""Text expressions: name cleaning, list joining, source rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from planpulse import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim all leading/trailing whitespace (Python ``str.strip``), not only spaces."""
    return F.regexp_replace(_c(c).cast("string"), r"^\s+|\s+$", "")


def clean_text(c, blanks=K.BLANK_TOKENS) -> Column:
    """Trim, collapse inner whitespace to one space; blank / 'none' / 'nan' -> NULL."""
    s = strip_ws(c)
    return F.when(s.isNull() | F.lower(s).isin(list(blanks)), F.lit(None).cast("string")) \
        .otherwise(F.regexp_replace(s, r"\s+", " "))


def json_list_text(c, chars: str = K.LIST_TRIM_CHARS, sep: str = K.LIST_SEPARATOR) -> Column:
    """Join the elements of a JSON text array, each trimmed of ``chars``.

    An empty list, a list of only NULLs, or NULL gives NULL, as an aggregate
    over zero rows does in SQL (trap T7); ``array_join`` alone would give ''.
    """
    arr = F.from_json(_c(c), "array<string>")
    trimmed = F.transform(arr, lambda x: F.btrim(x, F.lit(chars)))
    return F.when(F.exists(trimmed, lambda x: x.isNotNull()), F.array_join(trimmed, sep))


def source_rule(c,
                brand: str = K.SOURCE_BRAND_WORD, variant: str = K.SOURCE_VARIANT_WORD,
                brand_label: str = K.SOURCE_BRAND_LABEL,
                variant_label: str = K.SOURCE_VARIANT_LABEL,
                unknown: str = K.UNKNOWN_LABEL) -> Column:
    """Normalise a lead source.

    blank / none / nan -> ``unknown``; contains ``brand`` but not ``variant``
    -> ``brand_label``; contains both -> ``variant_label``; else trimmed text.
    """
    s = strip_ws(c)
    low = F.lower(s)
    has_brand = low.contains(brand.lower())
    has_variant = low.contains(variant.lower())
    return (F.when(s.isNull() | low.isin(list(K.BLANK_TOKENS)), F.lit(unknown))
             .when(has_brand & ~has_variant, F.lit(brand_label))
             .when(has_brand & has_variant, F.lit(variant_label))
             .otherwise(s))


def duration_label(m) -> Column:
    """12 -> '1 Year', else 'N Month' (F11)."""
    m = _c(m)
    return F.when(m == 12, F.lit("1 Year")).otherwise(
        F.concat(m.cast("bigint").cast("string"), F.lit(" Month")))


def recode(c, mapping: Mapping[str, str], ignore_case: bool = False,
           null_label: str | None = None) -> Column:
    """Whole-value recode.

    Exact match by default; with ``ignore_case`` keys are matched on the
    lower-cased value and unmatched values are kept as they are.  With
    ``null_label`` a NULL input is first replaced by that label, then trimmed.
    """
    s = _c(c)
    if null_label is not None:
        s = strip_ws(F.coalesce(s, F.lit(null_label)))
    probe = F.lower(s) if ignore_case else s
    out = None
    for k, v in mapping.items():
        key = k.lower() if ignore_case else k
        out = (F.when(probe == F.lit(key), F.lit(v)) if out is None
               else out.when(probe == F.lit(key), F.lit(v)))
    return s if out is None else out.otherwise(s)
