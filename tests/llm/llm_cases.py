"""Awkward inputs that every operator of the subpackage must take."""

import datetime as dt

LONG = "thndha edwh " * 30_000 + "x" * 20_000
TEXTS = [None, "", " \t\n ", "a", "Hello, World! it's 12 o'clock", "Grüße aus Köln\nGrüße aus Köln\n\n", "12 34 !!",
         "<|endoftext|> and <|startoftext|>x", "中文 한글가́ ñ 　 \x1c\x85", "a" * 5000, LONG,
         "the same words again and again " * 40, "the same words again and again " * 40, "tie", "tie"]
#: Names that results use, and others, as further columns of the input.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score string, shard string, "
          "slot date, sequence_id string, fp double, _part int, text_hash string, size string, `odd name.x` int")


def awkward(spark, texts=None):
    texts = TEXTS if texts is None else texts
    rows = []
    for i, t in enumerate(texts):
        more = (None,) * 9 if i % 3 else ("x", "y", dt.date(2026, 1, 1), "z", 0.5, 3, "h", "big", 1)
        rows.append((None if i == 3 else i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else "src",
                     len(t) if t is not None and i % 2 else None, *more))
    rows += rows[5:7]                       # repeated rows
    rows.append((5, "another text under an id that exists", "de", "src0", 1, *(None,) * 9))
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
