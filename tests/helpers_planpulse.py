"""Helpers of the tests; the name is one that no other folder of tests uses."""


def rows(df, *cols, order=None):
    """Collect selected columns as sorted tuples (None sorts first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t)) if order is None else out
