"""Rows of two tables as sorted tuples of texts."""

import pandas as pd


def rows(pdf, columns):
    def text(v):
        if isinstance(v, (list, tuple)):
            return str(v)
        if pd.isna(v):
            return "NULL"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(text(v) for v in r) for r in pdf[columns].itertuples(index=False))


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert rows(a, columns) == rows(b, columns)
