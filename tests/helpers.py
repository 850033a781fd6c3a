"""Helpers shared by the test modules."""


def rows(df, *order):
    """Rows as a sorted list of tuples; nulls sort last."""
    found = [tuple(r) for r in df.select(*(order or df.columns)).collect()]
    return sorted(found, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def plan_of(df):
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
