"""Helpers for the tests; the name is no other module's."""


def plan_of(df) -> str:
    """Physical plan text."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    """Rows as tuples, ordered."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
