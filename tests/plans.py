"""Reading physical plans."""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan as adaptive execution ran it."""
    df._jdf.queryExecution().executedPlan().execute().count()
    return plan(df)


def initial(df) -> str:
    """The plan before any stage ran."""
    return plan(df).split("== Initial Plan ==")[-1]
