"""Small conveniences shared by the tests."""

import contextlib
import io


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def rows(df, *names):
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=repr)
