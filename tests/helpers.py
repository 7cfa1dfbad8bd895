"""Helpers shared by the test modules (a name of its own: every test folder may have a ``conftest``)."""


def rows(df, *cols):
    """Collected rows as plain tuples, sorted (order-insensitive compare)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
