"""Comparing a DataFrame with a DuckDB query."""


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def same_rows(df, duck, sql):
    """Both results as sorted rows of sorted columns."""
    columns = sorted(df.columns)
    ours = sorted(repr([_plain(r[c]) for c in columns]) for r in df.collect())
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    theirs = sorted(repr([_plain(r[names.index(c)]) for c in columns]) for r in found.fetchall())
    assert ours == theirs
