"""Rows of a query and of its SQL, in a form that can be compared."""


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def both(df, con, sql):
    columns = sorted(df.columns)
    own = sorted(repr(tuple(map(plain, r))) for r in df.select(*columns).collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    return own, sorted(repr(tuple(plain(r[k]) for k in order)) for r in result.fetchall())
