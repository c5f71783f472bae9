"""Values and functions the tests share."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df, *cols, sort=True):
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if sort else out
