from datetime import date, timedelta


def d(text):
    return date.fromisoformat(text)


def days(start, n):
    return [d(start) + timedelta(days=i) for i in range(n)]


def rows(df, *columns, order=None):
    df = df.select(*columns) if columns else df
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is None, v) for v in r)) if order is None else out
