"""Order-free comparison of a Spark result with a DuckDB one."""

import datetime
import math


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(" ")
    if isinstance(v, datetime.date):
        return v.isoformat()
    try:
        return round(float(v), 6)
    except (TypeError, ValueError):
        return str(v)


def same(df, con, sql):
    names = sorted(df.columns)
    spark_rows = sorted(repr([plain(v) for v in r]) for r in df.select(*[f"`{n}`" for n in names]).collect())
    result = con.execute(sql)
    cols = [c[0] for c in result.description]
    assert sorted(cols) == names
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    duck_rows = sorted(repr([plain(r[i]) for i in order]) for r in result.fetchall())
    assert spark_rows == duck_rows
    return len(spark_rows)
