import datetime as dt

from auditlake.schema import FLAT


def ts(s):
    return None if s is None else dt.datetime.fromisoformat(s)


def flat_rows(spark, rows):
    """rows: dicts with any subset of the flat columns (others null)."""
    names = [f.name for f in FLAT.fields]
    data = []
    for r in rows:
        r = dict(r)
        if "event_time" in r and isinstance(r["event_time"], str):
            r["event_time"] = ts(r["event_time"])
        data.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(data, FLAT)


def by_id(df, *cols):
    return {r["event_id"]: (r[cols[0]] if len(cols) == 1 else tuple(r[c] for c in cols))
            for r in df.select("event_id", *cols).collect()}
