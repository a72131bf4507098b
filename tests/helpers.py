import datetime as dt


def ts(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *columns, order=None):
    """Rows as tuples, sorted, with floats rounded."""
    got = [
        tuple(round(v, 6) if isinstance(v, float) else v for v in r)
        for r in (df.select(*columns) if columns else df).collect()
    ]
    return sorted(got, key=order or repr)


def series_df(spark, values, start="2024-01-01T00:00:00", step_s=60, **const):
    """One reading per step; ``const`` adds constant columns."""
    t0 = ts(start)
    data = [
        (t0 + dt.timedelta(seconds=step_s * i), i, None if v is None else float(v), *const.values())
        for i, v in enumerate(values)
    ]
    names = ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in const.items())
    return spark.createDataFrame(data, f"ts timestamp_ntz, event_id bigint, value double{', ' + names if names else ''}")
