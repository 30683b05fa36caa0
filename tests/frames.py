"""Helpers of the tests."""


def collect(df):
    return [r.asDict(recursive=True) for r in df.collect()]
