"""Each registered listing query built once for all tests that look at it."""

from martline.plans.queries import QUERIES

_built: dict = {}


def query(spark, sf_dir: str, name: str):
    key = (sf_dir, name)
    if key not in _built:
        _built[key] = QUERIES[name](spark, sf_dir)
    return _built[key]
