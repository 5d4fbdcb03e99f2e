"""Geocoder answers: JSON text -> postal code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOCODER_SCHEMA = ("struct<results: array<struct<address_components: "
                   "array<struct<long_name: string, types: array<string>>>>>>")


def postal_code(payload: Column | str, kind: str = "postal_code") -> Column:
    """``long_name`` of the first address component whose types contain ``kind``.

    Components are searched result by result, in order.  No results, no such
    component or malformed text give NULL.
    """
    col = F.col(payload) if isinstance(payload, str) else payload
    parsed = F.from_json(col, GEOCODER_SCHEMA, {"mode": "PERMISSIVE"})
    components = F.flatten(F.transform(parsed["results"], lambda r: r["address_components"]))
    hits = F.filter(components, lambda comp: F.array_contains(comp["types"], kind))
    return F.get(hits, 0)["long_name"]
