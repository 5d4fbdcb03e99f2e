"""Personal data by bootstrapped contextual extraction.

Spans of the base kinds are seeds.  The words around them are lexical
patterns.  Patterns and the values they enclose form a graph that Spark scores
in rounds: a pattern is as sure as the share of its values that are known, a
value as the patterns that vouch for it.  Values of a kind's looser look found
by sure patterns become known themselves and take part in the next round.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import unpacked, with_text, written
from martline.llm.identifiers import KINDS, identifiers
from martline.session import checked_broadcast

#: Rounds of scoring.
ROUNDS = 3
#: A pattern needs so many known values, this share of known ones among its values of the kind's
#: look, and must enclose an identifier in this share of its occurrences.
MIN_VALUES, MIN_PRECISION, MIN_SPECIFIC = 5, 0.7, 0.5
#: A value is known from this confidence on.
MIN_CONFIDENCE = 0.75

_SPANS = "array<struct<kind:int,start:int,end:int>>"
_CONTEXTS = ("array<struct<start:int,end:int,kinds:int,seed:int,value:string,pattern:string,seen:double>>")
_ARROW = pa.struct([
    ("base", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))),
    ("contexts", pa.list_(pa.struct([
        ("start", pa.int32()), ("end", pa.int32()), ("kinds", pa.int32()), ("seed", pa.int32()),
        ("value", pa.string()), ("pattern", pa.string()), ("seen", pa.float64())])))])


def find_pii(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Input columns but the text, then ``n_email, n_ip, n_card, n_phone, base_spans, spans, n_found``.

    ``base_spans`` and ``spans`` (base and discovered) are texts
    ``kind:start:end``, by kind and start, joined by commas; the four counts are of base spans,
    ``n_found`` of discovered ones.  Null texts are empty and
    have none.  Repeated rows count once as evidence and are all returned; an
    empty table gives an empty result.  Input columns with a result's name are replaced.
    """
    found = _found(docs, text_col, rounds, keep_text=False)
    kinds = F.col("_base.kind")
    counts = {f"n_{k}": F.size(F.filter(kinds, _equals(n))).cast("long") for n, k in enumerate(KINDS)}
    return unpacked(found, counts | {
        "base_spans": _joined(F.col("_base")), "spans": _joined(F.col("_all")),
        "n_found": (F.size("_all") - F.size("_base")).cast("long")})


def redact_pii(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, length_col: str = "n_chars") -> DataFrame:
    """The rows with every span replaced by its kind in brackets, such as ``[EMAIL]``.

    Spans that touch are replaced by one mark, of the first.  Texts without
    spans, and null ones, stay as they are.  ``length_col``, where there is
    one, is set to the new text's length wherever the text was changed.
    """
    @F.pandas_udf("string")
    def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else _masked(t, s) for t, s in zip(texts, spans)], dtype=object)

    found = _found(docs, text_col, rounds, keep_text=True)
    text = F.col("_row").getField(text_col)
    hit = F.size("_all") > 0
    # Rows are read once and written as one file a task; only texts with spans go through Python.
    new = masked(F.when(hit, text.cast("string")), F.when(hit, _joined(F.col("_all"))))
    rows = found.withColumn("_new", F.when(hit, new).otherwise(text.cast("string")))
    columns = []
    for f in found.schema["_row"].dataType.fields:
        column = F.col("_row").getField(f.name)
        if f.name == text_col:
            column = F.col("_new")
        elif f.name == length_col:
            column = F.when(hit, F.char_length("_new").cast(f.dataType)).otherwise(column)
        columns.append(column.alias(f.name))
    return rows.select(*columns)


def _masked(text: str, spans: str) -> str:
    parts = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",")))
    out, done = [], 0
    for start, end, kind in parts:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def _equals(number: int) -> Callable[[Column], Column]:
    """A test of one argument: ``filter`` passes the index to a second one."""
    return lambda x: x == number


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _found(docs: DataFrame, text_col: str, rounds: int, keep_text: bool) -> DataFrame:
    @F.arrow_udf(f"struct<base:{_SPANS},contexts:{_CONTEXTS}>")
    def scan(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            base, contexts = identifiers(text.as_py())
            rows.append({"base": [{"kind": k, "start": s, "end": e} for k, s, e in base], "contexts": contexts})
        return pa.array(rows, type=_ARROW)

    rows = written(with_text(docs, text_col, keep_text).select("_row", scan("_text").alias("_scan"))
                   .select("_row", "_scan.*", F.monotonically_increasing_id().alias("_at")), "pii-spans")
    contexts = rows.filter(F.size("contexts") > 0).select("_at", F.explode("contexts").alias("c")).select("_at", "c.*")
    graph = _graph(contexts)
    if graph.isEmpty():  # no pattern encloses enough values: nothing to discover
        return rows.select("_row", F.col("base").alias("_base"), F.col("base").alias("_all"))
    extra = (_discovered(contexts, graph, rounds).groupBy("_at")
             .agg(F.collect_list(F.struct("kind", "start", "end")).alias("_extra")))
    # Written first; broadcast within a bound of rows and bytes, so that texts are not shuffled for a few spans.
    extra = checked_broadcast(written(extra, "pii-discovered"))
    none = F.array().cast(_SPANS)
    return rows.join(extra, "_at", "left").select(
        "_row", F.col("base").alias("_base"),
        F.array_sort(F.concat("base", F.coalesce("_extra", none))).alias("_all"))


_KIND = "explode(array(0, 1, 2, 3)) AS kind"
_MAY_BE = "shiftright(kinds, kind) & 1 = 1"


def _graph(contexts: DataFrame) -> DataFrame:
    """``pattern, value, seed, kind``: an edge for each kind that a value may be of.

    Patterns that could never be sure are left out: those with too few values
    in all, and those whose words mostly enclose something else.
    """
    edges = contexts.groupBy("pattern", "value", "kinds", "seed").agg(F.count("*").alias("times"), F.sum("seen").alias("seen"))
    viable = (edges.groupBy("pattern").agg(F.count("*").alias("values"), (F.sum("times") / F.sum("seen")).alias("specific"))
              .filter((F.col("values") >= MIN_VALUES) & (F.col("specific") >= MIN_SPECIFIC)).select("pattern"))
    return written(edges.join(viable, "pattern").selectExpr("pattern", "value", "seed", "kinds", _KIND).filter(_MAY_BE)
                   .drop("kinds").distinct(), "pii-graph")


def _discovered(contexts: DataFrame, graph: DataFrame, rounds: int) -> DataFrame:
    """``_at, kind, start, end`` of candidates that sure patterns vouch for."""
    known = seeds = graph.filter("seed = kind").select("value", "kind", F.lit(1.0).alias("sure")).distinct()
    for n in range(rounds):
        vouched = (graph.filter("seed < 0").join(_patterns(graph, known), ["pattern", "kind"])
                   .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least("precision", F.lit(0.999)))))).alias("sure"))
                   .filter(F.col("sure") >= MIN_CONFIDENCE))
        known = written(seeds.unionByName(vouched.join(seeds, ["value", "kind"], "left_anti")), f"pii-known-{n}")
    spots = (contexts.filter("seed < 0").selectExpr("*", _KIND).filter(_MAY_BE)
             .join(_patterns(graph, known), ["pattern", "kind"]).join(known, ["value", "kind"]))
    # A span of several kinds takes the one that its patterns are surest of.
    each = spots.groupBy("_at", "start", "end", "kind").agg(F.sum("precision").alias("weight"))
    return (each.groupBy("_at", "start", "end")
            .agg(F.max(F.struct(F.col("weight"), (-F.col("kind")).alias("order"))).alias("best"))
            .select("_at", (-F.col("best.order")).alias("kind"), "start", "end"))


def _patterns(graph: DataFrame, known: DataFrame) -> DataFrame:
    """Patterns that are sure of a kind, with their precision."""
    one = graph.select("pattern", "value", "kind").distinct().join(known, ["value", "kind"], "left")
    return (one.groupBy("pattern", "kind")
            .agg(F.sum(F.coalesce("sure", F.lit(0.0))).alias("sum"), F.count("sure").alias("known"), F.count("*").alias("all"))
            .filter(F.col("known") >= MIN_VALUES)
            .select("pattern", "kind", (F.col("sum") / F.col("all")).alias("precision"))
            .filter(F.col("precision") >= MIN_PRECISION))
