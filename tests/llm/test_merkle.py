import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cases import frame, rows
from martline.llm import merkle
from martline.llm.merkle import folded_root, leaf_hash, merkle_proofs

FOLD = ("position", "leaves", "subtree", "subtrees", "proof")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climbed(nodes):
    """Root of a list of digests, and each one's siblings from the bottom."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, o in enumerate(own):
            if o ^ 1 < len(nodes):
                paths[n].append(nodes[o ^ 1])
        nodes = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        own = [o >> 1 for o in own]
    return nodes[0], paths


def brute(given):
    groups = {}
    for g, k, leaf in given:
        groups.setdefault(g, []).append((k is not None, k or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [(sorted(groups[g]), *climbed([x[2] for x in sorted(groups[g])])) for g in names]
    root, upper = climbed([t[1] for t in trees])
    return [(g, k if known else None, leaf, sub, root, "".join(paths[i] + upper[n]))
            for n, (g, (leaves, sub, paths)) in enumerate(zip(names, trees)) for i, (known, k, leaf) in enumerate(leaves)]


def check(spark, given):
    df = spark.createDataFrame(given, "lang string, doc_id long, leaf string")
    out = merkle_proofs(df, "doc_id", "lang").withColumn("folded", folded_root(F.col("leaf"), *map(F.col, FOLD)))
    got = [tuple(r) for r in out.select("lang", "doc_id", "leaf", "subroot", "root", "proof", "folded").collect()]
    assert sorted(got, key=str) == sorted([(*x, x[4]) for x in brute(given)], key=str)


@pytest.mark.parametrize("levels", [1, 2, 9])
@pytest.mark.parametrize("number", [1, 2, 3, 17, 100])
def test_proofs_equal_brute_force(spark, monkeypatch, levels, number):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rnd = random.Random(number)
    check(spark, [(rnd.choice([None, "a", "é", "", "b"]), rnd.choice([None, *range(number)]), H(str(i))) for i in range(number)])


def test_one_large_group_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 3)
    check(spark, [("en", i // 2, H(str(i // 2))) for i in range(1025)] + [("de", 1, H("x"))])


def test_a_changed_row_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en" if i % 3 else None) for i in range(50)], "doc_id long, text string, lang string")
    leaves = docs.select("doc_id", "lang", leaf_hash(F.col("doc_id"), F.col("text")).alias("leaf"),
                         leaf_hash(F.col("doc_id"), F.concat("text", F.lit("!"))).alias("other"))
    out = merkle_proofs(leaves, "doc_id", "lang")
    for column, want in (("leaf", True), ("other", False)):
        same = out.select((folded_root(F.col(column), *map(F.col, FOLD)) == F.col("root")).alias("same")).collect()
        assert {r.same for r in same} == {want}


def test_fields_cannot_run_into_each_other(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("-", "abc"), ("é", None)], "x string, y string")
    got = [r.h for r in df.select(leaf_hash(F.col("x"), F.col("y")).alias("h")).collect()]
    assert len(set(got)) == 6 and got[0] == H("2:ab1:c") and got[2] == H("-3:abc") and got[5] == H("2:é-")


def test_odd_rows(spark):
    leaves = frame(spark).withColumn("leaf", leaf_hash(F.col("doc_id"), F.col("text")))
    got = merkle_proofs(leaves.drop("text"), "doc_id", "lang").collect()
    assert len(got) == len(rows()) and len({r.root for r in got}) == 1
    assert merkle_proofs(leaves.filter("false"), "doc_id", "lang").count() == 0
    with pytest.raises(Exception, match="a leaf is null"):
        merkle_proofs(leaves.withColumn("leaf", F.lit(None).cast("string")), "doc_id", "lang").collect()
