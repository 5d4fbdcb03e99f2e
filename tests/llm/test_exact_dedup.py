from collections import defaultdict

import pytest

from cases import frame, plain, rows
from martline.llm.exact_dedup import drop_copies, exact_dedup

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[(t or "").translate(UPPER)].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        out += [(i, max(known) if known else None, len(ids)) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [1, 2, 1024])
def test_matches_brute_force_and_splits_hot_groups(spark, split):
    texts = ["Same Text", "same text", "SAME text"] * 40 + [f"single {i}" for i in range(30)] + ["É", "é", None, ""] * 5
    got = exact_dedup(plain(spark, texts), min_split_rows=split).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute(list(enumerate(texts)))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


@pytest.mark.parametrize("split", [1, 1024])
def test_odd_rows(spark, split):
    got = exact_dedup(frame(spark), min_split_rows=split).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute([(r[0], r[1]) for r in rows()])
    assert sum(r.kept for r in got) == len({(r[1] or "").translate(UPPER) for r in rows()})
    # Repeated rows: one of the two rows with id 5 stays; the null id does not win.
    assert sum(r.kept for r in got if r.doc_id == 5) == 1
    assert len({r.text_sha256 for r in got}) == len({(r[1] or "").translate(UPPER) for r in rows()})


def test_stage_keeps_columns(spark):
    docs = frame(spark)
    kept = drop_copies(docs)
    assert kept.schema == docs.schema
    assert kept.count() == len({(r[1] or "").translate(UPPER) for r in rows()})
    assert drop_copies(frame(spark, [])).count() == 0
    assert exact_dedup(frame(spark, [])).count() == 0


def test_plan_is_native_and_range_partitioned(spark):
    plan = exact_dedup(plain(spark, ["a", "b"]))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "Python" not in plan and "Arrow" not in plan
