"""The registered queries of the text operators: against DuckDB, or against brute force, on sf0.001."""

import hashlib
import os
import shutil
import subprocess
import sys
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracles import compare, duck
from martline.llm.exact_dedup import exact_dedup
from martline.llm.queries import ORACLES, QUERIES
from martline.llm.wordbpe import default_vocabulary, library
from test_bpe_and_packing import check_packing
from test_fertility import brute_repeated
from test_pii import brute as brute_pii
from test_simhash import brute_print, components

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TOK = library(default_vocabulary())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.fixture(scope="module")
def docs(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def run(spark, sf_dir, prefix):
    return QUERIES[next(n for n in QUERIES if n.startswith(prefix))](spark, sf_dir)


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [n for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_small, con, name):
    df = QUERIES[name](spark, sf_small)
    result = con.execute(ORACLES[name])
    message = compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in result.description], result.fetchall())
    assert message is None, message


@pytest.mark.parametrize("name", ["op5_exact_dedup", "op9_quote_linking"])
def test_native_queries_run_no_python(spark, sf_small, name):
    plan = QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_op1(spark, sf_small, docs):
    got = run(spark, sf_small, "op1_").collect()
    ids = {i: np.array(TOK.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4") for i, t in docs.items()}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(n == 4096 for s, n in ends.items() if s != max(ends))
    assert check_packing  # the same rules on odd texts


def test_op3(spark, sf_small, docs):
    kinds = ("email", "ip", "card", "phone")
    for r in run(spark, sf_small, "op3_").collect():
        base = brute_pii(docs[r.doc_id] or "")
        text = ",".join(f"{kinds[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(x[0] == n for x in base) for n in range(4)]
        assert set(text.split(",")) <= set(r.spans.split(","))


def test_op4(spark, sf_small, docs):
    for r in run(spark, sf_small, "op4_").collect():
        ids = TOK.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(TOK.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_op6(spark, sf_small, docs):
    order = sorted(docs)
    prints = [brute_print(docs[i]) for i in order]
    want = {i: (f"{p:016x}", order[c]) for i, p, c in zip(order, prints, components(prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, sf_small, "op6_").collect()} == want


def test_op7(spark, sf_small, docs):
    import re
    for r in run(spark, sf_small, "op7_").collect():
        text = docs[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        repeated = brute_repeated(words)
        failed = len(words) < 50 or 100 * repeated > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:n] for n, x in enumerate(lines)), repeated, failed)
        assert not (r.kept and failed)


@pytest.mark.parametrize("prefix,label,folds,fold,least", [("op2_", "toxic", 3, 1, 0.9), ("op8_", "quality", 4, 2, 0.95)])
def test_classifiers_hold_up_on_documents_kept_back(spark, prefix, label, folds, fold, least):
    sf = "/root/testdata/sf0.01"
    labels = dict(duck(sf).execute(f"SELECT doc_id, {label} FROM labels").fetchall())
    got = run(spark, sf, prefix).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in got)
    back = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in back) >= least * len(back)


def test_pipeline_stages_take_effect(spark, sf_small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "simhash_near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, before, sf_small), f"test-{name}")
        assert after.columns == docs.columns
        ids = {r.doc_id for r in after.collect()}
        if name == "quality_rules":
            kept = {r.doc_id for r in run(spark, sf_small, "op7_").filter("kept").collect()}
            assert ids == kept
        elif name == "exact_dedup":
            assert ids == {r.doc_id for r in exact_dedup(before).filter("kept").collect()}
        elif name == "simhash_near_dedup":
            rows = sorted((r.doc_id, r.text) for r in before.collect())
            assert ids == {rows[c][0] for c in components([brute_print(t) for _, t in rows])}
        else:
            found = {r.doc_id: r for r in after.collect()}
            for r in before.collect():
                base = brute_pii(r.text)
                assert not brute_pii(found[r.doc_id].text) and (base or found[r.doc_id].text == r.text)
                assert found[r.doc_id].n_chars == len(found[r.doc_id].text) or not base
        before = after
    pieces = corpus_pipeline.run(spark, sf_small).collect()
    kept = {r.doc_id: r.text for r in before.collect()}
    assert {r.doc_id for r in pieces} == set(kept)
    assert sum(r.length for r in pieces) == sum(len(TOK.encode(t, add_special_tokens=False).ids) + 1 for t in kept.values())


def test_pipeline_takes_odd_rows_and_empty_tables(spark):
    from cases import frame
    for given in (frame(spark), frame(spark, [])):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, "unused"), f"odd-{name}")
        assert "sequence_id" in docs.columns


def test_the_rest_imports_without_this_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "martline"):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        copy(f"{ROOT}/{name}", tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if "." not in name else {}))
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"],
                         cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode == 0 and out.stdout.split()[1] == "False", out.stderr
