import gzip
import hashlib
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from martline.llm import warc
from martline.llm.archives import LoserTree, payload_of, records, url_key
from martline.llm.quotes import link_quotes, transcripts
from martline.llm.warc import MIN_REVISIT_BYTES, archive_pages, merged_index, read_captures, write_archives

TALK = "conv_id string, turn long, role string, text string, position string"


def talk(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], TALK)


def test_links_order_and_texts(spark):
    rows = [
        ("a", 0, "user", "How do I sort a list?\nIt is long."),
        ("a", 1, "bot", "On Monday user wrote:\n> How do I sort a list?\n> It is long.\n\nUse sorted."),
        ("a", 2, "user", "Something else entirely."),
        ("a", 3, "bot", "> > how do I  SORT a list?\n> Use sorted.\nThanks for that."),
        ("a", 4, "user", ">Something else entirely.\nWhat was it?"),
        ("a", 5, "bot", "> never said by anyone\nHm."),
        ("b", 1, "user", "> Use sorted.\nOther conversation."),
    ]
    got = {(r.conv_id, r.turn): r for r in link_quotes(talk(spark, rows)).collect()}
    seen = lambda c, t: (got[c, t].parent_turn, got[c, t].thread_turn, got[c, t].depth, got[c, t].position)
    assert seen("a", 0) == (None, 0, 0, 1)
    assert seen("a", 1) == (0, 0, 1, 2)
    assert seen("a", 3) == (1, 0, 2, 3)  # the outermost level counts, not the one quoted inside
    assert seen("a", 2) == (None, 2, 0, 4)
    assert seen("a", 4) == (2, 2, 1, 5)
    assert seen("a", 5) == (None, 5, 0, 6)
    assert seen("b", 1) == (None, 1, 0, 1)
    assert got["a", 1].reply_text == "Use sorted." and got["a", 3].reply_text == "Thanks for that."
    assert got["a", 3].n_quotes == 2 and got["a", 1].chat_text == "<|bot|>\nUse sorted.\n"
    whole = {r.conv: r.transcript for r in transcripts(link_quotes(talk(spark, rows))).collect()}
    assert whole["a"].index("Thanks") < whole["a"].index("Something") and ">" not in whole["a"].replace("|>", "")


def test_short_lines_are_linked(spark):
    rows = [
        ("a", 0, "u", "Yes.\nSee you at five."), ("a", 1, "u", "No.\nThanks.\nWhen?"), ("a", 2, "u", "> Yes.\nGood."),
        ("a", 3, "u", "> Thanks.\n> When?\nAt six."), ("b", 0, "u", "Yes.\nSee you at five."), ("b", 1, "u", "Yes."),
        ("b", 2, "u", "> Yes.\n> See you at five.\nGood."), ("c", 0, "u", "A longer line.\n\nOk.\n\nSo?"), ("c", 1, "u", "Ok."),
        ("c", 2, "u", "> A longer line.\n> Ok.\nFine."),
    ]
    got = {(r.conv_id, r.turn): r.parent_turn for r in link_quotes(talk(spark, rows)).collect()}
    assert (got["a", 2], got["a", 3], got["b", 2], got["c", 2]) == (0, 1, 0, 0) and got["b", 1] is None


def test_long_chains_and_one_large_conversation(spark):
    rows = [("a", 0, "u", "message number 0 starts")] + [
        ("a", n, "u", f"> message number {n - 1} {'starts' if n == 1 else 'follows'}\nmessage number {n} follows") for n in range(1, 120)]
    got = sorted(link_quotes(talk(spark, rows)).collect(), key=lambda r: r.turn)
    assert [(r.parent_turn, r.thread_turn, r.depth, r.position) for r in got] == [
        (n - 1 if n else None, 0, n, n + 1) for n in range(120)]
    assert sorted(r.messages for r in transcripts(link_quotes(talk(spark, rows)), size=50).collect()) == [20, 50, 50]


def test_quotes_odd_rows(spark):
    rows = [("a", 0, None, None), ("a", 0, "u", ""), ("a", 1, "u", "same words here"), ("a", 1, "u", "same words here"),
            ("a", 2, "u", "> same words here"), (None, 1, "u", "> same words here"), ("a", None, "u", "> same words here"),
            (None, None, None, None), ("a", 3, "u", ">\n>>\n> >\n" + "> x\n" * 2000 + "y " * 50_000)]
    got = link_quotes(talk(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by["a", 2].parent_turn == 1 and by[None, 1].parent_turn is None and by["a", None].parent_turn is None
    assert sorted(r.position for r in got if r.conv_id == "a") == list(range(1, 8))
    assert link_quotes(talk(spark, [])).count() == 0
    plan = link_quotes(talk(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_loser_tree_merges():
    rnd = random.Random(1)
    for k in [*range(18), 33, 64]:
        runs = [sorted((rnd.randint(0, 9), i) for _ in range(rnd.randint(0, 9))) for i in range(k)]
        got = list(LoserTree([iter(r) for r in runs], lambda x: x[0]))
        assert got == sorted((x for r in runs for x in r))


def test_url_keys():
    assert url_key("http://www.Example.com:80/A/b/?z=1&a=2#x") == "com,example)/a/b?a=2&z=1"
    assert url_key("https://example.com:8443") == "com,example:8443)/"
    assert url_key(None) == "" and url_key("not a url") == "not a url" and url_key("http://[bad") == "http://[bad"


BODY = "x" * MIN_REVISIT_BYTES
PAGES = [(1, "http://a.example/", BODY), (2, "http://a.example/", BODY), (7, "http://b.example/ x\r\ny", BODY),
         (3, "http://c.example/", "small"),
         (4, "http://d.example/", "small"), (5, None, None), (6, "http://e.example/", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n é 日"), (2, "http://a.example/", BODY),
         (7, "http://a.example/", BODY), (None, "http://a.example/", BODY), (None, "", ""), (8, "http://f.example", "long " * 200_000)]


def pages(spark, rows=None):
    return spark.createDataFrame([(*r, "clash") for r in (PAGES if rows is None else rows)], "page_id long, url string, html string, _bytes string")


@pytest.mark.parametrize("compress", [False, True])
def test_archives_round_trip(spark, compress):
    path = tempfile.mkdtemp(prefix="martline-warc-")
    write_archives(pages(spark), f"{path}/w", compress=compress)
    got = merged_index(read_captures(spark, f"{path}/w")).orderBy("position").collect()
    assert len(got) == len(PAGES) and [r.position for r in got] == list(range(len(PAGES)))
    order = [(r.url_key, r.captured, r.page_id is not None, r.page_id) for r in got]
    assert order == sorted(order)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        copies = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        revisit = len(data) >= MIN_REVISIT_BYTES and i != max(copies)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(copies) if revisit else None))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == sorted(want, key=str)
    # Any reader finds the payloads again at the index's offsets.
    for r in got:
        data = open(r.archive.removeprefix("file:"), "rb").read()
        data = gzip.decompress(data) if r.archive.endswith(".gz") else data
        (_, length, head, block), *_ = records(data[r.record_offset:r.record_offset + r.record_length])
        assert length == r.record_length and head["warc-type"] == r.record_type
        if r.record_type == "response":
            assert hashlib.sha1(payload_of(block)).hexdigest() == r.payload_digest


def test_many_copies_and_empty_tables(spark):
    rows = [(i, f"http://h.example/{i}", BODY) for i in range(3000)] + [(5000 + i, "http://h.example/", f"{i}{BODY}") for i in range(50)]
    got = {r.page_id: r for r in archive_pages(pages(spark, rows)).collect()}
    assert len(got) == 3050
    assert sorted(i for i, r in got.items() if r.record_type == "response") == [2999] + [5000 + i for i in range(50)]
    assert all(got[i].refers_to == 2999 for i in range(2999))
    assert archive_pages(pages(spark, [])).count() == 0


def test_null_times_and_control_characters(spark):
    rows = [(1, "http://a.example/x\ty\x01z\x7f w", "a", "2024-03-01 10:00:00"), (2, "http://b.example/\r\nWARC-Type: x", "b", None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, at string").withColumn("at", F.col("at").cast("timestamp"))
    got = {r.page_id: r for r in archive_pages(docs, time_col="at").collect()}
    assert got[1].captured == "2024-03-01T10:00:00Z" and got[1].url == "http://a.example/x%09y%01z%7F%20w"
    assert got[2].captured == "2024-01-01T00:00:02Z" and got[2].url == "http://b.example/%0D%0AWARC-Type:%20x"
    assert got[None].captured == "2024-01-01T00:00:00Z" and got[None].url is None


def test_ranges_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ROWS", 50)
    rows = [(i, f"http://h.example/{i % 7}", f"page {i}") for i in range(2000)]
    got = archive_pages(pages(spark, rows))
    kept = got.orderBy("position").collect()
    assert [r.position for r in kept] == list(range(2000)) and len({r.page_id for r in kept}) == 2000
    order = [(r.url_key, r.captured, r.page_id) for r in kept]
    assert order == sorted(order)


def test_broken_archives_raise():
    with pytest.raises(ValueError):
        list(records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"))
    with pytest.raises(ValueError):
        list(records(b"nothing"))
