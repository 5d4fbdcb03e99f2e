import random

import numpy as np
import pytest
import xxhash

from cases import frame, plain, rows
from martline.llm.components import connected_components
from martline.llm.simhash import POSITION_SETS, drop_near_copies, fingerprint_links, simhash_components
from martline.llm.textstats import simhash


def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, limit=3):
    """Smallest index reachable, by brute force."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= limit:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def texts():
    rnd = random.Random(5)
    out = []
    for _ in range(25):
        words = [rnd.choice("alpha beta gamma delta one two three four five six".split()) + str(rnd.randint(0, 99)) for _ in range(150)]
        out.append(" ".join(words))
        for _ in range(rnd.randint(0, 5)):
            words[rnd.randrange(150)] = "changed"
            out.append(" ".join(words))
    return out + ["", None, "  ", "two words", "Two Words", "one"]


def test_every_three_positions_lie_in_one_set():
    assert len(POSITION_SETS) == 14
    for a in range(8):
        for b in range(a):
            for c in range(b):
                assert sum({a, b, c} <= set(s) for s in POSITION_SETS) == 1
                assert any(not {a, b, c} & set(s) for s in POSITION_SETS)


def test_fingerprints_and_components(spark):
    given = texts()
    got = {r.doc_id: r for r in simhash_components(plain(spark, given)).collect()}
    prints = [brute_print(t) for t in given]
    assert [int(got[i].fingerprint, 16) for i in range(len(given))] == prints
    assert [got[i].component_id for i in range(len(given))] == components(prints)
    assert len(set(components(prints))) < len(given)


@pytest.mark.parametrize("block", [4, 64, 4096])
def test_dense_lists_lose_no_link(spark, block):
    rnd = random.Random(9)
    prints = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(50):
            prints.add(centre ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 3))))
    prints = sorted(prints)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = fingerprint_links(nodes, "fp", block=block)
    found = links.collect()
    assert all((int(np.int64(r.a).view(np.uint64)) ^ int(np.int64(r.b).view(np.uint64))).bit_count() <= 3 for r in found)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    groups, want = {}, {}
    for n, (s, c) in enumerate(zip(signed, components(prints))):
        groups.setdefault(roots.get(s, s), set()).add(n)
        want.setdefault(c, set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
    assert connected_components(links.limit(0)).count() == 0


def test_odd_rows(spark):
    got = simhash_components(frame(spark)).collect()
    assert len(got) == len(rows())
    assert {r.doc_id for r in got if r.fingerprint == "0" * 16} == {1, 2, 3, None}
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    assert simhash_components(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        simhash_components(frame(spark), max_distance=4)


def test_stage_keeps_one_of_each(spark):
    docs = frame(spark)
    kept = drop_near_copies(docs)
    assert kept.schema == docs.schema
    # Two components may have the same smallest id where ids repeat.
    assert kept.count() == len(set(components([brute_print(r[1]) for r in rows()])))
    assert drop_near_copies(frame(spark, [])).count() == 0


def test_long_text_is_read_whole():
    words = [f"w{i}" for i in range(200_000)]
    assert simhash(" ".join(words), 3) != simhash(" ".join(words[:100_000]), 3)
