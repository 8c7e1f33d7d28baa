"""Fingerprints by definition, and components against all pairs, in short and in long lists."""

import random
import re

import numpy as np
import pytest
import xxhash

from llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_definition(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids):
    """The least id reachable from each row, by comparing everything."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(prints))]


def texts():
    r = random.Random(11)
    base = [f"w{r.randrange(900)}é" for _ in range(150)]
    out = [None, "", "\t \n", "One", "one", "one two", "a b c d", "A  B\nc\td", "é " * 300, "x" * 50_000, " ".join(f"v{i}" for i in range(70_000))]
    for i in range(25):
        copy = list(base)
        for _ in range(i % 5):
            copy[r.randrange(150)] = f"edit{r.randrange(10**6)}"
        out.append("  ".join(copy).upper() if i % 3 else " ".join(copy))
    return out + [" ".join(f"u{r.randrange(500)}" for _ in range(60)) for _ in range(15)]


def test_fingerprints_and_components(spark):
    some = texts()
    rows = [(i * 7 % 61, t, "clash") for i, t in enumerate(some)] + [(5, some[12], ""), (5, some[12], ""), (None, some[12], ""), (None, "a lone row without an id here", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3)
    prints = [by_definition(t) for _, t, _ in rows]
    want = sorted(((i, f, c) for (i, _, _), f, c in zip(rows, prints, components(prints, [i for i, _, _ in rows]), strict=True)), key=str)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.grouped(docs).collect()), key=str)
    assert got == want
    assert simhash.grouped(docs.limit(0)).count() == 0


def pairs_linked(spark, prints, most=4):
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    roots = {r.node % (1 << 64): r.root for r in simhash.roots_of(nodes, most).collect()}
    return [roots.get(x, x) for x in prints]


@pytest.mark.parametrize(("short", "pairs"), [(2, 0), (2, 1e8), (64, 1e8)])
def test_lists_of_every_length_link_alike(spark, monkeypatch, short, pairs):
    """Clusters around few centres: tight, wide and far ones, so that pivots alone don't link all."""
    monkeypatch.setattr(simhash, "SHORT", short)
    monkeypatch.setattr(simhash, "SALT_ROWS", 40)
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    r = random.Random(5)
    prints = set()
    for size, far in ((200, 2), (200, 4), (60, 6), (60, 9)):
        centre = r.getrandbits(64)
        for _ in range(size):
            x = centre
            for b in r.sample(range(64 if far < 9 else 30), r.randrange(far + 1)):
                x ^= 1 << b
            prints.add(x)
    prints |= {r.getrandbits(64) for _ in range(100)}
    prints = sorted(prints)
    want, got = components(prints, range(len(prints))), pairs_linked(spark, prints)
    assert len(set(want)) == len(set(got)) == len(set(zip(want, got, strict=True)))


def test_near_fingerprints_agree_in_a_mask_whatever_the_pieces():
    r = random.Random(2)
    for pieces in (5, 6, 7, 9):
        masks = [m % (1 << 64) for m in simhash.masks(pieces)]
        for _ in range(300):
            x = r.getrandbits(64)
            y = x
            for b in r.sample(range(64), 4):
                y ^= 1 << b
            assert any(x & m == y & m for m in masks)
    assert [simhash.pieces_for(n) for n in (0, 10**7, 10**8, 10**10, 10**12)] == [6, 6, 7, 8, 10]


def test_bit_sums_across_blocks():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 100, dtype=np.uint64)
    bounds = np.array([0, 0, 30, 31, 31, 100, 100])
    want = [[sum(int(h) >> b & 1 for h in hashes[s:e]) for b in range(64)] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
    for block in (7, 30, 1000):
        assert simhash.bit_sums(hashes, bounds, block).tolist() == want
