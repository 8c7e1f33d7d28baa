"""Every operator against a brute-force version on a small table with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm import decontaminate, minhash, mixing, quality_classifier, quality_rules, repeated_bytes, sparkkit, substring_dedup, toxicity, url_filter, warc
from llm.labelled import training
from llm.sparkkit import shared_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, value string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def language(seed, n, stock=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(stock)}é" if r.random() < 0.1 else f"w{r.randrange(stock)}" for _ in range(n))


def table():
    """Odd texts, copies, near copies, and passages that documents share."""
    r = random.Random(4)
    passage = language(900, 70, 5000)
    texts = [None, "", " \n\t", "one", "one two three", language(1, 4000), "same " * 300, "A b\nA b\n\nA b c d\nA b c d", "#### $$ " * 40 + language(2, 40)]
    texts += [language(10 + i, 120, 5000) for i in range(20)]
    base = language(500, 200, 5000).split()
    for i in range(12):
        copy = list(base)
        for _ in range(i // 2):
            copy[r.randrange(len(copy))] = f"edit{r.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += [" ".join(base).upper()] * 3
    texts += [language(700 + i, 60, 5000) + " " + passage + " " + language(800 + i, 30, 5000) for i in range(6)]
    rows = [(i * 3 % 101, t, [None, "en", "de"][i % 3], [None, "a", "b", "src"][i % 4], None if t is None else len(t), "clash") for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (rows[14][0], "another text of a repeated id " * 30, "en", "a", 1, "clash"), (None, rows[20][1], None, None, 1, "clash"), (None, language(77, 90, 5000), "en", "a", 1, "clash")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return table()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def unique(spark, rows):
    """Rows with ids of their own."""
    seen, out = set(), []
    for row in rows:
        if row[0] is not None and row[0] not in seen:
            seen.add(row[0])
            out.append(row)
    return out


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text):
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def brute_components(rows, percent):
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((row[0], len(sets[i]), min(ids, default=None)))
    return out


@pytest.mark.parametrize("percent", [85, 80])
def test_near_dedup_finds_all_components(docs, rows, percent):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.grouped(docs, percent).collect())
    assert got == Counter(brute_components(rows, percent))


def test_near_dedup_keeps_one_document_of_each_group(spark, docs, unique, none):
    d = spark.createDataFrame(unique, DOCS)
    kept = minhash.deduplicated(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c in brute_components(unique, 85) if i == c)
    assert minhash.grouped(none).count() == 0


def test_near_dedup_of_a_large_group_of_varied_copies(spark):
    """Copies that differ so much that the central members don't link them all."""
    r = random.Random(8)
    base = language(3, 150, 5000).split()
    texts = [" ".join(base)]
    for i in range(120):
        copy = texts[r.randrange(len(texts))].split()
        for _ in range(r.randrange(5)):
            copy[r.randrange(len(copy))] = f"x{i}y{r.randrange(999)}"
        texts.append(" ".join(copy))
    rows = [(i, t, "en", "a", 1, "") for i, t in enumerate(texts)]
    got = Counter((x.doc_id, x.n_shingles, x.component_id) for x in minhash.grouped(spark.createDataFrame(rows, DOCS)).collect())
    assert got == Counter(brute_components(rows, 85))


@pytest.mark.parametrize(("percent", "more"), [(85, 11), (80, 15)])
def test_near_dedup_of_sets_around_the_sketch_size(spark, percent, more):
    # 63 shingles in 74 or 78: what the larger set has more may all stand in its sketch
    rows = []
    for k in range(100):
        text = language(12000 + k, 67, 50000)
        rows += [(2 * k, text, None, None, 1, None), (2 * k + 1, text + " " + language(13000 + k, more, 50000), None, None, 1, None)]
    got = Counter((x.doc_id, x.n_shingles, x.component_id) for x in minhash.grouped(spark.createDataFrame(rows, DOCS), percent).collect())
    assert got == Counter(brute_components(rows, percent))


def brute_bytes(rows):
    rows = sorted(rows)
    seen, out = set(), []
    for row in rows:
        b = (row[1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            s = b[p : p + 100]
            if s in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((row[0], len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_bytes_matches_brute_force(spark, unique, none):
    d = spark.createDataFrame(unique, DOCS).repartition(5)
    got = sorted(tuple(r) for r in repeated_bytes._cut(d, ("doc_id",), True).collect())
    assert got == sorted(brute_bytes([(r[0], r[1]) for r in unique]))
    assert repeated_bytes.cut_texts(none).count() == 0


def test_repeated_bytes_of_many_overlapping_passages(spark):
    r = random.Random(5)
    stock = ["".join(r.choice("abcde fgh") for _ in range(r.randrange(40, 260))) for _ in range(12)]
    rows = [(i, "".join(r.choice(stock)[r.randrange(20) :] for _ in range(r.randrange(1, 7)))) for i in range(150)] + [(500, "ab" * 400), (501, "ab" * 90), (502, "x" * 99), (503, "x" * 100), (504, "x" * 101)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert sorted(tuple(x) for x in repeated_bytes._cut(d, ("doc_id",), True).collect()) == sorted(brute_bytes(rows))


def test_repeated_bytes_takes_odd_rows(docs, rows):
    got = repeated_bytes.cut_texts(docs, ("doc_id", "value")).collect()
    assert len(got) == len(rows)
    same = [r for r in got if r.doc_id == rows[12][0]]
    assert len({(r.n_removed, bytes(r.kept_bytes)) for r in same}) == 1


def test_passages_are_found_and_clean_documents_left_alone(spark, unique):
    d = spark.createDataFrame(unique, DOCS).repartition(3)
    found = substring_dedup.passages(d).collect()
    place = {r[0]: i for i, r in enumerate(unique)}
    shared = sorted(r[0] for r in unique if r[1] and language(900, 70, 5000) in r[1])
    first = shared[0]
    for doc in shared[1:]:
        assert any(x.doc_id == doc and x.n_words >= 68 for x in found), doc
    assert all(x.other_id < x.doc_id and x.similarity >= 0.8 for x in found)
    clean = {r[0] for i, r in enumerate(unique) if r[1] in {language(10 + k, 120, 5000) for k in range(20)}}
    assert not clean & {x.doc_id for x in found}
    cut = {r.doc_id: r.text for r in substring_dedup.without_passages(d).collect()}
    assert language(900, 70, 5000) in cut[first]
    assert all(language(900, 70, 5000) not in cut[x] for x in shared[1:])
    assert all(cut[x] == unique[place[x]][1] for x in clean)


def test_compact_windows_match_their_definition():
    import numpy as np

    r = np.random.default_rng(3)
    for width in (1, 2, 5, 9):
        sizes = r.integers(0, 60, 12)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        values = r.integers(0, 40, bounds[-1]).astype(np.uint64) << np.uint64(40)
        want = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            for c in range(a, b):
                left, right = c, c
                while left > a and values[left - 1] > values[c]:
                    left -= 1
                while right < b - 1 and values[right + 1] >= values[c]:
                    right += 1
                if right - left + 1 >= width:
                    want.append((left, c, right))
        assert sorted(zip(*(x.tolist() for x in substring_dedup.compact_windows(values, bounds, width)))) == sorted(want)


def brute_windows(a, b, percent=80):
    """Places of a's tokens that b has too, in any two windows of 46 tokens that are similar enough."""
    out, size = set(), 46
    for i in range(len(a) - size + 1):
        x = set(a[i : i + size])
        for j in range(len(b) - size + 1):
            y = set(b[j : j + size])
            if len(x & y) * 100 >= len(x | y) * percent:
                out |= {k for k in range(i, i + size) if a[k] in y}
    return out


def edited(r, words, n):
    """The words with n edits at random places: a word replaced, left out or put in."""
    out = list(words)
    for _ in range(n):
        at, kind = r.randrange(len(out)), r.randrange(3)
        out[at : at + (kind < 2)] = [f"edit{r.randrange(10**9)}"] * (kind != 1)
    return out


def tokens_of(words):
    return [hash(tuple(words[i : i + 5])) & 0xFFFFFFFF for i in range(len(words) - 4)]


def run_places(a, b):
    runs = substring_dedup.similar_runs(np.array(a, np.uint32), np.array(b, np.uint32))
    for s, e, t, f, similarity in runs:
        x, y = set(a[s:e]), set(b[t:f])
        assert min(e - s, f - t) >= 46 and similarity == len(x & y) / len(x | y) >= 0.8
    return {k for s, e, *_ in runs for k in range(s, e)}


def test_similar_runs_bridge_edits():
    r = random.Random(31)
    for n in range(60):
        passage = language(3000 + n, r.randrange(50, 110), 5000).split()
        copy = edited(r, passage, 1 + n % 3)
        around = [language(4000 + 4 * n + k, 30, 5000).split() for k in range(4)]
        a, b = tokens_of(around[0] + copy + around[1]), tokens_of(around[2] + passage + around[3])
        assert brute_windows(a, b) <= run_places(a, b), n
    passage = language(5000, 60, 5000).split()
    changed = passage[:30] + ["other"] + passage[31:]
    a, b = tokens_of(changed), tokens_of(passage)
    assert run_places(a, b) == set(range(56))


def test_similar_runs_of_exact_passages_beside_repeated_phrases():
    r = random.Random(32)
    for n in range(20):
        passage = language(6000 + n, 50 + n % 3, 5000).split()
        around = [language(7000 + 4 * n + k, 60, 5000).split() for k in range(4)]
        at, gap = r.randrange(len(passage) - 6), r.randrange(12, 26)
        if n % 2:
            around[2][60 - gap : 65 - gap] = passage[at : at + 5]
        else:
            around[3][gap - 5 : gap] = passage[at : at + 5]
        a, b = tokens_of(around[0] + passage + around[1]), tokens_of(around[2] + passage + around[3])
        assert set(range(60, 60 + len(passage) - 4)) <= run_places(a, b), n


def test_passages_of_documents_that_share_a_frequent_one(spark):
    frequent = [language(8000 + k, 55, 5000) for k in range(2)]
    rare = [language(8100 + k, 6, 5000) for k in range(3)]
    rows = [(k, " ".join([language(8200 + k, 20, 5000), *frequent, language(8300 + k, 20, 5000)])) for k in range(60)]
    # three pairs of documents share 6 words more, beside what all share
    for k, (i, j) in enumerate(((20, 50), (13, 41), (31, 32))):
        for at in (i, j):
            rows[at] = (at, " ".join([language(8200 + at, 20, 5000), *frequent, rare[k], language(8300 + at, 20, 5000)]))
    found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered = lambda doc: {p for r in found if r.doc_id == doc for p in range(r.start, r.start + r.n_words)}
    assert all(set(range(20, 130)) <= covered(k) for k in range(1, 60))
    for i, j in ((20, 50), (13, 41), (31, 32)):
        assert set(range(20, 136)) <= covered(j) and not set(range(132, 136)) & covered(i)


def test_passages_match_brute_force(spark):
    r, rows = random.Random(33), []
    for k in range(200):
        passage = language(20000 + k, 50 if k < 150 else r.randrange(50, 60), 5000).split()
        # one word of 50 leaves 41 of 51 shingles, one or two edits of up to 59 words 0.80 to 0.90 in most
        at = 5 + k % 40
        copy = [*passage[:at], f"edit{k}", *passage[at + 1 :]] if k < 150 else edited(r, passage, 1 + k % 2)
        rows += [(2 * k + side, " ".join([language(50000 + 4 * k + 2 * side, 15, 5000), *words, language(50001 + 4 * k + 2 * side, 15, 5000)])) for side, words in enumerate((passage, copy))]
    places = {}
    for x in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        places.setdefault((x.doc_id, x.other_id), set()).update(range(x.start, x.start + x.n_words - 4))
    tokens = {doc: tokens_of(text.split()) for doc, text in rows}
    # a token that documents of different pairs share is rare, and 46 of them are not to be expected
    want = {(2 * k + 1, 2 * k): brute_windows(tokens[2 * k + 1], tokens[2 * k]) for k in range(200)}
    want = {pair: at for pair, at in want.items() if at}
    caught = sum(at <= places.get(pair, set()) for pair, at in want.items())
    print(f"recall {caught} of {len(want)}")
    assert len(want) > 150 and caught == len(want)
    assert places.keys() <= {(2 * k + 1, 2 * k) for k in range(200)}


def test_passages_of_large_groups_match_brute_force(spark):
    """Each run of the least length that an earlier document has similar is covered by four fifths or more, also in lists too long for all pairs."""
    r, rows = random.Random(44), []
    for group in range(2):
        base = language(70000 + group, 90, 5000).split()
        for k in range(20):
            own = [language(71000 + 100 * group + 2 * k + side, 12, 5000) for side in range(2)]
            rows.append((20 * group + k, " ".join([own[0], *edited(r, base, k % 4), own[1]])))
    places = {}
    for x in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        places.setdefault(x.doc_id, set()).update(range(x.start, x.start + x.n_words - 4))
    tokens, runs, caught = {doc: tokens_of(text.split()) for doc, text in rows}, 0, 0
    for doc, own in tokens.items():
        sets = [[set(tokens[d][j : j + 46]) for j in range(len(tokens[d]) - 45)] for d in range(doc - doc % 20, doc)]
        for i in range(len(own) - 45):
            x = set(own[i : i + 46])
            if any(len(x & y) * 100 >= len(x | y) * 80 for each in sets for y in each):
                runs += 1
                caught += 46 - len(set(range(i, i + 46)) & places.get(doc, set())) <= 9
    print(f"recall {caught} of {runs} runs")
    assert runs > 500 and caught >= 0.97 * runs


def test_passages_of_odd_tables(docs, none):
    assert substring_dedup.passages(none).count() == 0
    assert substring_dedup.passages(docs).count() > 0


ITEMS = [(1, "w1 w2 w3"), (2, None), (3, "!!"), (4, language(900, 70, 5000)), (4, language(900, 70, 5000)), (5, "ONE"), (None, "same same same"), (6, "never said before " + "zz " * 20)]
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_passages_of_rows_with_null_and_repeated_ids(spark, docs, rows):
    a, b, c, own = language(11000, 70, 5000), language(11001, 70, 5000), language(11002, 70, 5000), [language(11100 + k, 30, 5000) for k in range(9)]
    odd = [(None, f"{own[0]} {a}"), (None, f"{own[1]} {a}"), (7, f"{own[2]} {b}"), (7, f"{b} {own[3]}"), (7, "short"), (8, f"{own[4]} {c} {own[5]}"), (9, f"{c} {own[6]}"), (9, own[7])]
    got = sorted(str(r.text) for r in substring_dedup.without_passages(spark.createDataFrame(odd, "doc_id long, text string")).collect())
    # of each passage one copy stays, and own words stay whole
    for passage in (a, b, c):
        assert sum(passage in text for text in got) == 1 and sum(passage[:40] in text for text in got) == 1
    assert all(sum(words in text for text in got) == 1 for words in own[:8])
    assert substring_dedup.without_passages(docs).count() == len(rows)


def brute_hits(rows, items):
    windows = []
    for item, text in items:
        w = TERM.findall(lower(text))
        windows += [(item, tuple(w[i : i + 10])) for i in range(max(len(w) - 9, min(len(w), 1)))]
    out = []
    for row in rows:
        w = TERM.findall(lower(row[1]))
        hit, found = set(), set()
        for item, p in windows:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    found.add("" if item is None else str(item))
        out.append((row[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_decontamination_matches_brute_force(spark, docs, rows, broadcast_rows, monkeypatch):
    monkeypatch.setattr(sparkkit, "BROADCAST_BYTES", 64 * broadcast_rows)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = Counter(tuple(r)[:6] for r in decontaminate.judged(docs, items).collect())
    assert got == Counter(brute_hits(rows, ITEMS))


def test_decontamination_cleans_and_takes_empty_tables(spark, docs, rows, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert left.count() == sum(not h[-1] for h in brute_hits(rows, ITEMS))
    assert decontaminate.judged(none, items).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == len(rows)
    near = decontaminate.proximity_matches(spark.createDataFrame([(1, "a rare x x b thing"), (2, "a b"), (3, None)], "doc_id long, text string"), spark.createDataFrame([(9, "rare b")], "item_id long, text string"))
    assert [tuple(r) for r in near.collect()] == [(1, 9, 1, 2)]
    # a word that no document has doesn't hide the others
    near = decontaminate.proximity_matches(spark.createDataFrame([(1, "p a rare x b q"), (2, "a q b")], "doc_id long, text string"), spark.createDataFrame([(9, "unknown rare b")], "item_id long, text string"))
    assert [tuple(r) for r in near.collect()] == [(1, 9, 1, 1)]


def test_mixing_takes_what_the_targets_say(spark, docs, rows, none):
    got = mixing.plan(docs).collect()
    assert len(got) == len(rows)
    total = sum(r.size for r in got)
    targets = {r.source: r.target for r in got}
    sizes = {r.source: r.source_size for r in got}
    assert abs(sum(targets.values()) - total) < 1e-6
    assert all(targets[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    copies = {(r.doc_id, r.source): r.copies for r in got}
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy_no"]
    assert sum(r.copies for r in got) == mixed.count() and max(copies.values()) <= 3
    assert mixing.plan(none).count() == 0 and mixing.mix(none).count() == 0


def test_mixing_draws_for_each_text_and_takes_columns_of_any_name(spark):
    rows = [(None if i % 2 else 7, f"text {i} of eleven words a b c d e f", s) for s in ("a", "b", "c") for i in range(4200 if s == "b" else 2400)]
    odd = spark.createDataFrame([(*x, 1, 2, 3, 4, 5) for x in rows], ["doc_id", "text", "source", "_mix_rate", "Copy_No", "a.b", "doc", "rate"])
    plan = mixing.plan(odd)
    for r in plan.groupBy("source").agg({"copies": "sum", "source_size": "max", "target": "max"}).collect():
        rows_of = r["max(source_size)"] / 11
        assert abs(r["sum(copies)"] - r["max(target)"] / 11) <= 4 * (rows_of / 4) ** 0.5  # draws of their own: four deviations at most
    mixed = mixing.mix(odd)
    assert mixed.columns == ["doc_id", "text", "source", "_mix_rate", "a.b", "doc", "rate", "copy_no"]
    assert mixed.count() == plan.agg({"copies": "sum"}).first()[0] and mixed.select("`a.b`").distinct().collect() == [(3,)]


def test_repeated_bytes_tell_texts_without_id_apart(spark):
    d = spark.range(120_000).selectExpr("cast(null AS long) AS doc_id", "concat('text ', id) AS text")
    keyed = repeated_bytes.keyed(d)
    assert keyed.select("doc", "row").distinct().count() == 120_000 and keyed.where("doc < 4611686018427387904").count() == 0


def test_mixing_reaches_its_targets(spark):
    d = spark.createDataFrame([(i, "a b c d e", "abcd"[min(i % 11, 3)]) for i in range(8000)], "doc_id long, text string, source string")
    taken = {}
    for r in mixing.plan(d).collect():
        t = taken.setdefault(r.source, [0, r.target])
        t[0] += r.copies * r.size
    assert all(abs(t - goal) < 0.04 * goal for t, goal in taken.values())


def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_rules_measure_like_brute_force(docs, rows, none):
    got = quality_rules.judged(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((r[0], *brute_measures(r[1])) for r in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    passed = quality_rules.kept(docs)
    assert passed.columns == docs.columns and passed.count() == sum(r.kept for r in got)
    assert quality_rules.judged(none).count() == 0


URLS = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.ORG/es/x?y"), (4, "http://A.Example.ORG/es/x?y"), (5, "https://example.org/en/12#z"), (6, "x://com/fr/"), (7, "x://notcom/fr/"), (8, "x://b.com/de/1"), (9, "x://org"), (10, "x://org/"), (None, "x://q.net/é/1"), (11, "a://b://c.org/")]


def test_url_filter_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in URLS], "page_id long, url string, html string, rule string")
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in (1, 3, 4, 5, 6, 7, 8)] == [("", "", None), ("", "", None), ("a.example.org", "/es/x", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"), ("com", "/fr/", "com/fr/"), ("notcom", "/fr/", None), ("b.com", "/de/1", "com/de/")]
    assert got[9].rule is None and got[10].rule == "org/" and got[11].host == "b:" and got[4].verdict == "block" and got[6].verdict == "allow"
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_url_filter_learns_from_rule_decided_urls(spark):
    rows = [(i, f"http://h{i % 7}.{d}/{i}") for i, d in enumerate(["com/de", "com/fr"] * 300)]
    rows += [(1000 + i, f"http://h{i}.net/{lang}/{i}") for i, lang in enumerate(["de", "fr"] * 20)]
    got = {r.page_id: r.verdict for r in url_filter.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert sum(got[1000 + i] == ("block" if i % 2 == 0 else "allow") for i in range(40)) >= 38


def test_warc_round_trip(spark):
    big = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "http://a.b/c d", big), (2, None, big), (3, "http://x/\r\nEvil: 1", None), (4, "", ""), (5, "http://a.b/", "small"), (6, "http://a.b/", "small"), (7, "http://a.b/", big), (7, "http://a.b/", big), (None, "http://a.b/", big), (None, None, "lone" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages, path)
    blocks, directory = warc.build_index(warc.captures(spark, path))
    wanted = pages.select(warc.header_url(pages.url).alias("url"), "page_id")
    got = Counter(tuple(r)[:5] for r in warc.read_ranges(warc.lookup(wanted, blocks, directory)).collect())
    want = Counter()
    for i, _, html in rows:
        b = (html or "").encode()
        revisit = len(b) >= 1000 and html == big and i != 7
        want[i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None] += 1
    assert got == want
    assert warc.lookup(spark.createDataFrame([("http://none/", 1)], "url string, page_id long"), blocks, directory).count() == 0
    empty = shared_dir(spark, "warc-test")
    warc.write_archives(pages.limit(0), empty)
    assert warc.captures(spark, empty).count() == 0


def test_warc_of_large_pages_and_other_stores(spark, monkeypatch):
    rows = [(i, f"http://a.b/{i}", "x" * (20 << 20) if i == 3 else f"page {i} " * (40_000 if i % 4 == 0 else 30)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages, path, 30 << 20)
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    assert max(f.length for f in files) < 31 << 20 and len(files) > 10
    want = Counter((i, len(html), hashlib.sha1(html.encode()).hexdigest()) for i, _, html in rows)
    blocks, directory = warc.build_index(warc.captures(spark, path))
    found = warc.lookup(pages.select("url", "page_id"), blocks, directory)
    for schemes in (warc.RANGE_SCHEMES, {}):  # the second reads whole files, as from a store that only Spark opens
        monkeypatch.setattr(warc, "RANGE_SCHEMES", schemes)
        assert Counter(tuple(r)[:3] for r in warc.read_ranges(found).collect()) == want


def test_url_keys_sort_hosts_together():
    assert warc.url_key("http://www.Example.org/a?b") == "org,example,www)/a?b"
    assert warc.url_key("") == ""


def text_batch(texts):
    return pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})


def test_training_samples_are_bounded_and_take_one_row_of_an_id(spark, docs):
    labels = labelled(spark, [(i, i % 2, 0) for i in range(101)])
    got = training(docs, labels, "quality", 1000).collect()
    assert len(got) == len({x.doc_id for x in got}) > 20
    few = training(docs, labels, "quality", 1000, 5000).collect()
    assert 0 < sum(len(x.text.encode()) for x in few) <= 5000


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def judged_docs(spark):
    r = random.Random(1)
    rows, labels = [(0, None, "en", "a", 0, ""), (1, "", None, None, 0, "")], [(0, 1, 0), (None, 1, 1), (5, None, None)]
    for i in range(2, 900):
        text, bad, rude = language(i, r.randrange(20, 200), 3000), r.random() < 0.3, r.random() < 0.3
        if bad:
            text = text.replace(" ", "### ")
        if rude:
            at = text.split(" ")
            at[r.randrange(len(at))] = r.choice(["meanie", "dolt"])
            text = " ".join(at)
        rows.append((i, text, "en", "a", len(text), ""))
        labels.append((i, int(not bad), int(rude)))
    return spark.createDataFrame(rows, DOCS), labelled(spark, labels), {i: (q, t) for i, q, t in labels if i}


def test_quality_classifier_on_the_held_out_fold(judged_docs, none):
    docs, labels, truth = judged_docs
    got = quality_classifier.scored(docs, labels).collect()
    assert len(got) == 900 and all(0 <= r.score <= 1 for r in got)
    own = [(r.score >= 0.3) == (truth[r.doc_id][0] == 1) for r in got if r.doc_id in truth and r.doc_id > 5]
    assert sum(own) > 0.97 * len(own)
    kept = quality_classifier.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert quality_classifier.scored(none, labels).count() == 0
    assert {r.score for r in quality_classifier.scored(docs, labels.limit(0)).collect()} == {0.5}


def test_toxicity_on_the_held_out_fold(judged_docs, none, monkeypatch):
    docs, labels, truth = judged_docs
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == 900 and all(0 <= r.score <= 1 for r in got)
    own = [(r.score >= 0.5) == (truth[r.doc_id][1] == 1) for r in got if r.doc_id in truth and r.doc_id > 5]
    assert sum(own) > 0.97 * len(own)
    assert toxicity.scored(none, labels).count() == 0
    model, _ = toxicity.fit(docs, labels)
    odd = [None, "", "w1 w2", "dolt w5", "...", "meanie", language(5, 700) + " dolt", language(6, 300)]
    alone = [float(toxicity.probability(model, *toxicity.word_rows(text_batch([x])))[0]) for x in odd]
    assert alone[0] == alone[1] == alone[4] < 0.5 < alone[3]
    for turn in range(len(odd)):
        order = odd[turn:] + odd[:turn] + odd[::-1]
        together = toxicity.probability(model, *toxicity.word_rows(text_batch(order)))
        assert np.allclose(together, [alone[odd.index(x)] for x in order], atol=1e-6)
    monkeypatch.setattr(toxicity, "BLOCK", 64)  # long texts go block by block
    assert np.allclose(toxicity.probability(model, *toxicity.word_rows(text_batch(odd))), alone, atol=1e-6)
    assert {r.score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}
