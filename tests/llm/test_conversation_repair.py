"""Repairs against the definition: all least suffixes by plain recursion, in blocks of any size."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import conversation_repair as repair

SPACES = " \t\n\x0b\x0c\r"


def turn_order(t):
    return (t is not None, t or 0)


def by_definition(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)} of undamaged (conv, turn, role, text)."""
    out, kept = {c: [] for c, *_ in rows}, {}
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else "".join(x for x in text if x not in ".!?") if h == 2 else text
        role = "user" if h == 4 else role
        out[c] += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    for c, some in out.items():
        some.sort(key=lambda r: (turn_order(r[0]), hashlib.md5(f"{' ' if c is None else c}:{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        kept[c] = repaired(some)
    return kept


def repaired(rows):
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(SPACES)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    new = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    best = {s: (0, "", ()) if s in (0, 3) else None for s in range(4)}

    def inserted(base):
        now = dict(base)
        for _ in range(4):
            for s, (role, to) in new.items():
                if now[to] is not None:
                    c, a, t = now[to]
                    option = (c + 3, "I" + a, ((role, ""), *t))
                    now[s] = option if now[s] is None else min(now[s], option)
        return now

    best = inserted(best)
    for (_, role, text), fault in zip(rows[::-1], faults[::-1], strict=True):
        late, now = 3 * (fault == "truncated"), {}
        for s in range(4):
            c, a, t = best[s]
            options = [(c + 4, "D" + a, t)]
            if fault not in ("blank", "duplicate"):
                if role[:1] in after[s]:
                    c, a, t = best[after[s][role[:1]]]
                    options.append((c + late, "K" + a, ((role, text), *t)))
                c, a, t = best[new[s][1]]
                options.append((c + 3 + late, "R" + a, ((new[s][0], text), *t)))
            now[s] = min(options)
        best = inserted(now)
    cost, audit, text = best[0]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in text).encode()).hexdigest()
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest)


def table(seed):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", None, "sam"]
    texts = ["Yes.", "No!", "Ok?  \n", "cut off", "", None, " \t\n\x0b", "é…", "a ", "Done. ", "Long. " * 50]
    rows = []
    for c in [None, *range(60)]:
        n = 90 if c in (7, None) else r.randrange(1, 9)
        for t in range(n):
            text = r.choice(texts) if r.random() < 0.5 else f"Text {r.randrange(10**6)}{r.choice(['.', '!', ''])}"
            role = ["user", "assistant"][t % 2] if r.random() < 0.6 else r.choice(roles)
            rows.append((c, None if r.random() < 0.05 else t + (r.random() < 0.1), role, text))
    rows += [(100, None, "user", "Hi."), (100, None, None, None), (101, 4, "assistant", "x" * 300_000), (102, 0, "a", "."), *[(103, 5, "user", "Same.")] * 40, *[(104, i, "user", f"{i}.") for i in range(70)]]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 2048])
def test_repairs_by_definition(spark, monkeypatch, tmp_path, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "PASS_ROWS", 30 if block == 4 else 1 << 16)
    rows = table(block)
    spark.createDataFrame([(*x, "clash", "clash") for x in rows], "conv_id long, turn long, role string, text string, key string, id string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == by_definition(rows)


def test_repaired_rows_alternate(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C."), (2, 0, "assistant", "D."), (3, 0, "user", "")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(tuple(r) for r in repair.repaired(d, repair.chain_of(d)).collect())
    assert got == [(1, 1, "user", "A.", "K"), (1, 2, "assistant", "", "I"), (1, 3, "user", "B.", "K"), (1, 4, "assistant", "C.", "K"), (2, 1, "user", "", "I"), (2, 2, "assistant", "D.", "K")]
    none = d.limit(0)
    assert repair.chain_of(none).count() == 0 and repair.repaired(none, repair.chain_of(none)).count() == 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert repair.op13_conversation_repair(spark, str(tmp_path)).count() == 0


def test_summaries_of_blocks_multiply_to_the_whole():
    code = np.random.default_rng(3).integers(0, 16, 40)
    final = np.array([repair.END_COST])
    whole = repair.costs(code, np.array([0, 40]), final)
    part = repair.costs(code, np.array([0, 15]), repair.costs(code, np.array([15, 40]), final))
    assert (whole == part).all()


def test_sql_says_the_same(spark, tmp_path):
    import duckdb

    rows = [x for x in table(9) if len(x[3] or "") < 1000]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = repair.op13_conversation_repair(spark, str(tmp_path)).orderBy(F.col("conv_id").asc_nulls_first()).collect()
    want = con.sql(f"SELECT * FROM ({repair.OP13_SQL}) ORDER BY conv_id NULLS FIRST").fetchall()
    assert [tuple(r) for r in got] == want
