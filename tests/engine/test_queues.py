"""Queue links and merges against taking all pairs one after the other."""

import math
import random

import numpy as np
import pytest

from clipflow.operators import arrow, queues

RULES = queues.Queue()


def one_by_one(rows, rules):
    """rows (clip, direction, way, id, movement, t_us, x, y, inside, dynamic, isolated): {(clip, id): target} of merged fragments."""
    median = lambda v: (sorted(v)[(len(v) - 1) // 2] + sorted(v)[len(v) // 2]) / 2
    parts, out = {}, {}
    for r in rows:
        parts.setdefault((r[0], r[1], r[3]), []).append(r)
    groups = {}
    for (clip, direction, i), all_rows in parts.items():
        own = sorted((r for r in all_rows if not r[10]), key=lambda r: r[5:9])
        if own:
            way = own[0][2]
            u = lambda x, y: x * math.cos(way) + y * math.sin(way)  # noqa: B023, E731
            x, y = median([r[6] for r in own]), median([r[7] for r in own])
            f, l = own[0], own[-1]
            groups.setdefault((clip, direction), []).append(
                dict(id=i, m=f[4], u=u(x, y), v=x * math.sin(way) - y * math.cos(way), n=len(own), dyn=any(r[9] for r in own), alone=len(own) < len(all_rows), t0=f[5], t1=l[5], u0=u(f[6], f[7]), u1=u(l[6], l[7]), in0=f[8], in1=l[8])
            )

    def runs(items, key, apart):
        done = []
        for p in sorted(items, key=lambda p: (*[p[k] for k in key], p["id"])):
            if done and p[key[0]] - done[-1][-1][key[0]] <= apart:
                done[-1].append(p)
            else:
                done.append([p])
        return done

    def fits(a, b):
        near, pair = abs(a["v"] - b["v"]) <= rules.lane_change, {a["m"], b["m"]}
        if not a["m"] or not b["m"] or a["m"] == b["m"]:
            return near or "right" not in pair
        if pair == {"left", "right"}:
            return False
        by = {a["m"]: a["v"], b["m"]: b["v"]}
        return near and (by["left"] <= by["straight"] if "left" in pair else by["right"] >= by["straight"])

    for (clip, _), items in groups.items():
        for lane in runs(items, ("v",), rules.lane):
            for queue in runs(lane, ("u", "v"), rules.gap):
                sets = {p["id"]: [p] for p in queue}
                for i, p in enumerate(queue):
                    for q in queue[i + 1 :]:
                        a, b = (p, q) if p["t1"] < q["t0"] else (q, p)
                        if a["t1"] >= b["t0"] or abs(a["v"] - b["v"]) > rules.aside or b["u0"] + rules.back < a["u1"] or not (a["in1"] or b["in0"]) or not fits(a, b):
                            continue
                        low, high = min(a["u1"], b["u0"]) - rules.around, max(a["u1"], b["u0"]) + rules.around
                        if any(a["t1"] < c["t0"] and c["t1"] < b["t0"] and low <= c["u"] <= high for c in queue):
                            continue
                        s, t = sets[a["id"]], sets[b["id"]]
                        if s is not t and not any(k["t0"] <= m["t1"] and m["t0"] <= k["t1"] for k in s for m in t):
                            s += t
                            for k in t:
                                sets[k["id"]] = s
                for s in {id(s): s for s in sets.values()}.values():
                    able = [(-k["n"], k["id"]) for k in s if not k["alone"]]
                    if len(s) > 1 and able and any(k["dyn"] for k in s):
                        out |= {(clip, k["id"]): min(able)[1] for k in s}
    return out


SCHEMA = "clip int, direction int, way double, id long, movement string, t_us long, x double, y double, inside boolean, dynamic boolean, isolated boolean"


@pytest.mark.parametrize("seed", [1, 2])
def test_stitched_equals_one_by_one(spark, seed):
    r, rows = random.Random(seed), []
    for clip in range(3):
        for i in range(60):
            direction, begin = i % 2, r.randrange(40)
            movement = r.choice([None, "", "left", "straight", "straight", "right"])
            lane, u = r.choice([0.0, 2.0, 9.0]), r.uniform(0, 60)
            for t in range(begin, begin + r.randrange(1, 8)):
                along, aside = u + 0.1 * (t - begin), lane + r.uniform(-0.3, 0.3)
                way = direction * 0.9
                x, y = along * math.cos(way) + aside * math.sin(way), along * math.sin(way) - aside * math.cos(way)
                rows.append((clip, direction, way, i, movement, t, x, y, r.random() < 0.8, r.random() < 0.3, r.random() < 0.03))
    parts = queues.fragments(spark.createDataFrame(rows, SCHEMA), ("clip",))
    got = {(x.clip, x.id): x.target for x in queues.stitched(parts, ("clip",), RULES).collect()}
    want = one_by_one(rows, RULES)
    assert got == want and len(set(want.values())) > 10


def test_a_third_vehicle_blocks_and_rows_without_place_count_for_nothing(spark):
    def row(i, t, x, **more):
        r = dict(clip=0, direction=0, way=0.0, id=i, movement=None, t_us=t, x=x, y=0.0, inside=True, dynamic=True, isolated=False) | more
        return tuple(r.values())

    free = [row(1, 0, 0.0), row(2, 10, 1.0), row(3, 5, None), row(4, 6, 0.5, direction=None)]
    blocked = [row(1, 0, 0.0, clip=1), row(2, 10, 1.0, clip=1), row(3, 5, 0.5, clip=1, y=-3.0)]
    parts = queues.fragments(spark.createDataFrame(free + blocked, SCHEMA), ("clip",))
    assert {(x.clip, x.id): x.target for x in queues.stitched(parts, ("clip",)).collect()} == {(0, 1): 1, (0, 2): 1}
    assert queues.stitched(parts.where("false"), ("clip",)).count() == 0


@pytest.mark.parametrize("first", [1, 32])
def test_links_of_a_queue_against_all_thirds(monkeypatch, first):
    r, n, c = np.random.default_rng(first), 150, RULES
    monkeypatch.setattr(queues, "FIRST", first)
    parts = arrow.parts
    monkeypatch.setattr(arrow, "parts", lambda sizes: parts(sizes, 500))
    q = {"u": r.uniform(0, 40, n), "v": r.uniform(0, 6, n), "t0": r.integers(0, 60, n), "in0": r.random(n) < 0.7, "in1": r.random(n) < 0.7, "movement": r.choice(np.array(["", "left", "straight", "right", "u"], object), n)}
    q |= {"t1": q["t0"] + r.integers(0, 6, n), "u0": q["u"] + r.uniform(-1, 1, n), "u1": q["u"] + r.uniform(-1, 1, n)}

    def fits(i, j):
        m, k, near = q["movement"][i], q["movement"][j], abs(q["v"][i] - q["v"][j]) <= c.lane_change
        by = {m: q["v"][i], k: q["v"][j]}
        if m == k or "" in (m, k):
            return near or "right" not in (m, k)
        if {m, k} == {"left", "straight"}:
            return near and by["left"] <= by["straight"]
        if {m, k} == {"right", "straight"}:
            return near and by["right"] >= by["straight"]
        return {m, k} != {"left", "right"}

    want = set()
    for i in range(n):
        for j in range(n):
            if q["t1"][i] < q["t0"][j] and abs(q["v"][i] - q["v"][j]) <= c.aside and q["u0"][j] + c.back >= q["u1"][i] and (q["in1"][i] or q["in0"][j]) and fits(i, j):
                low, high = min(q["u1"][i], q["u0"][j]) - c.around, max(q["u1"][i], q["u0"][j]) + c.around
                if not ((q["t0"] > q["t1"][i]) & (q["t1"] < q["t0"][j]) & (q["u"] >= low) & (q["u"] <= high)).any():
                    want.add((i, j))
    a, b = queues._linked(q, c)
    assert len(a) == len(want) > 50 and set(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_pairs_are_no_rows_and_no_rounds_are_run(spark):
    from clipflow.plans.queues import queue_links, queue_stitched

    before = spark.sparkContext._jsc.sc().statusStore().jobsList(None).size()
    for query in (queue_links, queue_stitched):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
    # reading a file's schema is a job, merging in rounds would be many
    assert spark.sparkContext._jsc.sc().statusStore().jobsList(None).size() - before <= 2


def test_fragments_of_no_clip_link_with_none(spark):
    rows = [(k, 0, 0.0, i, None, t, x, 0.0, True, True, False) for k in (None, 1) for i, t, x in ((1, 0, 0.0), (2, 10, 1.0))]
    parts = queues.fragments(spark.createDataFrame(rows, SCHEMA), ("clip",))
    assert {(x.clip, x.id): x.target for x in queues.stitched(parts, ("clip",)).collect()} == {(1, 1): 1, (1, 2): 1}
    assert [(x.a, x.b, x.first, x.second) for x in queues.links(queues.queued(parts, ("clip",)), ("clip",)).collect()] == [(1, 2, 1, 2)]
