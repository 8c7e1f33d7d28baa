"""Conversation structure repair: cost dynamic programming, then prefix-doubling path ranking.

A conversation's rows, by turn, are repaired by the cheapest edits (Keep,
Rerole, Delete, Insert) after which the role initials read `(s?(ua)+)?`; of
equally cheap edits those whose audit string is ASCII-least are taken.

1. Rows become a byte each (initial and first fault) in blocks of one
   conversation, cut from a range partitioning by conversation and turn, so that
   a conversation of any length is spread over tasks.  Texts stay behind: a row
   is known by a 128-bit digest.
2. A state says which roles the repaired part ends with.  A block's summary is
   the least cost from each state at its start to each at its end; from the last
   block to the first these summaries, a few figures a block, give the cost to
   go behind every block.
3. In each block the costs to go of all (row, state) nodes follow, and with
   them the optimal arcs.  Nodes are ranked by the least audits of their optimal
   arcs of 1, 2, 4, ... letters: the rank of a node for twice the length is the
   rank of its pair (own rank, rank of the node that its pointer of that length
   names), and pointers double.  A node's arcs have different letters, so the
   least rank of one letter names its arc.  From a block's entry states the
   pointers, taken from the longest to the shortest, read the least path out.
4. Entry states are chained over a conversation's blocks, a figure for each;
   then every block writes its repaired rows, which find their texts by digest.

Nothing but a conversation's audit, and the hash of its repaired text in the
query, is ever gathered for a whole conversation; both are single values by
contract, and the hash is taken from rows that stream past in order.

Defined results: null roles and texts count as one space, null conversations
are one conversation, null turns come first; rows of one turn go by the MD5 of
role and text, equal rows next to each other; an empty text is blank; roles
without a known initial can only be reroled or deleted; long texts and
conversations are neither cut nor capped; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from llm.sparkkit import stored

#: Characters that don't count as text.
SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
LETTERS = "DIKR"
#: Rows of a block at most, and rows that one numpy pass handles, about.
BLOCK, PASS_ROWS = 2048, 1 << 16
INFINITE = 1 << 50
# States: nothing yet, system, user, assistant.  A fifth stands for "not allowed".
NEVER = 4
#: The state after a row is kept, by its initial (other, s, u, a) and the state before.
KEPT = np.array([[4, 4, 4, 4], [1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4]])
#: The state after a rerole or an insert: user, or after a user assistant.
NEXT = np.array([2, 2, 3, 2])
#: Cost and edits from each state behind the last row.
END_COST, END_EDITS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
END_STATES = ("", "12", "2", "")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): a twentieth each of the rows dropped, emptied, without full stops, repeated, and given to the user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    d = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("h")).where("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("n")).drop("n")


def digested(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of rows, and `key`: a digest of conversation, role and text."""
    d = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return d.withColumn("key", F.unhex(F.md5(named.cast("binary"))))


def marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, key, id, code): a row's initial and, times four, its first fault."""
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    first = F.left("role", F.lit(1))
    initial = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    d = stored(digested(rows).select("conv_id", "turn", "key", F.monotonically_increasing_id().alias("id"), initial.alias("initial"), fault.alias("fault")), "repair-rows")
    firsts = d.groupBy("key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "id")).alias("f")).select(F.col("f.id").alias("id"), F.lit(True).alias("first"))
    fault = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    return d.join(firsts, "id", "left").select("conv_id", "turn", "key", "id", (F.col("initial") + 4 * fault).cast("int").alias("code"))


def step(cost: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Costs to go (..., rows, 4) before rows of these codes, from those behind them."""
    late = np.where(code >> 2 == TRUNCATED, CUT_OFF, 0)[:, None]
    must = np.where((code >> 2 == BLANK) | (code >> 2 == DUPLICATE), INFINITE, 0)[:, None]
    padded = np.concatenate([cost, np.full((*cost.shape[:-1], 1), INFINITE)], axis=-1)
    keep = np.take_along_axis(padded, np.broadcast_to(KEPT[code & 3], cost.shape), axis=-1) + late + must
    base = np.minimum(np.minimum(cost + DELETE, keep), cost[..., NEXT] + REROLE + late + must)
    inserted = np.minimum(base[..., NEXT] + INSERT, base[..., NEXT[NEXT]] + 2 * INSERT)
    return np.minimum(np.minimum(base, inserted), INFINITE)


def costs(code: np.ndarray, bounds: np.ndarray, final: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    """Costs to go (..., blocks, 4) at the start of the blocks [bounds[i], bounds[i+1]) from those behind them; `keep` (rows, 4) gets all."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    now, last = final[..., order, :].copy(), bounds[1:][order] - 1
    active = np.searchsorted(-size[order], -np.arange(1, size.max(initial=0) + 1), side="right")
    for j, k in enumerate(active.tolist()):
        row = last[:k] - j
        now[..., :k, :] = step(now[..., :k, :], code[row])
        if keep is not None:
            keep[row] = now[:k]
    out = np.empty_like(now)
    out[..., order, :] = now
    return out


def least_paths(code: np.ndarray, bounds: np.ndarray, final: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each entry (block, state): the letters and states of its least audit through the block, their bounds, and the state behind it.

    `final` are the costs to go behind each block.
    """
    n, blocks = len(code), len(bounds) - 1
    cost = np.empty((n, 4), np.int64)
    costs(code, bounds, final, cost)
    cost = np.concatenate([cost.ravel(), final.ravel()])
    # nodes: 4 * row + state, then 4 * n + 4 * block + state behind the blocks
    behind = 4 * np.arange(1, n + 1)
    behind[bounds[1:] - 1] = 4 * (n + np.arange(blocks))
    state = np.arange(4)
    late = np.where(code >> 2 == TRUNCATED, CUT_OFF, 0)[:, None]
    free = ~((code >> 2 == BLANK) | (code >> 2 == DUPLICATE))[:, None]
    kept = KEPT[code & 3]
    own = 4 * np.arange(n)[:, None]
    arcs = (
        (behind[:, None] + state, DELETE, True),
        (own + NEXT, INSERT, True),
        (behind[:, None] + np.minimum(kept, 3), late, free & (kept != NEVER)),
        (behind[:, None] + NEXT, REROLE + late, free),
    )
    here = cost[: 4 * n].reshape(n, 4)
    rank, pointer = np.zeros(4 * (n + blocks), np.int64), np.arange(4 * (n + blocks))
    first_rank, first_pointer = rank[: 4 * n].reshape(n, 4), pointer[: 4 * n].reshape(n, 4)
    for letter, (to, price, may) in enumerate(arcs, 1):
        least = (cost[to] + price == here) & may & (first_rank == 0)
        first_rank[least], first_pointer[least] = letter, to[least]
    letters, pointers = rank.copy(), [pointer]
    while (pointers[-1] < 4 * n).any():  # ranks by audits of 1, 2, 4, ... letters
        reached = pointers[-1]
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[reached], return_inverse=True)[1]
        pointers.append(reached[reached])
    start = 4 * bounds[entries[:, 0]] + entries[:, 1]
    path, of = start, np.arange(len(entries))
    for jump in reversed(pointers[:-1]):
        path, of = np.stack([path, jump[path]], axis=1).ravel(), np.repeat(of, 2)
        inside = path < 4 * n
        path, of = path[inside], of[inside]
    return letters[path] - 1, path % 4, np.searchsorted(of, np.arange(len(entries) + 1)), pointers[-1][start] % 4


def runs_of(column: pa.Array) -> np.ndarray:
    """Where a value (nulls are one) differs from the one before, and the ends."""
    n = len(column)
    if n < 2:
        return np.array([0, n])
    a, b = column.slice(1), column.slice(0, n - 1)
    changed = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(pc.is_null(a), pc.is_null(b)))
    return np.concatenate([[0], np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1, [n]])


FIGURES = ("n", "blank", "duplicate", "truncated", "illegal", "first", "last", "turns")
LEGAL = np.zeros(16, bool)
LEGAL[[4 * 1 + 2, 4 * 2 + 3, 4 * 3 + 2]] = True


def blocks_of(table: pa.Table, bounds: np.ndarray, part: int, seq: int) -> pa.RecordBatch:
    """A row for each block of the sorted rows: its figures, its summary of costs, its codes and keys."""
    code = table.column("code").to_numpy().astype(np.int64)
    starts, size = bounds[:-1], np.diff(bounds)
    total = lambda x: np.add.reduceat(x.astype(np.int64), starts)
    inner = np.ones(len(code), bool)
    inner[starts] = False  # rows with one before them in their block
    initial = code & 3
    before = np.concatenate([[0], initial[:-1]])
    turn = table.column("turn").combine_chunks()
    some = turn.is_valid().to_numpy(zero_copy_only=False)
    t = turn.fill_null(0).to_numpy()
    new = some & ~(inner & np.concatenate([[False], some[:-1]]) & (t == np.concatenate([t[:1], t[:-1]])))
    n_some, at = total(some), bounds[1:] - 1
    final = np.full((4, len(starts), 4), INFINITE)
    final[np.arange(4), :, np.arange(4)] = 0
    summary = costs(code, bounds, final).transpose(1, 2, 0).reshape(len(starts), 16)  # from state, to state
    keys = table.column("key").combine_chunks()
    flat = np.frombuffer(b"".join(keys.to_pylist()), np.uint8).reshape(len(code), 16)
    figures = (size, total(code >> 2 == BLANK), total(code >> 2 == DUPLICATE), total(code >> 2 == TRUNCATED), total(inner & ~LEGAL[4 * before + initial]), initial[starts], initial[at], total(new))
    known = pa.array(n_some == 0)
    return pa.RecordBatch.from_arrays(
        [
            table.column("conv_id").combine_chunks().take(pa.array(starts)), pa.array(np.full(len(starts), part, np.int32)), pa.array(np.arange(seq, seq + len(starts))), *(pa.array(x.astype(np.int64)) for x in figures),
            pc.if_else(known, None, pa.array(t[np.minimum(at, bounds[1:] - n_some)])), pc.if_else(known, None, pa.array(t[at])),
            pa.array(list(summary)), pa.array([code[a:b].astype(np.uint8).tobytes() for a, b in zip(starts, bounds[1:], strict=True)], pa.binary()), pa.array([flat[a:b].tobytes() for a, b in zip(starts, bounds[1:], strict=True)], pa.binary()),
        ],
        ["conv_id", "part", "seq", *FIGURES, "least_turn", "most_turn", "summary", "codes", "keys"],
    )


def blocks(rows: DataFrame) -> DataFrame:
    """The rows of `marked` in blocks of one conversation each, numbered in order by (part, seq)."""
    order = [F.col("conv_id"), F.col("turn"), F.col("key"), F.col("id")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            bounds = runs_of(table.column("conv_id").combine_chunks())
            last = bounds[-2] + (bounds[-1] - bounds[-2] - 1) // BLOCK * BLOCK  # the last conversation may go on
            if last:
                yield from some(table.slice(0, last), bounds[bounds <= last], part, seq)
                seq += last
            held = table.slice(last)
        if held is not None:
            yield from some(held, np.array([0, held.num_rows]), part, seq)

    def some(table: pa.Table, bounds: np.ndarray, part: int, seq: int) -> Iterator[pa.RecordBatch]:
        bounds = np.unique(np.concatenate([bounds, [table.num_rows], *(np.arange(a, b, BLOCK) for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b - a > BLOCK), *([np.arange(bounds[-1], table.num_rows, BLOCK)] if bounds[-1] < table.num_rows else [])]))
        yield blocks_of(table, bounds, part, seq)

    d = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("id")
    kind = d.schema["conv_id"].dataType.simpleString()
    turn = d.schema["turn"].dataType.simpleString()
    return d.mapInArrow(cut, f"conv_id {kind}, part int, seq long, {', '.join(f'{f} long' for f in FIGURES)}, least_turn {turn}, most_turn {turn}, summary array<long>, codes binary, keys binary")


def in_order(d: DataFrame, *order: Column) -> DataFrame:
    return d.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def costs_behind(table: DataFrame) -> DataFrame:
    """(part, seq, opens, closes, behind, total): whether the block is its conversation's first or last, the costs to go behind it, and at a first one the whole cost."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv, now = None, None, list(END_COST)
        for batch in batches:
            out = []
            for c, part, seq, m in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "part", "seq", "summary")), strict=True):
                again = held is not None and c == conv
                if held is not None:
                    out.append((*held, not again, None if again else now[0]))
                if not again:
                    now = list(END_COST)
                held, conv = (part, seq, not again, now), c
                now = [min(m[4 * s + e] + now[e] for e in range(4)) for s in range(4)]
            yield rows(out)
        if held is not None:
            yield rows([(*held, True, now[0])])

    def rows(out: list) -> pa.RecordBatch:
        part, seq, closes, behind, opens, total = zip(*out, strict=True) if out else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(seq, pa.int64()), pa.array(opens, pa.bool_()), pa.array(closes, pa.bool_()), pa.array(behind, pa.list_(pa.int64())), pa.array(total, pa.int64())], ["part", "seq", "opens", "closes", "behind", "total"])

    d = in_order(table.select("conv_id", "part", "seq", "summary"), F.desc("part"), F.desc("seq"))
    return d.mapInArrow(back, "part int, seq long, opens boolean, closes boolean, behind array<long>, total long")


def audited(table: DataFrame) -> DataFrame:
    """Blocks with their costs behind them, and for each entry state (only the first where a block opens) `letters`, `states` and `exits`."""
    drop = ("codes", "behind")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(batch.column("n").to_numpy()) // PASS_ROWS
            edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                yield one(batch.slice(a, b - a))

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        code = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(part.column("n").to_numpy())])
        final = np.array(part.column("behind").to_pylist(), np.int64)
        opens, closes = part.column("opens").to_pylist(), part.column("closes").to_pylist()
        entries = np.array([(i, s) for i, first in enumerate(opens) for s in range(1 if first else 4)])
        letter, state, at, exits = least_paths(code, bounds, final, entries)
        letter, state = np.frombuffer(LETTERS.encode(), np.uint8)[letter].tobytes().decode(), (state + 48).astype(np.uint8).tobytes().decode()
        out = [([], [], []) for _ in opens]
        for (i, _), a, b, e in zip(entries.tolist(), at[:-1].tolist(), at[1:].tolist(), exits.tolist(), strict=True):
            x, y, z = out[i]
            x.append(letter[a:b] + END_EDITS[e] * closes[i])
            y.append(state[a:b] + END_STATES[e] * closes[i])
            z.append(e)
        columns = [*(part.column(k) for k in names), *(pa.array([o[k] for o in out], t) for k, t in enumerate((pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()))))]
        return pa.RecordBatch.from_arrays(columns, [*names, "letters", "states", "exits"])

    names = [c for c in table.columns if c not in drop]
    fields = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in names)
    return table.mapInArrow(walk, f"{fields}, letters array<string>, states array<string>, exits array<int>")


def chained(table: DataFrame) -> DataFrame:
    """(conv_id, part, seq, letters, states, keys, before, and figures): each block's own audit, the repaired rows before it, and its figures with what lies between blocks."""
    summed = ("n", "blank", "duplicate", "truncated", "illegal", "turns")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, before, last, turn = 0, 0, 0, None
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                entry = state if not r["opens"] else 0
                if r["opens"]:
                    before, turn = 0, None
                else:
                    r["illegal"] += not LEGAL[4 * last + r["first"]]
                    r["turns"] -= turn is not None and turn == r["least_turn"]
                r["before"] = before
                r["letters"], r["states"], state = r["letters"][entry], r["states"][entry], r["exits"][entry]
                before += len(r["letters"]) - r["letters"].count("D")
                last, turn = r["last"], r["most_turn"] if r["most_turn"] is not None else turn
            yield pa.RecordBatch.from_pylist(rows, schema)

    d = in_order(table, F.col("part"), F.col("seq"))
    names = ("conv_id", "part", "seq", *summed, "least_turn", "most_turn", "total", "keys")
    fields = [f"`{c}` {table.schema[c].dataType.simpleString()}" for c in names]
    shape = StructType.fromDDL(", ".join([*fields, "letters string", "states string", "before long"]))
    schema = to_arrow_schema(shape)
    return d.mapInArrow(follow, shape)


def edits(chain: DataFrame) -> DataFrame:
    """(conv_id, position, key, role, edit) of every repaired row; key is null where it is inserted, role where it is the row's own."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(x) for x in batch.column("letters").to_pylist()], np.int64)
            letter = np.frombuffer("".join(batch.column("letters").to_pylist()).encode(), np.uint8)
            state = np.frombuffer("".join(batch.column("states").to_pylist()).encode(), np.uint8) - 48
            key = np.frombuffer(b"".join(batch.column("keys").to_pylist()), "V16")
            block = np.repeat(np.arange(len(size)), size)
            out, inserted = letter != ord("D"), letter == ord("I")
            row = np.cumsum(~inserted) - 1
            place = np.cumsum(out)
            start = np.concatenate([[0], place])[np.concatenate([[0], np.cumsum(size)])[:-1]]
            position = batch.column("before").to_numpy()[block] + place - start[block]
            new = np.where(letter == ord("K"), 0, np.where(NEXT[state] == 2, 1, 2))[out]
            own = [None if i else key[k].tobytes() for k, i in zip(row[out].tolist(), inserted[out].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(block[out])), pa.array(position[out]), pa.array(own, pa.binary()), pa.array([None, "user", "assistant"], pa.string()).take(pa.array(new)), pa.array([chr(x) for x in letter[out].tolist()], pa.string())], ["conv_id", "position", "key", "role", "edit"])

    kind = chain.schema["conv_id"].dataType.simpleString()
    return chain.select("conv_id", "letters", "states", "keys", "before").mapInArrow(spread, f"conv_id {kind}, position long, key binary, role string, edit string")


def chain_of(rows: DataFrame) -> DataFrame:
    """The stored blocks of rows (conv_id, turn, role, text) with their least audits."""
    table = stored(blocks(marked(rows)), "repair-blocks")
    return stored(chained(audited(table.join(costs_behind(table), ["part", "seq"]))), "repair-chain")


def repaired(rows: DataFrame, chain: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit): the repaired conversations, positions from 1."""
    e = edits(chain)
    texts = digested(rows).groupBy("key").agg(F.first("role").alias("own"), F.first("text").alias("text"))
    kept = e.where("key IS NOT NULL").join(texts, "key").select("conv_id", "position", F.coalesce("role", "own").alias("role"), "text", "edit")
    return kept.union(e.where("key IS NULL").select("conv_id", "position", "role", F.lit("").alias("text"), "edit"))


def reported(chain: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation with rows."""
    figures = [F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated", "illegal")]
    gaps = F.coalesce(F.max("most_turn") - F.min("least_turn") + 1 - F.sum("turns"), F.lit(0)).cast("long")
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "seq", "letters"))), lambda x: x["letters"]), "")
    return chain.groupBy("conv_id").agg(gaps.alias("gaps"), *figures, F.max("total").alias("cost"), audit.alias("audit"))


def hashed(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of repaired rows, hashed as they stream past in order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, h = None, None
        for batch in batches:
            ids, out = batch.column("conv_id").to_pylist(), []
            for c, role, text in zip(ids, batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if h is None or c != conv:
                    if h is not None:
                        out.append((conv, h.hexdigest()))
                    conv, h = c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], batch.schema.field("conv_id").type), pa.array([x for _, x in out], pa.string())], ["conv_id", "repaired_sha256"])
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.field("conv_id").type), pa.array([h.hexdigest()])], ["conv_id", "repaired_sha256"])

    d = in_order(rows.select("conv_id", "position", "role", "text"), F.col("position"))
    return d.mapInArrow(digest, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """A row for each conversation of the table: its faults after damage, the cost and audit of its repair, and the repaired text's hash."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = damaged(conversations)
    chain = chain_of(rows)
    report, hashes = reported(chain).alias("r"), hashed(repaired(rows, chain)).alias("h")
    every = conversations.select("conv_id").distinct().alias("e")
    joined = every.join(report, F.col("e.conv_id").eqNullSafe(F.col("r.conv_id")), "left").join(hashes, F.col("e.conv_id").eqNullSafe(F.col("h.conv_id")), "left")
    zero = [F.coalesce(f"r.{k}", F.lit(0)).cast("long").alias(k) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select("e.conv_id", *zero, F.coalesce("r.audit", F.lit("")).alias("audit"), F.coalesce("h.repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def _sql() -> str:
    """The same by recursion from a conversation's last row to its first, which keeps whole audits and texts for each state."""
    crc = "xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, j: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"
    arc = lambda price, letter, text, to: f"{{'c': {price} + {to}.c, 'a': '{letter}' || {to}.a, 't': {text} || {to}.t}}"
    role = lambda s: "'assistant:' || chr(10)" if s == 2 else "'user:' || chr(10)"
    base = []
    for s in range(4):
        kept = " ".join(f"WHEN first = '{x}' THEN {arc('late', 'K', 'line', f'v[{KEPT[i][s] + 1}]')}" for i, x in enumerate("?sua") if KEPT[i][s] != NEVER)
        rerole = arc("3 + late", "R", f"'{'assistant' if s == 2 else 'user'}:' || text || chr(10)", f"v[{NEXT[s] + 1}]")
        base.append(f"list_min([{arc(4, 'D', chr(39) * 2, f'v[{s + 1}]')}, CASE WHEN must THEN NULL {kept} END, CASE WHEN NOT must THEN {rerole} END])")
    once = lambda s: arc(3, "I", role(s), f"b[{NEXT[s] + 1}]")
    twice = lambda s: arc(6, "II", f"{role(s)} || {role(NEXT[s])}", f"b[{NEXT[NEXT[s]] + 1}]")
    closed = ", ".join(f"list_min([b[{s + 1}], {once(s)}, {twice(s)}])" for s in range(4))
    end = ", ".join(f"{{'c': {END_COST[s]}::BIGINT, 'a': '{END_EDITS[s]}', 't': {t}}}" for s, t in enumerate(("''", f"{role(0)} || {role(2)}", role(2), "''")))
    return rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
h AS (SELECT *, {crc} % 20 AS h FROM k),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy FROM h, (VALUES (1), (2)) AS c(copy) WHERE h <> 0 AND (copy = 1 OR h = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(conv_id::VARCHAR, ' ') || ':' || length(role) || ':' || role || text), copy) AS i FROM d),
f AS (SELECT *, left(role, 1) AS first, role || ':' || text || chr(10) AS line, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
      lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM o),
g AS (SELECT *, blank OR again AS must, CASE WHEN cut AND NOT blank AND NOT again THEN 3 ELSE 0 END AS late FROM f),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (late > 0) AS truncated,
      count(*) FILTER (i > 1 AND prev || first NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
r AS (SELECT conv_id, n + 1 AS i, [{end}] AS v FROM n
      UNION ALL
      SELECT conv_id, i, [{closed}] FROM (SELECT g.conv_id, g.i, [{', '.join(base)}] AS b FROM r JOIN g ON g.conv_id IS NOT DISTINCT FROM r.conv_id AND g.i = r.i - 1))
SELECT e.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank, coalesce(n.duplicate, 0)::BIGINT AS duplicate, coalesce(n.truncated, 0)::BIGINT AS truncated, coalesce(n.illegal, 0)::BIGINT AS illegal,
       coalesce(r.v[1].c, 0)::BIGINT AS cost, coalesce(r.v[1].a, '') AS audit, sha256(coalesce(left(r.v[1].t, length(r.v[1].t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = 1
"""


OP13_SQL = _sql()
