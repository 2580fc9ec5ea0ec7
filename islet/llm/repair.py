"""Conversation structure repair: which turns to keep, rerole, delete or insert, by dynamic programming over the turns that stay."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from islet.llm.common import enter, keep

#: What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: A row's first fault.
FINE, BLANK, DUPLICATE, CUT = range(4)
SPACES = "\t\n\x0b\f\r "
#: Where a repaired conversation can stand: nothing yet, behind the system turn, behind a user's, behind an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
PLACE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Turns to insert between a place and the role that follows; other pairs can't follow each other.
GAPS = {(START, SYSTEM): 0, (START, USER): 0, (START, ASSISTANT): 1, (SYSTEM, USER): 0, (SYSTEM, ASSISTANT): 1, (USER, ASSISTANT): 0, (USER, USER): 1, (ASSISTANT, USER): 0, (ASSISTANT, ASSISTANT): 1}
#: Turns to insert behind the last.
CLOSING = [0, 2, 1, 0]
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60
#: A block of a conversation's rows ends at so many rows or characters.
BLOCK_ROWS, BLOCK_CHARS = 256, 1 << 14


def _options(role: str, fault: int) -> list[tuple[str, int, int]]:
    """(edit, role it ends as, cost) of the ways in which a row can stay, by the order of their letters."""
    if fault in (BLANK, DUPLICATE):
        return []
    more, mine = TRUNCATED if fault == CUT else 0, PLACE.get(role[:1])
    kept = [("K", mine, more)] if mine else []
    return kept + [("R", r, REROLE + more) for r in NAMES if r != mine]


def _backward(rows: list[tuple[str, int, int]], end: list[int]) -> tuple[list[int], list[list]]:
    """The least costs from each place before (role, fault, copies) rows, given those behind them, and each row's best step by place.

    Costs are held less the prefix sum of deletions: then a gap of deleted turns costs nothing more, and one running minimum a
    place prices every gap. Of equal costs the audit whose letters come first wins: deleting (D) before inserting (I) before
    keeping (K) before reroling (R). The first letter that differs decides, and at one place no two steps begin alike.
    """
    gone, low, steps = 0, list(end), []
    for role, fault, copies in reversed(rows):
        gone += DELETE * (copies - 1)  # later copies are duplicates
        options, now, took = _options(role, fault), list(low), [None] * 4
        for p in range(4):
            best = None
            for edit, to, cost in options:
                gap = GAPS.get((p, to))
                if gap is not None:
                    key = (cost + INSERT * gap - DELETE + low[to], "I" * gap + edit, to)
                    best = min(best, key) if best else key
            if best and best[0] < low[p]:
                now[p], took[p] = best[0], best[1:]
        gone += DELETE
        low = now
        steps.append(took)
    return [x + gone for x in low], steps[::-1]


def _damage_key(conv_id: str, turn: str) -> Column:
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return F.pmod(F.crc32(F.concat_ws(":", part(conv_id), part(turn)).cast("binary")), F.lit(20))


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with planted faults, told by a hash of conversation and turn: some rows go, lose their text or
    their full stops, come twice, or become the user's. Null roles and texts become one space."""
    h = _damage_key("conv_id", "turn")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    out = rows.select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(role).alias("role"),
        F.when(h == 1, "").when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"),
    )
    return out.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> blocks of one conversation each, with the least cost from each place to each place."""
    from pyspark import TaskContext

    part, seq, now, chars = TaskContext.get().partitionId(), 0, [], 0

    def block() -> dict:
        costs = [_backward([(r["role"], r["fault"], r["copies"]) for r in now], [0 if p == q else NEVER for p in range(4)])[0] for q in range(4)]
        return {
            "conv_id": now[0]["conv_id"], "part": part, "seq": seq, "turns": [r["turn"] for r in now], "roles": [r["role"] for r in now], "texts": [r["text"] for r in now],
            "faults": [r["fault"] for r in now], "copies": [r["copies"] for r in now], "costs": [min(NEVER, costs[q][p]) for p in range(4) for q in range(4)],
        }

    for batch in batches:
        out = []
        for row in (r for at in range(0, batch.num_rows, 64) for r in batch.slice(at, 64).to_pylist()):
            if now and (row["conv_id"] != now[0]["conv_id"] or len(now) >= BLOCK_ROWS or chars >= BLOCK_CHARS):
                out.append(block())
                seq, now, chars = seq + 1, [], 0
            now.append(row)
            chars += len(row["text"])
        if out:
            yield pa.RecordBatch.from_pylist(out, BLOCK_ARROW)
    if now:
        yield pa.RecordBatch.from_pylist([block()], BLOCK_ARROW)


_BLOCK = "conv_id string, part int, seq int, turns array<long>, roles array<string>, texts array<string>, faults array<int>, copies array<long>, costs array<long>"
_lists = {"array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "string": pa.string(), "int": pa.int32()}
BLOCK_ARROW = pa.schema([(c.split()[0], _lists[c.split()[1]]) for c in _BLOCK.split(", ")])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks' cost tables, last block first -> the costs behind each block."""
    conv, low = (), None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if (row["conv_id"],) != conv:
                conv, low = (row["conv_id"],), [INSERT * n for n in CLOSING]
            out.append({"part": row["part"], "seq": row["seq"], "ends": low})
            low = [min(row["costs"][4 * p + q] + low[q] for q in range(4)) for p in range(4)]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("ends", pa.list_(pa.int64()))]))


_TURN = pa.struct([("edit", pa.string()), ("times", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_REPAIRED = pa.schema([("conv_id", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("edits", pa.list_(_TURN)), ("audit", pa.string()), ("rows", pa.int64()), ("gaps", pa.int64())] + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")] + [("digest", pa.string())])
_MADE = "conv_id string, part int, seq int, edits array<struct<edit string, times long, turn long, role string, text string>>, audit string, rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, digest string"


class _Walk:
    """One conversation, block by block in order: where the repaired one stands, the last turn seen, and the digest so far."""

    def __init__(self):
        self.place, self.role, self.turn, self.first, self.hash, self.lines = START, None, None, None, hashlib.sha256(), 0

    def say(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
        self.lines += 1

    def insert(self, edits: list[dict]) -> None:
        self.place = USER if self.place != USER else ASSISTANT
        edits.append({"edit": "I", "times": 1, "turn": None, "role": NAMES[self.place], "text": ""})
        self.say(NAMES[self.place], "")

    def block(self, b: dict) -> dict:
        rows = list(zip(b["roles"], b["faults"], b["copies"]))
        steps = _backward(rows, b["ends"])[1]
        n = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
        edits: list[dict] = []
        for turn, text, (role, fault, copies), step in zip(b["turns"], b["texts"], rows, steps):
            if turn is not None:
                if self.turn is not None and turn != self.turn:
                    n["gaps"] += turn - self.turn - 1
                self.turn = turn
            initial = role[:1]
            n["illegal"] += (self.role is not None and self.role + initial not in LEGAL) + (copies - 1) * (2 * initial not in LEGAL)
            self.role = initial
            n["blank"] += copies if fault == BLANK else 0
            n["duplicate"] += (fault == DUPLICATE) + (copies - 1 if fault != BLANK else 0)
            n["truncated"] += fault == CUT
            took = step[self.place]
            if took:
                letters, to = took
                for _ in letters[:-1]:
                    self.insert(edits)
                new = role if letters[-1] == "K" else NAMES[to]
                edits.append({"edit": letters[-1], "times": 1, "turn": turn, "role": new, "text": text})
                self.say(new, text)
                self.place = to
                n["cost"] += (REROLE if letters[-1] == "R" else 0) + INSERT * (len(letters) - 1) + (TRUNCATED if fault == CUT else 0)
            gone = copies - 1 if took else copies
            n["cost"] += DELETE * gone
            if gone:
                edits.append({"edit": "D", "times": gone, "turn": turn, "role": role, "text": None})
        return {"conv_id": b["conv_id"], "part": b["part"], "seq": b["seq"], "edits": edits, "rows": sum(b["copies"]), **n}

    def close(self, last: dict) -> None:
        for _ in range(CLOSING[self.place]):
            self.insert(last["edits"])
            last["cost"] += INSERT
        last["digest"] = self.hash.hexdigest()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole conversations in order -> their edits; the last block of each has the digest of the repaired conversation."""
    conv, walk, held = (), None, None

    def out(blocks: list[dict]) -> pa.RecordBatch:
        for x in blocks:
            x["audit"] = "".join(e["edit"] * e["times"] for e in x["edits"])
        return pa.RecordBatch.from_pylist([{"digest": None} | x for x in blocks], _REPAIRED)

    for batch in batches:
        for at in range(0, batch.num_rows, 64):  # some blocks at a time as Python values
            done = []
            for row in batch.slice(at, 64).to_pylist():
                if (row["conv_id"],) != conv:
                    if held:
                        walk.close(held)
                    conv, walk = (row["conv_id"],), _Walk()
                if held:
                    done.append(held)
                held = walk.block(row)
            if done:
                yield out(done)
    if held:
        walk.close(held)
        yield out([held])


def repair_blocks(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Repairs every conversation at the least cost, and gives the edits block by block.

    A repaired conversation is empty, or one system turn at most, then pairs of a user's and an assistant's turn. Rows (by turn, nulls
    first, then role and text) are kept (free), made the user's or assistant's (3) or deleted (4); empty turns are inserted anywhere
    (3); a truncated row that stays costs 3 more; blank rows and repeats of a role and text seen earlier must go. Of the
    cheapest repairs the one whose edits' letters (K, R, D, I) come first is taken.

    Result: one row per block of up to BLOCK_ROWS rows: conv_id (as string), part and seq (blocks' order in a conversation), edits
    (array of edit, times, turn, role, text; no text of deleted rows), audit (their letters), rows, gaps, blank, duplicate, truncated, illegal, cost (to be summed), and in the
    last block digest, the SHA-256 of the repaired ``role:text`` lines. ``reports`` sums them, ``repaired_turns`` lists what stays.

    The DP runs over a block at a time: each block first gives its costs from place to place, the tables of a conversation
    are chained from its end, and then each block's best steps follow. So a conversation of any length is sorted, searched and
    priced by many tasks; only its edits are strung together in order by one, a block at a time, as the digest demands.
    Equal rows are counted before they are sorted, and a role and text seen earlier is found by its first turn.

    Nulls: a role or text that is null counts as one space, a null turn comes first and leaves gaps alone, and null conversations are one of
    their own. Very long texts are blocks of their own. An empty table gives no blocks. Other columns are not looked at.
    """
    flat, _ = enter(rows, conv_id=conv_id, turn=turn, role=role, text=text)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    flat = flat.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"))
    once = flat.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    once = keep(once.withColumn("hash", F.xxhash64("text")).withColumn("size", F.length("text")))
    same = ["conv_id", "role", "hash", "size"]
    first = once.groupBy(*same).agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn"))["turn"].alias("turn"), F.lit(True).alias("first"))
    a, b = once.alias("a"), first.alias("b")
    body = F.rtrim(F.col("a.text"), F.lit(SPACES))
    fault = F.when(body == "", BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.substring(body, -1, 1).isin(".", "!", "?"), CUT).otherwise(FINE)
    # repeats at one turn follow each other, and the first of them stands for all
    judged = a.join(b, F.expr(" AND ".join(f"a.{c} <=> b.{c}" for c in [*same, "turn"])), "left").select("a.conv_id", "a.turn", "a.role", "a.text", "a.copies", fault.alias("fault"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = judged.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = keep(sorted_.mapInArrow(_blocks, _BLOCK))
    costs = blocks.select("conv_id", "part", "seq", "costs")
    ends = costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq")).mapInArrow(_ends, "part int, seq int, ends array<long>")
    priced = blocks.drop("costs").join(ends, ["part", "seq"])
    return priced.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_walk, _MADE)


def reports(rows: DataFrame, blocks: DataFrame, *, conv_id: str = "conv_id") -> DataFrame:
    """One row per conversation of ``rows``: counts of faults, cost, audit and digest of ``blocks``; zeros, an empty audit and
    the digest of nothing for a conversation without rows in ``blocks``."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    pieces = F.array_sort(F.collect_list(F.struct("part", "seq", "audit")))
    told = blocks.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts], F.array_join(F.transform(pieces, lambda x: x["audit"]), "").alias("audit"), F.max("digest").alias("digest"))
    kind = next(f.dataType for f in rows.schema if f.name == conv_id) if conv_id in rows.columns else T.StringType()
    mine = enter(rows, conv_id=conv_id)[0].select("conv_id").distinct().select(F.col("conv_id").cast(kind).alias("id"))
    both = mine.join(told, F.col("id").cast("string").eqNullSafe(told.conv_id), "left")
    return both.select(F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("digest"))


def repaired_turns(blocks: DataFrame) -> DataFrame:
    """The turns that repair leaves, in order by (conv_id, part, seq, at): edit (K, R or I), the old turn number, role and text."""
    each = blocks.select("conv_id", "part", "seq", F.posexplode("edits").alias("at", "x")).select("conv_id", "part", "seq", "at", "x.*")
    return each.where("edit <> 'D'")
