"""Repair of conversation structure: edits of least cost that leave turns of alternating roles.

1. Each row gives a symbol: its role (s, u, a or other) and its first fault. A conversation's symbols in turn order are
   its signature; only 32-digit keys of (role, text) are gathered, to see which rows repeat an earlier one.
2. Distinct signatures are range-sorted. Sorted signatures walk a prefix trie in depth-first order: the layers of the
   dynamic programme, costs per state of the role automaton, are kept for the current path, so each shared prefix gets
   its layer once. At a terminal node the edits are read from the path's layers.
3. Answers join conversations by signature. Conversations' rows, led by their edits, go through one stream sorted by
   conversation and turn, which hashes the repaired text as it comes; no conversation is held in memory.

Faults of a row, the first that holds counts: blank (only spaces and \\t..\\r), duplicate (role and text of an earlier row of
the conversation), truncated (last other character not . ! ?). Edits: Keep costs nothing, Rerole to user or assistant 2, Delete 3
(blank and duplicate rows must go), Insert an empty turn of user or assistant 2; a truncated row that stays costs 1 more.
The initials of the roles left must read `(s?(ua)+)?`. Among the cheapest edits those whose initials (K, R, D, I) are least in
ASCII order are taken; given initials and signature the repaired conversation is unique.

Defined cases: null role and text are one space. Rows are ordered by turn, nulls first; equal turns by role, then by the md5 of
(role, text). Null conv_ids are one conversation. A conversation without rows after damage, and any that is
all deleted, is empty: its digest is that of the empty string. An empty table gives no rows. Further columns are
ignored. Keys take some 50 bytes a row while they are gathered, and the layers of the longest
signature some 200 bytes a row, so a conversation may have some 5 million rows. Rows of equal md5 are equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut, flat_text

BLANK = " \t\n\u000b\f\r"
# Damage by crc32 % PERIOD, and the costs of edits
PERIOD, DROP, EMPTY, UNPUNCTUATE, REPEAT, TO_USER = 20, 0, 1, 2, 3, 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 40
# States of what has been put out: nothing, s, u, a. Each lets one role follow next, the first also s.
NONE, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
FULL = {"u": "user", "a": "assistant"}


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the planted faults of the dealt query."""
    pick = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % PERIOD
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    picked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), pick.alias("pick")).where(F.col("pick") != DROP)
    hurt = F.when(F.col("pick") == EMPTY, "").when(F.col("pick") == UNPUNCTUATE, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("pick") == REPEAT, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return picked.select("conv_id", "turn", F.when(F.col("pick") == TO_USER, "user").otherwise(F.col("role")).alias("role"), hurt.alias("text"), times.alias("__time")).drop("__time")


def turn_key(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def row_facts(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, key, and flags: 1 blank, 2 truncated, plus 4 times the role's class (s, u, a, other)."""
    ended = F.rtrim(F.col("text"), F.lit(BLANK))
    fault = F.when(ended == "", 1).when(F.instr(F.lit(".!?"), F.right(ended, F.lit(1))) == 0, 2).otherwise(0)
    role = F.instr(F.lit("sua"), F.left("role", F.lit(1)))  # an empty role is at 1 in every string
    kind = F.when((F.col("role") == "") | (role == 0), 3).otherwise(role - 1)
    return rows.select("conv_id", "turn", "role", turn_key(F.col("role"), F.col("text")).alias("key"), (fault + 4 * kind).cast("int").alias("flags"))


FACTS = "conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long"
CLEAN, BROKEN = "suao", "SUAO"  # symbols of rows; x: must go


def first_seen(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True where an owner's key comes first."""
    order = np.lexsort((np.arange(len(keys)), keys, owner))
    new = np.ones(len(keys), bool)
    new[order[1:]] = (keys[order][1:] != keys[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    return new


def _signatures(batches):
    symbols = np.frombuffer((CLEAN + BROKEN).encode(), "S1")
    for batch in batches:
        rows = batch.column("rows")
        offs = rows.offsets.to_numpy().astype(np.int64)
        flat = rows.flatten()
        offs, n = offs - offs[0], batch.num_rows
        owner = np.repeat(np.arange(n), np.diff(offs))
        flags = flat.field("flags").to_numpy()
        keys = flat_text(flat.field("key"))[0].view("S32")
        blank, kind = flags & 3 == 1, flags >> 2
        again = ~first_seen(owner, keys) & ~blank
        broken = (flags & 3 == 2) & ~again
        symbol = symbols[kind + 4 * broken]
        symbol[blank | again] = b"x"
        pair = 4 * kind[:-1] + kind[1:]
        illegal = (owner[:-1] == owner[1:]) & ~np.isin(pair, [4 * 0 + 1, 4 * 1 + 2, 4 * 2 + 1])
        text = symbol.tobytes().decode()
        count = lambda at: np.bincount(owner[at], minlength=n)
        out = [batch.column("conv_id"), pa.array([text[i:j] for i, j in zip(offs[:-1], offs[1:])], pa.string()), batch.column("gaps")]
        out += [pa.array(count(x), pa.int64()) for x in (blank, again, broken, np.flatnonzero(illegal))]
        yield pa.RecordBatch.from_arrays(out, ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"])


def signatures(facts: DataFrame) -> DataFrame:
    """Signature and counts of each conversation."""
    bound_batches(facts.sparkSession)
    gaps = F.when(F.count("turn") == 0, 0).otherwise(F.max("turn") - F.min("turn") + 1 - F.size(F.array_distinct(F.collect_list("turn"))))
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "key", "flags")))
    grouped = facts.groupBy("conv_id").agg(gaps.cast("long").alias("gaps"), rows.alias("rows"))
    slim = F.transform("rows", lambda r: F.struct(r["key"].alias("key"), r["flags"].alias("flags")))
    return grouped.select(F.col("conv_id").cast("long").alias("conv_id"), "gaps", slim.alias("rows")).mapInArrow(_signatures, FACTS)


def step(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(initial, next state, cost) of what can be done with a row, in ASCII order of the initials."""
    out = [("D", state, DELETE)]
    if symbol != "x":
        extra = TRUNCATED * symbol.isupper()
        role, due = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(symbol.lower()), FOLLOWS[state]
        if role == due or role == SYSTEM and state == NONE:
            out.append(("K", role, KEEP + extra))
        out.append(("R", due, REROLE + extra))
    return out


STEPS = {c: [step(c, q) for q in range(4)] for c in CLEAN + BROKEN + "x"}


def with_inserts(costs: list[int]) -> list[int]:
    """Costs after any number of inserted turns; more than three in a row come back to a state."""
    for _ in range(3):
        for q in range(4):
            costs[FOLLOWS[q]] = min(costs[FOLLOWS[q]], costs[q] + INSERT)
    return costs


def next_layer(costs: list[int], symbol: str) -> list[int]:
    """Least cost of each state after one more row."""
    out = [FAR] * 4
    for q in range(4):
        for _, to, cost in STEPS[symbol][q]:
            out[to] = min(out[to], costs[q] + cost)
    return with_inserts(out)


FIRST_LAYER = tuple(with_inserts([0, FAR, FAR, FAR]))


def least_edits(signature: str, layers: list[list[int]]) -> tuple[int, str]:
    """(cost, initials) from the layers of all prefixes of the signature."""
    cost = min(layers[-1][NONE], layers[-1][ASSISTANT])
    marked = []  # per layer the states from which an end of least cost can be reached without loss
    good = {q for q in (NONE, ASSISTANT) if layers[-1][q] == cost}
    for i in range(len(signature), -1, -1):
        for _ in range(3):
            good |= {q for q in range(4) if FOLLOWS[q] in good and layers[i][q] + INSERT == layers[i][FOLLOWS[q]]}
        marked.append(good)
        if i:
            good = {q for q in range(4) for _, to, c in STEPS[signature[i - 1]][q] if to in good and layers[i - 1][q] + c == layers[i][to]}
    marked.reverse()
    out, state, now = [], NONE, 0
    for i in range(len(signature) + 1):
        while True:
            insert = now + INSERT == layers[i][FOLLOWS[state]] and FOLLOWS[state] in marked[i]
            moves = [(c, to, k) for c, to, k in STEPS[signature[i]][state] if to in marked[i + 1] and now + k == layers[i + 1][to]] if i < len(signature) else []
            if i == len(signature) and state in (NONE, ASSISTANT) and now == cost:
                return cost, "".join(out)
            if moves and not (insert and moves[0][0] > "I"):
                char, state, k = moves[0]
                out.append(char)
                now += k
                break
            out.append("I")
            state, now = FOLLOWS[state], now + INSERT
    raise AssertionError("no path")


ANSWERS = "signature string, cost long, audit string"


def _walk(batches):
    """Sorted signatures: the layers of the last one up to the shared prefix are used again."""
    last, layers = "", [list(FIRST_LAYER)]
    for batch in batches:
        found = []
        sigs = batch.column("signature").to_pylist()
        for sig in sigs:
            shared = min(len(last), len(sig))
            if last[:shared] != sig[:shared]:
                shared = next(i for i in range(shared) if last[i] != sig[i])
            del layers[shared + 1 :]
            for symbol in sig[shared:]:
                layers.append(next_layer(layers[-1], symbol))
            last = sig
            found.append(least_edits(sig, layers))
        yield pa.RecordBatch.from_arrays([batch.column("signature"), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], ["signature", "cost", "audit"])


def answers(signed: DataFrame) -> DataFrame:
    """Cost and audit of each distinct signature."""
    distinct = signed.select("signature").distinct()
    return distinct.repartitionByRange("signature").sortWithinPartitions("signature").mapInArrow(_walk, ANSWERS)


class Repair:
    """The repaired text of one conversation, hashed turn by turn."""

    def __init__(self, audit: str):
        self.audit, self.at, self.out, self.sha = audit, 0, 0, hashlib.sha256()
        self.systems = 0

    def _put(self, role: str, text: str) -> None:
        self.sha.update((b"\n" if self.out else b"") + role.encode() + b":" + text.encode())
        self.out += 1

    def _due(self) -> str:
        return FULL["ua"[(self.out - self.systems) % 2]]

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._put(self._due(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.systems += not self.out and role.startswith("s")
            self._put(role, text)
        elif edit == "R":
            self._put(self._due(), text)

    def digest(self) -> str:
        self._inserted()
        return self.sha.hexdigest()


def _repaired(batches):
    now, repair = None, None
    for batch in batches:
        out = []
        for conv, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
            if audit is not None:
                if repair:
                    out.append((now, repair.digest()))
                now, repair = conv, Repair(audit)
            else:
                repair.row(role, text)
        yield pa.record_batch({"conv_id": pa.array([c for c, _ in out], pa.int64()), "repaired_sha256": pa.array([h for _, h in out], pa.string())})
    if repair:
        yield pa.record_batch({"conv_id": pa.array([now], pa.int64()), "repaired_sha256": pa.array([repair.digest()], pa.string())})


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of rows: counts of faults, cost, audit and digest of the repaired text."""
    signed = cut(signatures(row_facts(rows)))
    judged = cut(signed.join(answers(signed), "signature").drop("signature"))
    none = F.lit(None).cast("string")
    led = judged.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("key"), none.alias("text"), "audit")
    told = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", turn_key(F.col("role"), F.col("text")).alias("key"), "text", none.alias("audit"))
    stream = led.unionByName(told).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "key")
    hashed = stream.select("conv_id", "audit", "role", "text").mapInArrow(_repaired, "conv_id long, repaired_sha256 string")
    hashed = hashed.withColumnRenamed("conv_id", "__hashed")
    return judged.join(hashed, F.col("conv_id").eqNullSafe(F.col("__hashed"))).drop("__hashed")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """The dealt query: every original conv_id with the repair of its damaged rows."""
    rows = cut(damage(conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")))
    done = repair(rows).withColumnRenamed("conv_id", "__conv")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    filled = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS] + [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")]
    return ids.join(done, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select("conv_id", *filled)
