"""Repairs against all edits by brute force; damage, odd rows and long conversations."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from tarnwork.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out += [(c, t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def plain_edits(symbols):
    """Least (cost, initials) of all edits of [(initial, fault)], by trying them."""

    @functools.cache
    def best(i, out):
        found = []
        if re.fullmatch("(s?(ua)+)?", out) and i == len(symbols):
            found.append((0, ""))
        due = "a" if out[-1:] == "u" else "u"
        nexts = []
        if i < len(symbols):
            role, fault = symbols[i]
            extra = fault == "truncated"
            nexts.append((3, "D", i + 1, out))
            if fault not in ("blank", "duplicate"):
                if role == due or role == "s" and not out:
                    nexts.append((extra, "K", i + 1, out + role))
                nexts.append((2 + extra, "R", i + 1, out + due))
        if len(out) < len(symbols) + 3:
            nexts.append((2, "I", i, out + due))
        for cost, char, j, then in nexts:
            rest = best(j, then)
            if rest:
                found.append((cost + rest[0], char + rest[1]))
        return min(found) if found else None

    return best(0, "")


def plain(rows):
    ids, kept = {r[0] for r in rows}, {}
    for r in sorted(plain_damage(rows), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest())):
        kept.setdefault(r[0], []).append(r)
    out = []
    for c in ids:
        mine, faults, seen = kept.get(c, []), [], set()
        for _, _, r, x in mine:
            last = WORD.findall(x)[-1:]
            faults.append("blank" if not last else "duplicate" if (r, x) in seen else "truncated" if last[0] not in ".!?" else "")
            seen.add((r, x))
        turns = [t for _, t, _, _ in mine if t is not None]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit = plain_edits(tuple((r[2][:1], f) for r, f in zip(mine, faults)))
        texts, at, roles = [], 0, ""
        for e in audit:
            due = "assistant" if roles[-1:] == "u" else "user"
            row = None if e == "I" else mine[at]
            at += e != "I"
            if e != "D":
                role, text = (row[2], row[3]) if e == "K" else (due, "" if e == "I" else row[3])
                texts.append(f"{role}:{text}")
                roles += role[:1]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", *cr.COUNTS, "audit", "repaired_sha256").collect()), key=str)


def conversations(seed, n, most=7):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a b.", "what?", "yes! ", "cut", " \t", "", "end.\n", "é"])) for t in range(rng.randint(1, most)) if rng.random() < 0.9]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = conversations(seed, 150)
    assert got(cr.damage_and_repair(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_odd_rows(spark):
    """Nulls in every column, repeated rows, ties of turns, a very long text, an empty role, conversations whose every row goes, further columns."""
    rows = [
        (1, None, "user", "x."), (1, 0, None, None), (1, 2**40, "assistant", "y"), (None, 0, "user", "z."), (None, None, "assistant", "z."), (2, 0, "user", "q " * 200_000 + "."), (2, 0, "user", "same"), (2, 0, "assistant", "same"),
        (3, 1, "", "empty role."), (3, 1, "", "empty role."), (3, 1, "", "empty role."), (4, None, "system", "s."), (5, 0, "uSER", "\x0b\x0c.\t"), (5, 1, "sys", "a "),
    ]
    gone = next(c for c in range(10, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "dropped."))
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", pick int").withColumnRenamed("pick", "Audit")
    assert got(cr.damage_and_repair(df)) == plain(rows)
    assert got(cr.damage_and_repair(spark.createDataFrame([], SCHEMA))) == []


def test_all_short_signatures():
    names = {"x": ("u", "blank")} | {c: (c.lower(), "truncated" if c.isupper() else "") for c in cr.CLEAN + cr.BROKEN}
    layers_of = lambda sig: functools.reduce(lambda ls, c: [*ls, cr.next_layer(ls[-1], c)], sig, [list(cr.FIRST_LAYER)])
    for n in range(4):
        for sig in map("".join, itertools.product("suaoUAx", repeat=n)):
            assert cr.least_edits(sig, layers_of(sig)) == plain_edits(tuple(names[c] for c in sig)), sig


def test_shared_prefixes_get_their_layers_once(monkeypatch):
    import pyarrow as pa

    calls = []
    inner = cr.next_layer
    monkeypatch.setattr(cr, "next_layer", lambda costs, c: calls.append(c) or inner(costs, c))
    sigs = sorted(["ua" * 50 + t for t in ("", "x", "ux", "uxa", "s")])
    out = list(cr._walk([pa.record_batch({"signature": sigs[:2]}), pa.record_batch({"signature": sigs[2:]})]))
    assert len(calls) == 100 + len({"x", "u", "ux", "uxa", "s"})
    assert sum(b.num_rows for b in out) == 5


def test_one_long_conversation(spark):
    rows = [(0, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(20_000)]
    out = cr.repair(spark.createDataFrame(rows, SCHEMA)).first()
    assert (out["cost"], out["audit"]) == (0, "K" * 20_000)
    assert out["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows).encode()).hexdigest()
