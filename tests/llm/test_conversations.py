"""Conversation repair against a plain shortest-path version, and by hand."""

import hashlib
import zlib
from collections import defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from readflow.llm import conversations, queries


def plain_plan(codes):
    """The cheapest audit from the last row backwards, states 0 nothing, 1 system, 2 user, 3 assistant."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    ways = {0: (0, ""), 1: (10, "II"), 2: (5, "I"), 3: (0, "")}
    for code in reversed(codes):
        role, extra = code % 4, 5 if code >= 4 else 0
        here = {}
        for s in range(4):
            options = [(ways[s][0] + 2, "D" + ways[s][1])]
            if code < 8:
                options.append((ways[after[s]][0] + 1 + extra, "R" + ways[after[s]][1]))
                to = 1 if role == 0 and s == 0 else {1: 2, 2: 3}.get(role) if after[s] == role + 1 else None
                if to:
                    options.append((ways[to][0] + extra, "K" + ways[to][1]))
            here[s] = min(options)
        once = lambda s, w: (w[0] + 5, "I" + w[1])
        ways = {s: min(here[s], once(s, here[after[s]]), once(s, once(s, here[after[after[s]]]))) for s in range(4)}
    return ways[0]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 11), max_size=40), st.integers(1, 40))
def test_cheapest_edits(codes, piece):
    assert conversations.plan_edits(bytes(codes), piece) == plain_plan(codes)


def test_long_conversations_stay_cheap():
    for pattern in ([1], [2], [0], [5, 9, 1, 2, 3]):
        codes = bytes(pattern * 600)[:3000]
        assert conversations.plan_edits(codes) == plain_plan(codes)


def plain(rows):
    """``op11`` on rows (conv, turn, role, text): conv -> the result's values."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        own = groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h:
            text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
            own.extend([(turn is not None, turn or 0, "user" if h == 4 else role, text)] * (2 if h == 3 else 1))
    out = {}
    for conv, own in groups.items():
        own.sort()
        seen, codes, counts = set(), [], defaultdict(int)
        for _, _, role, text in own:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            codes.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + {"truncated": 4, None: 0}.get(fault, 8))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        turns = [t for known, t, *_ in own if known]
        cost, audit = plain_plan(codes) if own else (0, "")
        rest, lines, last = iter(own), [], ""
        for edit in audit:
            role, text = next(rest)[2:] if edit != "I" else ("", "")
            if edit != "D":
                role = role if edit == "K" else "assistant" if last == "user" else "user"
                last = "user" if role[:1] == "u" else role
                lines.append(f"{role}:{text}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"],
                     illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def run(spark, folder, rows, extra=()):
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType()), *[T.StructField(n, T.StringType()) for n in extra]])
    spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema).write.parquet(f"{folder}/conversations.parquet")
    found = queries.QUERIES["op11_conversations"](spark, str(folder)).collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in found}


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = queries.QUERIES["op11_conversations"](spark, sf).collect()
    assert {r["conv_id"]: tuple(r[n] for n in NAMES) for r in found} == plain(map(tuple, rows))


def test_odd_rows(spark, tmp_path):
    """Nulls, blanks, odd roles, repeated rows and turns, a conversation of many rows, and columns named like the operator's."""
    rows = [(1, t, r, x) for t in (None, 1, 2, 2, 5) for r in ("user", "assistant", "system", None, "", "tool") for x in (None, "", "a.", "b", " \n\t")]
    rows += [(2, None, None, None)] * 3 + [(None, 1, "user", "hm?"), (None, 2, "assistant", "ok!\n"), (3, 7, "user", "long " * 20_000)]
    rows += [(4, t, ("user", "assistant")[t % 2], f"text {t % 50}.") for t in range(900)] + [(k, 0, "user", "one.") for k in range(5, 60)]
    got = run(spark, tmp_path, rows, ["conv", "place", "fault", "n", "audit", "c", "code"])
    assert got == plain(rows)
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for v in got.values())


def test_empty(spark, tmp_path):
    assert run(spark, tmp_path, []) == {}


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 3, "user", "u."), (1, 4, "user", "u."), (2, 0, "assistant", " ")]
    repaired, found = conversations.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    plans = {r["conv"]: r for r in found.collect()}
    assert plans[1]["gaps"] == 1 and plans[1]["duplicate"] == 1 and plans[2]["audit"] == "D" and plans[2]["blank"] == 1
    kept = repaired.filter("conv = 1").orderBy("at").collect()
    assert [r["at"] for r in kept] == list(range(1, len(kept) + 1)) and repaired.filter("conv = 2").count() == 0
    initials = "".join(r["role"][0] for r in kept).lstrip("s")
    assert len(initials) % 2 == 0 and initials == "ua" * (len(initials) // 2)
