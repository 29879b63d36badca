from __future__ import annotations

import re
import zlib
from hashlib import sha256
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boreline.llm import repair

ROWS = "conv_id bigint, turn bigint, role string, text string"
INSERTS = [x for n in range(3) for x in product("ua", repeat=n)]


def faults(rows):
    out = []
    for k, (role, text) in enumerate(rows):
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("b" if not solid else "d" if (role, text) in rows[:k] else "" if solid[-1] in ".!?" else "t")
    return out


def cheapest(rows):
    """(cost, letters, messages) by trying every edit of every row and up to two inserts at every place."""
    best = None
    ways = []
    for (role, text), fault in zip(rows, faults(rows)):
        more = fault == "t"
        ways.append([(3, "D", None)] + [] if fault in ("b", "d") else [(3, "D", None), (more, "K", (role, text)), (2 + more, "R", ("user", text)), (2 + more, "R", ("assistant", text))])
    for edits in product(*ways):
        for puts in product(INSERTS, repeat=len(rows) + 1):
            letters, said, cost = "", [], 0
            for k, put in enumerate(puts):
                letters += "I" * len(put)
                said += [({"u": "user", "a": "assistant"}[x], "") for x in put]
                cost += 2 * len(put)
                if k < len(edits):
                    letters += edits[k][1]
                    cost += edits[k][0]
                    said += [edits[k][2]] if edits[k][2] else []
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "x" for r, _ in said)) and (best is None or (cost, letters) < best[:2]):
                best = (cost, letters, said)
    return best


ROW = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "usher"]), st.sampled_from(["", " \n", "One.", "two", "Three? ", "four;"]))


@given(st.lists(ROW, max_size=3))
@settings(max_examples=60, deadline=None)
def test_edits_are_the_cheapest_and_first(rows):
    codes = repair.codes_of(rows)
    audit, _, cost = repair.walk(codes)
    want = cheapest(rows)
    assert (cost, audit) == want[:2]
    assert [(r, t) for e, r, t in repair.edited(audit, rows) if e != "D"] == want[2]
    assert repair.fault_counts(codes) == tuple(faults(rows).count(f) for f in "bdt")


@given(st.lists(st.integers(0, 15), max_size=90), st.lists(st.integers(0, 90), max_size=4))
@settings(max_examples=80, deadline=None)
def test_pieces_give_what_the_whole_gives(letters, cuts):
    codes = bytes(65 + k for k in letters)
    at = sorted({min(c, len(codes)) for c in cuts} | {0, len(codes)})
    pieces = [codes[a:b] for a, b in zip(at, at[1:])]
    ends, vector = [], repair.AT_END
    for piece in reversed(pieces):
        ends.append(vector)
        m = repair.matrix(piece)
        vector = tuple(min(m[k][q] + vector[k] for k in range(4)) for q in range(4))
    audit, state, cost = "", 0, vector[0]
    for k, (piece, end) in enumerate(zip(pieces, reversed(ends))):
        part, state, _ = repair.walk(piece, state, end, k == len(pieces) - 1)
        audit += part
    assert (audit, cost) == (repair.walk(codes)[0], repair.walk(codes)[2]) or not pieces


def by_hand(rows):
    """Reports of small conversations from the contract's words."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        own = convs.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        own += [(turn is not None, turn or 0, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort()
        said = [r[2:] for r in own]
        turns = [t for known, t, _, _ in own if known]
        kinds = faults(said)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:]))
        cost, audit, kept = cheapest(said)
        out.append((conv, gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x."), (1, None, "system", "S."), (1, 5, "user", None), (1, 9, "assistant", "End!")]
    rows += [(c, t, r, x) for c in range(2, 42) for t, r, x in [(0, "user", "Hi."), (1, "assistant", "é 🙂"), (1, "user", "Hi.")][: 1 + c % 3]]
    rows += [(7000 + k, 3, "user", "long " * 50_000 + "!") for k in range(3)]
    df = spark.createDataFrame(rows, ROWS)
    return rows, df.withColumns({c: F.lit("x") for c in "conv here code part at row digest first edit place fault copy present audit".split()})


def reports(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("limit", [repair.LONG_ROWS, 0, 1])
def test_odd_rows(odd, limit):
    rows, df = odd
    got = repair.repair_report(repair.damaged(df), present="present", long_rows=limit)
    assert got.columns == ["conv_id", *(c.split()[0] for c in repair.REPORT.split(", "))]
    assert reports(got) == by_hand(rows)


def test_long_conversations_are_dealt_over_tasks(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 7 + 2).alias("conv_id"),
        F.expr("if(id % 50 = 0, null, id div 3)").alias("turn"),
        F.expr("element_at(array('user', 'assistant', 'system', 'tool', 'assistant'), cast(hash(id) & 1023 as int) % 5 + 1)").alias("role"),
        F.expr("case when id % 11 = 0 then ' ' when id % 5 = 0 then concat('cut ', id % 900) else concat('Text ', id % 4000, '.') end").alias("text"),
    )
    whole, dealt = repair.repair_report(rows), repair.repair_report(rows, long_rows=3_000)
    want = reports(whole)
    assert want == reports(dealt) and max(len(r[7]) for r in want) > 24_000
    order = ["conv_id", "place"]
    left = repair.repaired_messages(rows).orderBy(*order).collect()
    assert left == repair.repaired_messages(rows, long_chars=20_000).orderBy(*order).collect()
    kept = {}
    for r in left:
        if r.edit != "D":
            kept.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {r[0]: r[8] for r in want} == {c: sha256("\n".join(x).encode()).hexdigest() for c, x in kept.items()}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(m[0] for m in x)) for x in kept.values())


def test_empty_table_and_conversations_without_rows(spark):
    empty = spark.createDataFrame([], ROWS)
    assert repair.repair_report(repair.damaged(empty), present="present").count() == 0
    assert repair.repaired_messages(empty).count() == 0
    gone = spark.createDataFrame([(5, 1, "user", "x", False), (5, 2, "user", "x", None)], ROWS + ", present boolean")
    assert reports(repair.repair_report(gone, present="present")) == [(5, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
