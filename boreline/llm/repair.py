"""Repair of the role structure of conversations by least-cost edits.

A conversation is right if its roles' initials are ``(s?(ua)+)?``. Each row is
kept, given another role, or deleted, and empty rows may be put in; blank and
repeated rows must go. Read from the end, the least cost from each of the four
states of that pattern is a vector. A conversation's vectors are stored only
at checkpoints, a square root of its length apart; walking forward, each
block's vectors are worked out again from the checkpoint behind it, and of the
tight edits the first by ASCII is written down.

A conversation too long for one task is dealt by ranges of its order. Each
piece becomes a matrix of least costs between states; the pieces' matrices
give the vector behind each piece, so all pieces are walked at once, from each
state they may be entered in, and the states that were really met are picked
from the pieces' exits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import inf, isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from boreline.llm.rows import drop_stored, table
from boreline.session import stored

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: A conversation of more rows or characters is dealt over several tasks.
LONG_ROWS, LONG_CHARS = 20_000, 64 << 20

# White space, ends of sentences, initials, and the edits' letters in ASCII order.
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
CLASSES = {"s": 0, "u": 1, "a": 2}
OTHER = 3
GOOD, BLANK, REPEATED, CUT = range(4)
#: States: nothing yet, after system, after user, after assistant. What a user or assistant row leads to, and the role it has.
NEXT, NEXT_ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: State after keeping a row, by class of its role and state before.
KEEP = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
#: Cost of what must still be put in behind the last row.
AT_END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {(0, 1), (1, 2), (2, 1)}

Vector = tuple[float, float, float, float]


def code_of(initial: int, fault: int) -> int:
    """A row as one letter."""
    return 65 + 4 * initial + fault


def _before(code: int, after: Vector) -> Vector:
    """Least costs from each state before a row, from those behind it."""
    initial, fault = divmod(code - 65, 4)
    best = [DELETE + c for c in after]
    if fault not in (BLANK, REPEATED):
        extra, keep = TRUNCATED * (fault == CUT), KEEP[initial]
        for q in range(4):
            to = keep[q]
            cost = extra + min(REROLE + after[NEXT[q]], inf if to is None else after[to])
            if cost < best[q]:
                best[q] = cost
    none, system, user, assistant = best
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(none, INSERT + user), min(system, INSERT + user), user, assistant


def start_costs(codes: bytes, end: Vector = AT_END) -> Vector:
    """The vector before the first row."""
    for code in reversed(codes):
        end = _before(code, end)
    return end


def matrix(codes: bytes) -> list[Vector]:
    """Least costs from each state before the rows to each state behind them (by that state)."""
    return [start_costs(codes, tuple(0 if q == k else inf for q in range(4))) for k in range(4)]


def walk(codes: bytes, state: int = 0, end: Vector = AT_END, last: bool = True) -> tuple[str, int, float]:
    """The tight edits that come first by ASCII, the state behind them, and their cost with what follows.

    ``end`` is the vector behind the rows; if these are the ``last`` ones, what
    is missing at the end is put in too.
    """
    n = len(codes)
    block = isqrt(n) + 1
    marks, vector = {}, end
    for at in range(n, 0, -1):
        if at % block == 0:
            marks[at] = vector
        vector = _before(codes[at - 1], vector)
    total, out = vector[state], []
    for low in range(0, n, block):
        high = min(low + block, n)
        vector = marks.get(high, end)
        vectors = [vector]
        for code in reversed(codes[low:high]):
            vectors.append(vector := _before(code, vector))
        for at in range(low, high):
            now, after = vectors[high - at], vectors[high - at - 1]
            initial, fault = divmod(codes[at] - 65, 4)
            stays = fault not in (BLANK, REPEATED)
            extra = TRUNCATED * (fault == CUT)
            while True:
                cost, to = now[state], KEEP[initial][state]
                if cost == DELETE + after[state]:
                    out.append("D")
                elif cost == INSERT + now[NEXT[state]]:
                    out.append("I")
                    state = NEXT[state]
                    continue
                elif stays and to is not None and cost == extra + after[to]:
                    out.append("K")
                    state = to
                else:
                    out.append("R")
                    state = NEXT[state]
                break
    while last and AT_END[state]:
        out.append("I")
        state = NEXT[state]
    return "".join(out), state, total


def illegal_pairs(codes: bytes) -> int:
    initials = [(c - 65) // 4 for c in codes]
    return sum(pair not in LEGAL for pair in zip(initials, initials[1:]))


def fault_of(text: str) -> int:
    """Blank, cut off or good; whether it is repeated is seen from the rows before."""
    solid = text.rstrip(BLANKS)
    return BLANK if not solid else GOOD if solid[-1] in ENDS else CUT


def class_of(role: str) -> int:
    return CLASSES.get(role[:1], OTHER)


def edited(edits: str, rows: Iterator[tuple[str, str]], state: int = 0) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every edit: the rows that stay and those put in; deleted rows with their own role and text."""
    rows = iter(rows)
    for edit in edits:
        if edit == "I":
            role, text = NEXT_ROLE[state], ""
        else:
            role, text = next(rows)
        if edit == "K":
            state = KEEP[class_of(role)][state]
        elif edit != "D":
            role, state = NEXT_ROLE[state], NEXT[state]
        yield edit, role, text


def codes_of(rows: list[tuple[str, str]]) -> bytes:
    """The letters of a whole conversation's rows, in order."""
    seen, out = set(), bytearray()
    for role, text in rows:
        fault = fault_of(text)
        if (role, text) in seen and fault != BLANK:
            fault = REPEATED
        seen.add((role, text))
        out.append(code_of(class_of(role), fault))
    return bytes(out)


def fault_counts(codes: bytes) -> tuple[int, int, int]:
    faults = [(c - 65) % 4 for c in codes]
    return faults.count(BLANK), faults.count(REPEATED), faults.count(CUT)


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
MESSAGES = "place bigint, edit string, role string, text string"


def _ordered_rows(df: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    """Clean columns; a null role or text reads as one space. Rows that are not present keep their conversation's name alone."""
    here = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    rows = df.select(F.col(conv).alias("conv"), here.alias("here"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    rows = rows.select("conv", "here", *(F.when(F.col("here"), F.col(c)).alias(c) for c in ("turn", "role", "text")))
    return rows.withColumn("digest", F.xxhash64("text"))


def _order() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def _conversations(batches) -> Iterator[tuple[object, list[tuple]]]:
    """(name, rows) of each run of rows with one name."""
    name, held, begun = None, [], False
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if begun and row[0] != name:
                yield name, held
                held = []
            name, begun = row[0], True
            held.append(row[1:])
    if begun:
        yield name, held


def _digest(messages: Iterator[tuple[str, str, str]]) -> str:
    out, first = hashlib.sha256(), True
    for edit, role, text in messages:
        if edit != "D":
            out.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
    return out.hexdigest()


def _in_batches(rows: Iterator[tuple], kinds: list[pa.DataType], names: list[str], size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def packed():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield packed()
            held = []
    if held:
        yield packed()


def _whole(rows: DataFrame, kind: str, messages: bool) -> DataFrame:
    """Conversations that fit one task."""
    schema = _parse_datatype_string(f"conv {kind}, " + (MESSAGES if messages else REPORT))
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def each(batches):
        for name, held in _conversations(batches):
            own = [(role, text) for here, _, role, text in held if here]
            codes = codes_of(own)
            audit, _, cost = walk(codes)
            if messages:
                for place, (edit, role, text) in enumerate(edited(audit, own)):
                    yield name, place, edit, role, text
                continue
            turns = [t for here, t, _, _ in held if here and t is not None]
            gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
            yield (name, gaps, *fault_counts(codes), illegal_pairs(codes), cost, audit, _digest(edited(audit, own)))

    def run(batches):
        yield from _in_batches(each(batches), kinds, schema.names)

    ordered = rows.repartition("conv").sortWithinPartitions(*_order())
    return ordered.select("conv", "here", "turn", "role", "text").mapInArrow(run, schema)


def _letters() -> Column:
    """The code of a row of the long conversations, as ``code_of`` has it."""
    solid = F.rtrim(F.translate("text", BLANKS, " " * len(BLANKS)))
    fault = F.when(solid == "", BLANK).when(F.col("again"), REPEATED).when(F.substring(solid, -1, 1).isin(*ENDS), GOOD).otherwise(CUT)
    initial = F.lit(OTHER)
    for letter, k in CLASSES.items():
        initial = F.when(F.substring("role", 1, 1) == letter, k).otherwise(initial)
    return F.char(F.lit(65) + 4 * initial + fault)


def _long(rows: DataFrame, kind: str, messages: bool) -> DataFrame:
    """Conversations dealt over tasks: placed, cut into pieces, walked by piece, put together again."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.where("here").withColumn("row", F.monotonically_increasing_id())
    order = [*_order(), F.col("row").asc()]
    placed = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    # The number has the task in its upper bits, so it rises along a conversation.
    placed = stored(placed.select("conv", "turn", "role", "text", F.sha2("text", 256).alias("digest"), "at", F.shiftright("at", 33).alias("part")), "long-rows")
    same = lambda a, b: a.eqNullSafe(b)  # noqa: E731  (conversations without a name are one)

    first = placed.groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = stored(first.toDF("conv_", "role_", "digest_", "first", "n").drop("n"), "first-rows")
    seen = placed.join(first, same(placed["conv"], first["conv_"]) & (placed["role"] == first["role_"]) & (placed["digest"] == first["digest_"]), "left")
    coded = seen.withColumn("again", F.coalesce(F.col("at") > F.col("first"), F.lit(False))).select("conv", "part", "at", _letters().alias("code"))
    letters = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]), "")
    pieces = stored(coded.groupBy("conv", "part").agg(letters.alias("codes")), "pieces")

    made = _parse_datatype_string(f"conv {kind}, part bigint, costs array<double>, first int, last int, blank bigint, duplicate bigint, truncated bigint, illegal bigint")

    def matrices(batches):
        def each():
            for batch in batches:
                for conv, part, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    codes = codes.encode()
                    costs = [c for v in matrix(codes) for c in v]
                    yield (conv, part, costs, (codes[0] - 65) // 4, (codes[-1] - 65) // 4, *fault_counts(codes), illegal_pairs(codes))

        yield from _in_batches(each(), [to_arrow_type(f.dataType) for f in made], made.names)

    costs = stored(pieces.select("conv", "part", "codes").mapInArrow(matrices, made), "piece-costs")

    def behind(group: pd.DataFrame) -> pd.DataFrame:
        group, vector, out = group.sort_values("part"), AT_END, []
        for costs in reversed(group["costs"].tolist()):
            out.append(list(vector))
            vector = tuple(min(costs[4 * k + q] + vector[k] for k in range(4)) for q in range(4))
        ends = zip(group["last"], group["first"].iloc[1:])
        between = [int(pair not in LEGAL) for pair in ends]
        return pd.DataFrame({"conv": group["conv"], "part": group["part"], "behind": out[::-1], "final": [False] * (len(group) - 1) + [True], "cost": int(vector[0]), "between": [0, *between]})

    # One row for each task that has rows of the conversation.
    ends = stored(costs.groupBy("conv").applyInPandas(behind, f"conv {kind}, part bigint, behind array<double>, final boolean, cost bigint, between bigint"), "piece-ends")
    todo = pieces.join(ends.toDF("conv_", "part_", "behind", "final", "cost", "between"), same(pieces["conv"], F.col("conv_")) & (pieces["part"] == F.col("part_")))
    ways = _parse_datatype_string(f"conv {kind}, part bigint, edits array<string>, exits array<int>")

    def walked(batches):
        def each():
            for batch in batches:
                for conv, part, codes, behind, final in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    found = [walk(codes.encode(), q, tuple(behind), final) for q in range(4)]
                    yield conv, part, [f[0] for f in found], [f[1] for f in found]

        yield from _in_batches(each(), [to_arrow_type(f.dataType) for f in ways], ways.names, 20)

    edits = stored(todo.select("conv", "part", "codes", "behind", "final").mapInArrow(walked, ways), "piece-edits")

    def met(group: pd.DataFrame) -> pd.DataFrame:
        group, state, out = group.sort_values("part"), 0, []
        for exits in group["exits"].tolist():
            out.append(state)
            state = int(exits[state])
        return pd.DataFrame({"conv": group["conv"], "part": group["part"], "state": out})

    states = edits.select("conv", "part", "exits").groupBy("conv").applyInPandas(met, f"conv {kind}, part bigint, state int").toDF("conv_", "part_", "state")
    chosen = edits.join(states, same(edits["conv"], F.col("conv_")) & (edits["part"] == F.col("part_"))).select("conv", "part", F.get("edits", F.col("state")).alias("audit"))
    chosen = stored(chosen, "chosen-edits")

    # Each row gets its own edit and what is put in before it.
    own = chosen.select(F.col("conv").alias("conv_"), F.col("part").alias("part_"), F.posexplode(F.expr("regexp_extract_all(audit, 'I*[DKR]', 0)")).alias("n_", "edit"))
    lowest = placed.groupBy("conv", "part").agg(F.min("at").alias("low")).toDF("conv_", "part_", "low_")
    own = own.join(lowest, own["conv_"].eqNullSafe(lowest["conv_"]) & (own["part_"] == lowest["part_"])).select((F.col("low_") + F.col("n_")).alias("at"), "edit")
    lines = stored(placed.join(own, "at").select("conv", "at", "role", "text", "edit"), "long-edits")
    out = _written(lines, kind, messages)
    if not messages:
        # A hash of one text is taken in order, by one task that holds no more than a batch of it.
        turns = placed.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
        counts = costs.groupBy("conv").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))
        totals = ends.groupBy("conv").agg(F.max("cost").alias("cost"), F.sum("between").alias("between"))
        audits = chosen.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        whole = turns
        for k, other in enumerate((counts, totals, audits, out)):
            other = other.withColumnRenamed("conv", f"conv{k}")
            whole = whole.join(other, same(whole["conv"], other[f"conv{k}"])).drop(f"conv{k}")
        out = stored(whole.withColumn("illegal", F.col("illegal") + F.col("between")).select("conv", *(c.split()[0] for c in REPORT.split(", "))), "long-reports")
        for used in (placed, first, pieces, costs, ends, edits, chosen, lines):
            drop_stored(spark, used)
    return out


def _written(lines: DataFrame, kind: str, messages: bool) -> DataFrame:
    """The repaired rows, or their digest, of conversations read in order without holding them."""
    schema = _parse_datatype_string(f"conv {kind}, " + (MESSAGES if messages else "repaired_sha256 string"))
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def stream(batches):
        """(conversation, edit, role, text) in order; what is missing at the end of one comes when the next begins."""
        name, state, begun = None, 0, False

        def end():
            at = state
            while AT_END[at]:
                yield name, "I", NEXT_ROLE[at], ""
                at = NEXT[at]

        for batch in batches:
            for conv, role, text, edits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun and conv != name:
                    yield from end()
                    state = 0
                name, begun = conv, True
                for edit, role_, text_ in edited(edits, [(role, text)], state):
                    state = state if edit == "D" else KEEP[class_of(role_)][state] if edit == "K" else NEXT[state]
                    yield name, edit, role_, text_
        if begun:
            yield from end()

    def rows(batches):
        name, place, begun = None, 0, False
        for conv, edit, role, text in stream(batches):
            place = place + 1 if begun and conv == name else 0
            name, begun = conv, True
            yield conv, place, edit, role, text

    def digests(batches):
        name, out, empty, begun = None, hashlib.sha256(), True, False
        for conv, edit, role, text in stream(batches):
            if begun and conv != name:
                yield name, out.hexdigest()
                out, empty = hashlib.sha256(), True
            name, begun = conv, True
            if edit != "D":
                out.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                empty = False
        if begun:
            yield name, out.hexdigest()

    def run(batches):
        yield from _in_batches((rows if messages else digests)(batches), kinds, schema.names)

    ordered = lines.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "at")
    return ordered.select("conv", "role", "text", "edit").mapInArrow(run, schema)


def _repaired(df: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None, messages: bool, long_rows: int, long_chars: int) -> DataFrame:
    kind = dict(df.dtypes)[conv]
    rows = _ordered_rows(df, conv, turn, role, text, present)
    sizes = rows.where("here").groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    long = stored(sizes.where((F.col("n") > long_rows) | (F.col("chars") > long_chars)).select(F.col("conv").alias("conv_")), "long")
    if long.isEmpty():
        return _whole(rows, kind, messages).withColumnRenamed("conv", conv)
    is_long = rows["conv"].eqNullSafe(long["conv_"])
    short = _whole(rows.join(long, is_long, "left_anti"), kind, messages)
    return short.unionByName(_long(rows.join(long, is_long, "left_semi"), kind, messages)).withColumnRenamed("conv", conv)


def repair_report(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS
) -> DataFrame:
    """A row for each conversation: faults, cost and letters of its edits, digest of what is repaired.

    Rows are taken by turn, nulls first, then by role and text; a null role or
    text reads as one space, which makes a blank row and a role of no known
    initial. Rows without a conversation are one conversation. Repeated rows
    are faults. Where ``present`` names a column, rows in which it is not true
    count for nothing, but their conversation is listed: with no other rows it
    has zeros, no edits and the digest of nothing. An empty table gives no
    row, other columns are ignored. The size from which a conversation is
    dealt over tasks changes no result.
    """
    return _repaired(df, conv, turn, role, text, present, False, long_rows, long_chars)


def repaired_messages(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS
) -> DataFrame:
    """The conversations row by row: ``place`` (from 0), ``edit``, ``role``, ``text``; deleted rows are listed with the edit ``D``.

    What holds for ``repair_report`` holds here; a conversation without edits is not listed.
    """
    return _repaired(df, conv, turn, role, text, present, True, long_rows, long_chars)


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults chosen by a checksum of ``conv_id:turn``: dropped (``present`` false), emptied, without ends of sentences, repeated, or of role user."""
    clean = df.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(name.cast("binary")) % 20
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    rows = clean.withColumn("fault", fault).withColumn("copy", copies)
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")), present="present")


_CRC_TABLE = "(SELECT list(list_reduce([v, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY v) AS t FROM range(256) r(v))"
ORACLE = rf"""
WITH RECURSIVE crc AS {_CRC_TABLE},
clean AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h
  FROM conversations),
dealt AS (
  SELECT clean.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS f
  FROM clean, crc),
rows_ AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE f WHEN 3 THEN [1, 2] ELSE [1] END) FROM dealt WHERE f <> 0)),
named AS (SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (SELECT n.c, r.turn, r.role, r.text, row_number() OVER (PARTITION BY n.c ORDER BY turn NULLS FIRST, role, text) AS i FROM rows_ r JOIN named n ON r.conv_id IS NOT DISTINCT FROM n.conv_id),
seen AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid, role[1] AS ini FROM placed),
faults AS (
  SELECT *, CASE WHEN solid = '' THEN 'b' WHEN again THEN 'd' WHEN solid[-1] NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY c ORDER BY i) || ini AS pair FROM seen),
rows_of AS (SELECT c, i, ini, fault IN ('b', 'd') AS must, CASE fault WHEN 't' THEN 1 ELSE 0 END AS cut FROM faults),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faults GROUP BY 1),
-- Least (cost, letters) from the states none, system, user and assistant, row by row from the end.
best(c, i, v0, v1, v2, v3) AS (
  SELECT c, n + 1, {{'c': 0, 's': ''}}, {{'c': 4, 's': 'II'}}, {{'c': 2, 's': 'I'}}, {{'c': 0, 's': ''}} FROM counts
  UNION ALL
  SELECT c, i, least(b0, {{'c': u.c + 2, 's': 'I' || u.s}}), least(b1, {{'c': u.c + 2, 's': 'I' || u.s}}), u, least(b3, {{'c': b2.c + 2, 's': 'I' || b2.s}})
  FROM (SELECT *, least(b2, {{'c': b3.c + 2, 's': 'I' || b3.s}}) AS u FROM (
    SELECT b.c, r.i,
      least({{'c': v0.c + 3, 's': 'D' || v0.s}}, CASE WHEN must THEN NULL ELSE {{'c': v2.c + cut + 2, 's': 'R' || v2.s}} END, CASE WHEN NOT must AND ini = 'u' THEN {{'c': v2.c + cut, 's': 'K' || v2.s}} WHEN NOT must AND ini = 's' THEN {{'c': v1.c + cut, 's': 'K' || v1.s}} END) AS b0,
      least({{'c': v1.c + 3, 's': 'D' || v1.s}}, CASE WHEN must THEN NULL ELSE {{'c': v2.c + cut + 2, 's': 'R' || v2.s}} END, CASE WHEN NOT must AND ini = 'u' THEN {{'c': v2.c + cut, 's': 'K' || v2.s}} END) AS b1,
      least({{'c': v2.c + 3, 's': 'D' || v2.s}}, CASE WHEN must THEN NULL ELSE {{'c': v3.c + cut + 2, 's': 'R' || v3.s}} END, CASE WHEN NOT must AND ini = 'a' THEN {{'c': v3.c + cut, 's': 'K' || v3.s}} END) AS b2,
      least({{'c': v3.c + 3, 's': 'D' || v3.s}}, CASE WHEN must THEN NULL ELSE {{'c': v2.c + cut + 2, 's': 'R' || v2.s}} END, CASE WHEN NOT must AND ini = 'u' THEN {{'c': v2.c + cut, 's': 'K' || v2.s}} END) AS b3
    FROM best b JOIN rows_of r ON b.c = r.c AND r.i = b.i - 1))),
found AS (SELECT c, v0.c AS cost, v0.s AS audit FROM best WHERE i = 1),
letters AS (SELECT c, unnest(string_split(audit, '')) AS e, generate_subscripts(string_split(audit, ''), 1) AS k FROM found WHERE audit <> ''),
walked AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS m FROM letters WINDOW w AS (PARTITION BY c ORDER BY k)),
kept AS (SELECT w.*, p.role, p.text, CASE WHEN w.e = 'K' AND w.m = 1 AND p.role[1] = 's' THEN 1 ELSE 0 END AS sys FROM walked w LEFT JOIN placed p ON p.c = w.c AND p.i = w.i AND w.e <> 'I' WHERE w.e <> 'D'),
shifted AS (SELECT *, max(sys) OVER (PARTITION BY c) AS lead FROM kept),
texts AS (
  SELECT c, string_agg(CASE WHEN e = 'K' THEN role WHEN (m + lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS body FROM shifted GROUP BY 1)
SELECT n.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM named n LEFT JOIN counts USING (c) LEFT JOIN found USING (c) LEFT JOIN texts USING (c)
"""
