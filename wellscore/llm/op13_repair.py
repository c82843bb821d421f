"""Conversation structure repair by iterative-deepening A*.

A conversation is sound if the initials of its roles, in order of turns, are an optional system
turn and pairs of user and assistant turns: `(s?(ua)+)?`. `repair` finds the cheapest edits that
make it so: D deletes a turn, I inserts an empty one, K keeps one and R gives one the role that is
due; of equally cheap edits the least in ASCII order. It searches depth first in that order under a
cost bound, which starts at what the faults alone cost and rises to the least sum that exceeded it.
A transposition table holds, for every state (turn, last role) whose search failed, the least
that is known to be left to pay from there; so the first accepting path is the answer.

Turns are dealt by ranges of (conv_id, turn, role, sha256 of the text), so that a conversation of any
length is spread over tasks. A conversation that lies within one range in at most `chunk` turns is
repaired there. Others are cut into chunks: each is searched from every role that may come before
it to every one that may be its last, the cheapest sequence of these is chosen per
conversation from 16 costs and 16 ranks a chunk, and the chosen edits are applied chunk by
chunk. Only the hash of the repaired conversation has to see its texts one after the other; it does
so as a stream.

Edge cases: a null role or text is one space, a null conv_id or turn is one in the damage's
hash; rows without a conv_id are one conversation; turns sort nulls first, equal ones by role and
sha256 of the text, so repeated rows are duplicates; a conversation without rows after the damage
has zeros, no edits and the hash of the empty string; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wellscore.llm.common import table_rows, written

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
CHUNK = 16

#: The last role so far: none, system, user or assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: What can follow: the last role after a turn that is due, and after a kept turn by its initial.
DUE = (USER, USER, ASSISTANT, USER)
KEPT = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (NONE, ASSISTANT)
#: Edits that close a conversation after its last turn.
CLOSING = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 30
#: The last roles that edits can lead to: no turn takes a conversation back to its beginning.
ONWARD = ({NONE, SYSTEM, USER, ASSISTANT}, {SYSTEM, USER, ASSISTANT}, {USER, ASSISTANT}, {USER, ASSISTANT})

# A turn for the search: (initial of its role, fault).
SOUND, CUT, GONE = 0, 1, 2


def repair(turns: Sequence[tuple[str, int]], start: int = NONE, ends: tuple[int, ...] = ENDS, close: bool = True) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest repair that leads from last role `start` to one of `ends`.

    close: whether turns may be inserted after the last one. None: there is no such repair."""
    n = len(turns)
    least = [0] * (n + 1)  # every fault left has to be paid
    for i in range(n - 1, -1, -1):
        initial, fault = turns[i]
        least[i] = least[i + 1] + (DELETE if fault else 0 if initial in ("s", "u", "a") else REROLE)
    owed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    open_to = [not ONWARD[q].isdisjoint(ends) for q in range(4)]

    def visit(i: int, q: int, left: int) -> bool:
        if i == n and q in ends:
            return True
        steps = []
        due = DUE[q]
        if i < n:
            initial, fault = turns[i]
            steps.append(("D", DELETE, i + 1, q))
            if open_to[due]:
                steps.append(("I", INSERT, i, due))
            if fault != GONE:
                extra = TRUNCATED if fault else 0
                kept = KEPT.get((q, initial))
                if kept is not None and open_to[kept]:
                    steps.append(("K", extra, i + 1, kept))
                if open_to[due]:
                    steps.append(("R", extra + REROLE, i + 1, due))
        elif close and open_to[due]:
            steps.append(("I", INSERT, i, due))
        owed[i, q] = left + 1  # to come back here by insertions can't pay
        rest = NEVER
        for edit, cost, j, r in steps:
            need = cost + owed.get((j, r), least[j])
            if need <= left:
                path.append(edit)
                if visit(j, r, left - cost):
                    return True
                path.pop()
                need = cost + owed[j, r]
            rest = min(rest, need)
        owed[i, q] = rest
        return False

    bound, most = least[0], (DELETE + TRUNCATED) * n + 4 * INSERT
    while bound <= most:
        if visit(0, start, bound):
            return bound, "".join(path)
        bound = owed[0, start]
    return None


def all_repairs(turns: Sequence[tuple[str, int]]) -> tuple[list[int], list[int], list[str]]:
    """Cost, rank among equal starts and edits from every last role (4 * start) to every other, of a chunk."""
    costs, ranks, edits = [-1] * 16, [0] * 16, [""] * 16
    for q in range(4):
        for r in range(4):
            if r in ONWARD[q]:
                got = (0, "") if not turns and q == r else repair(turns, q, (r,), False) if turns else None
                if got is not None:
                    costs[4 * q + r], edits[4 * q + r] = got
        for place, (_, r) in enumerate(sorted((edits[4 * q + r], r) for r in range(4))):
            ranks[4 * q + r] = place
    return costs, ranks, edits


def choose(costs: list[list[int]], ranks: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
    """The cost of a conversation in chunks, and the last role before and after each chunk.

    Edits of a chunk end with one of its turns, so none is the beginning of another and the least
    of the first chunk decides, then of the second, and so on."""
    to_pay = [[INSERT * len(CLOSING[q]) for q in range(4)]]
    for c in reversed(costs):
        to_pay.append([min((c[4 * q + r] + to_pay[-1][r] for r in range(4) if c[4 * q + r] >= 0), default=NEVER) for q in range(4)])
    to_pay.reverse()
    q, way = NONE, []
    for k, (c, rank) in enumerate(zip(costs, ranks, strict=True)):
        fits = [r for r in range(4) if c[4 * q + r] >= 0 and c[4 * q + r] + to_pay[k + 1][r] == to_pay[k][q]]
        r = min(fits, key=lambda r: rank[4 * q + r])
        way.append((q, r))
        q = r
    return to_pay[0][NONE], way


def applied(turns: list[tuple[str, str]], edits: str, q: int = NONE) -> list[str]:
    """The repaired turns as `role:text`; turns are (role, text)."""
    out, rows = [], iter(turns)
    for e in edits:
        role, text = next(rows) if e != "I" else ("", "")
        if e == "D":
            continue
        if e == "K":
            q = KEPT[q, role[:1]]
        else:
            q = DUE[q]
            role = NAMES[q]
        out.append(f"{role}:{text}")
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, uid, lost): every row after its damage; lost rows stay as a mark of their conversation."""
    c = table_rows(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    blank = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    c = c.withColumn("hit", F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20)
    text = F.when(F.col("hit") == 0, F.lit("")).when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    role = F.when(F.col("hit") == 4, F.lit("user")).otherwise(blank("role"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return c.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("hit") == 0).alias("lost"), copies.alias("copy")).drop("copy").withColumn("uid", F.monotonically_increasing_id())


def repeats(rows: DataFrame) -> DataFrame:
    """The rows (without texts) whose role and text come earlier in their conversation.

    rows: conv_id, turn, role, digest, uid. First ones are found by a grouped minimum."""
    first = rows.groupBy("conv_id", "role", "digest").agg(F.count("*").alias("n"), F.min(F.struct("turn", "uid")).alias("first")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    both = rows.join(first, rows.conv_id.eqNullSafe(F.col("c")) & (rows.role == F.col("r")) & (rows.digest == F.col("d")))
    return both.filter("uid <> first.uid").select("conv_id", "turn", "role", "digest", "uid")


TOTALS = ["n_rows", "blank", "duplicate", "truncated", "illegal"]


def repaired(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text, uid, lost): what was wrong, the edits, their cost and the result's hash."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    solid = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(F.col("lost"), F.lit("lost")).when(solid == "", F.lit("blank")).when(~F.substring(solid, -1, 1).isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit(""))
    rows = rows.withColumn("fault", fault)
    keys = ["conv_id", "turn", "role", "digest", "uid"]
    again = repeats(rows.filter("fault IN ('truncated', '')").select(*keys))
    marks = again.select(*keys, F.lit(None).cast("string").alias("text"), F.lit("duplicate").alias("fault"))
    both = rows.select(*keys, "text", "fault").unionByName(marks).withColumn("mark", F.col("fault") != "duplicate")
    order = [F.asc_nulls_first(k) for k in keys]
    dealt = both.repartitionByRange(*order).sortWithinPartitions(*order, "mark").select("conv_id", "turn", "role", "text", "fault")

    def chunks(batches):
        """A closed conversation's results, or one row per chunk of an open one."""
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        known_repair = lru_cache(1 << 16)(repair)  # short conversations have the same roles and faults again and again

        def turns():
            mark = False
            for b in batches:
                for r in b.to_pylist():
                    if r["fault"] == "duplicate":
                        mark = True
                        continue
                    yield r | ({"fault": "duplicate"} if mark else {})
                    mark = False

        def pieces():
            """(conv_id, rows, whether the conversation may go on before or after them)."""
            held, before = None, True
            for conv, of in groupby(turns(), key=lambda r: r["conv_id"]):
                if held is not None:
                    yield held, before, False
                    before = False
                held, here = None, []
                for r in of:
                    if len(here) == chunk:
                        yield (conv, here), True, True
                        here, before = [], True
                    if r["fault"] != "lost":
                        here.append(r)
                held = (conv, here)
            if held is not None:
                yield held, before, True

        ready = []
        for seq, ((conv, here), before, after) in enumerate(pieces()):
            search = tuple((r["role"][:1], GONE if r["fault"] in ("blank", "duplicate") else CUT if r["fault"] else SOUND) for r in here)
            known = [r["turn"] for r in here if r["turn"] is not None]
            initials = [s for s, _ in search]
            out = {
                "conv_id": conv, "part": part, "seq": seq, "n_rows": len(here),
                **{f: sum(r["fault"] == f for r in here) for f in ("blank", "duplicate", "truncated")},
                "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
                "first_turn": min(known, default=None), "last_turn": max(known, default=None), "n_turns": len(set(known)),
                "first_initial": initials[0] if here else None, "last_initial": initials[-1] if here else None,
            }
            texts = [(r["role"], r["text"]) for r in here]
            if before or after:
                costs, ranks, edits = all_repairs(search)
                out |= {"costs": costs, "ranks": ranks, "edits": edits, "roles": [r for r, _ in texts], "texts": [t for _, t in texts]}
            else:
                cost, audit = known_repair(search)
                out |= {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(applied(texts, audit)).encode()).hexdigest()}
            ready.append(out)
            if len(ready) == 256 or before or after:
                yield pa.RecordBatch.from_pylist(ready, schema)
                ready = []
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    fields = f"conv_id {kind}, part int, seq int, n_rows long, blank long, duplicate long, truncated long, illegal long, first_turn long, last_turn long, n_turns long"
    fields += ", first_initial string, last_initial string, cost long, audit string, repaired_sha256 string"
    fields += ", costs array<int>, ranks array<int>, edits array<string>, roles array<string>, texts array<string>"
    schema = to_arrow_schema(T.StructType.fromDDL(fields))
    cut = written(dealt.mapInArrow(chunks, fields), "chunks")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    closed = cut.filter("audit IS NOT NULL").select("conv_id", gaps, *TOTALS, "cost", "audit", "repaired_sha256")
    return closed.unionByName(_joined(cut.filter("audit IS NULL").drop("cost", "audit", "repaired_sha256"), kind))


def _joined(cut: DataFrame, kind: str) -> DataFrame:
    """The conversations that were cut into chunks."""

    def way(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "seq"]).reset_index(drop=True)
        cost, steps = choose([list(c) for c in pdf["costs"]], [list(r) for r in pdf["ranks"]])
        sums = {c: int(pdf[c].sum()) for c in TOTALS}
        full = pdf[pdf["n_rows"] > 0]
        seams = zip(full["last_initial"][:-1], full["first_initial"][1:], strict=True)
        sums["illegal"] += sum(a + b not in ("su", "ua", "au") for a, b in seams)
        known = pdf[pdf["n_turns"] > 0]
        lo, hi = [int(x) for x in known["first_turn"]], [int(x) for x in known["last_turn"]]
        distinct = int(known["n_turns"].sum()) - sum(a == b for a, b in zip(hi, lo[1:], strict=False))
        gaps = max(hi) - min(lo) + 1 - distinct if hi else 0
        out = pdf[["part", "seq"]].assign(before=[q for q, _ in steps], after=[r for _, r in steps], last=[False] * (len(pdf) - 1) + [True])
        return out.assign(gaps=gaps, cost=cost, **sums)

    picked = "part int, seq int, before int, after int, last boolean, gaps long, cost long" + "".join(f", {c} long" for c in TOTALS)
    light = cut.select("conv_id", "part", "seq", *TOTALS, F.col("first_turn").cast("decimal(20,0)"), F.col("last_turn").cast("decimal(20,0)"), "n_turns", "first_initial", "last_initial", "costs", "ranks")
    steps = light.groupBy("conv_id").applyInPandas(way, picked)
    chosen = cut.select("conv_id", "part", "seq", "edits", "roles", "texts").join(steps, ["part", "seq"])
    chosen = chosen.withColumn("edits", F.element_at("edits", 4 * F.col("before") + F.col("after") + 1))
    stream = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    fields = f"conv_id {kind}, gaps long" + "".join(f", {c} long" for c in TOTALS) + ", cost long, audit string, repaired_sha256 string"

    def finish(batches):
        rows = (r for b in batches for r in b.to_pylist())
        for conv, of in groupby(rows, key=lambda r: r["conv_id"]):
            sha, audit, begun = hashlib.sha256(), [], False
            for r in of:
                edits = r["edits"] + (CLOSING[r["after"]] if r["last"] else "")
                audit.append(edits)
                for line in applied(list(zip(r["roles"], r["texts"], strict=True)), edits, r["before"]):
                    sha.update(("\n" + line if begun else line).encode())
                    begun = True
            out = {"conv_id": [conv], "gaps": [r["gaps"]], **{c: [r[c]] for c in TOTALS}, "cost": [r["cost"]], "audit": ["".join(audit)], "repaired_sha256": [sha.hexdigest()]}
            yield pa.RecordBatch.from_pydict(out, schema)

    schema = to_arrow_schema(T.StructType.fromDDL(fields))
    return stream.mapInArrow(finish, fields)


def audited(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: the repair of its damaged turns."""
    return repaired(written(damaged(conversations), "damaged"), chunk).drop("n_rows")


def _sql() -> str:
    """The damage, the faults and a shortest path over (turn, last role), turn by turn, in DuckDB SQL."""

    def paid(state: str, cost: int, edits: str) -> str:  # states are cost and edits as one sortable string
        return f"(lpad(CAST(CAST(left({state}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{edits}')"

    def least(*options: str) -> str:
        return f"least({', '.join(options)})"

    def kept(initial: str, state: str) -> str:
        return f"CASE WHEN fault < 2 AND initial = '{initial}' THEN CASE WHEN fault = 1 THEN {paid(state, TRUNCATED, 'K')} ELSE {paid(state, 0, 'K')} END END"

    def changed(state: str) -> str:
        return f"CASE WHEN fault = 0 THEN {paid(state, REROLE, 'R')} WHEN fault = 1 THEN {paid(state, REROLE + TRUNCATED, 'R')} END"

    def gone(state: str) -> str:
        return paid(state, DELETE, "D")

    user = least("u", *[paid(x, INSERT, "I") for x in "nsa"])
    assistant = least("a", paid("u", INSERT, "I"), *[paid(x, 2 * INSERT, "II") for x in "ns"])
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(4294967295, list_reduce(flatten(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(4294967295 AS BIGINT))) % 20 AS hit FROM conversations),
c AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE hit <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, left(role, 1) AS initial, rtrim(text, {white}) AS solid FROM c),
f AS (SELECT *, CASE WHEN solid = '' THEN 3 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 3) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
  count(*) FILTER (WHERE fault = 1) AS truncated, count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows FROM f GROUP BY conv_id),
p(conv_id, i, n, s, u, a) AS (SELECT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM stats UNION ALL
  SELECT conv_id, i, {gone("n")}, {least(gone("s"), kept("s", "n"))},
    {least(gone("v"), *[kept("u", x) for x in ("n", "s", "w")], *[changed(x) for x in ("n", "s", "w")])}, {least(gone("w"), kept("a", "v"), changed("v"))}
  FROM (SELECT p.conv_id, f.i, f.fault, f.initial, n, s, {user} AS v, {assistant} AS w FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1)),
e AS (SELECT p.conv_id, {least("n", "a", paid("u", INSERT, "I"), paid("s", 2 * INSERT, "II"))} AS best FROM p JOIN stats ON stats.conv_id IS NOT DISTINCT FROM p.conv_id AND n_rows = p.i),
x AS (SELECT conv_id, substr(best, 10) AS audit, CAST(left(best, 9) AS BIGINT) AS cost FROM e),
w AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM x),
t AS (SELECT w.*, substr(audit, k, 1) AS edit, k - length(replace(left(audit, k), 'I', '')) AS inserted, length(replace(left(audit, k), 'D', '')) AS place FROM w),
r AS (SELECT t.conv_id, k, edit, place, f.role, f.initial, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text FROM t LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND edit <> 'I' AND f.i = k - inserted WHERE edit <> 'D'),
y AS (SELECT *, place - coalesce(max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 END) OVER (PARTITION BY conv_id), 0) AS due FROM r),
z AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN due % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS whole FROM y GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM d.conv_id
"""


SQL = _sql()
