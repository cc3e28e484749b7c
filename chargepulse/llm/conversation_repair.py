"""Repair of conversation structure by least-cost edits, with Hirschberg's divide and conquer.

A conversation should read ``(system)? (user assistant)+`` or be empty.  Rows are kept (free), given
the other role (3), deleted (4; blank and repeated rows must be) or inserted (3); what is cut off and
stays adds 3.  What matters of the rows so far is one of four states: nothing yet, after a system, a user, or an assistant turn.
Costs of four states run forward from the start and backward from the end and meet in
the middle; the crossing states of least cost go on, each half is solved the same way, and where several crossings
are optimal the left half takes the one of the ASCII-least audit.  So memory is linear in the rows, and no
table of back pointers exists.

Conversations are cut into fragments where the table's global order passes a multiple of ``FRAGMENT`` rows.  A fragment's
cost matrix (four states by four) is what others need of it: backward costs run over a conversation's
matrices, then every fragment says where it leads from each state, then start states run forward, and the
fragments are solved on their own.  A conversation of any length is thus shared between tasks; only its text digest is a sequence, read as a stream.

From one state an edit leads to one state, so audits of equal cost between the same states are never prefixes of
each other, and the least one is found edit by edit.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargepulse.llm.common import fingerprint, slices, table, trimmed
from chargepulse.llm.sql import CRC_TABLE, crc32_of
from chargepulse.operators.rank import ranked
from chargepulse.session import stored

FRAGMENT = 1024
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
NONE = 1 << 60                      # no way

# States, costs and roles.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
RETYPE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
ROLE = {USER: "user", ASSISTANT: "assistant"}
CUT, BLANK, DUPLICATE = 4, 8, 9     # kinds of rows: 0-3 for s, u, a, other, plus CUT if cut off; from BLANK on they must go
FINISH = [0, 2 * INSERT, INSERT, 0]  # from each state to a right end


# ---- the automaton -------------------------------------------------------------------

def _next(state: int) -> int:
    """The state after a user or assistant turn that is made to fit."""
    return ASSISTANT if state == USER else USER


def _kept(kind: int, state: int) -> int | None:
    """The state after a row that is kept as it is."""
    initial = kind % 4
    if initial == 0:
        return SYSTEM if state == EMPTY else None
    return _next(state) if initial == _next(state) - 1 and initial < 3 else None


def _choices(kind: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row at a state in ASCII order: letter, cost, next state.  Inserts are apart."""
    out = [("D", DELETE, state)]
    if kind < BLANK:
        extra = CUT_OFF * (kind >= CUT)
        if _kept(kind, state) is not None:
            out.append(("K", extra, _kept(kind, state)))
        out.append(("R", RETYPE + extra, _next(state)))
    return out


def _arrivals(kind: int) -> list[list[tuple[int, int]]]:
    """From each state: (cost, state) after the row, turns inserted before it included."""
    out = []
    for start in range(4):
        best: dict[int, int] = {}
        state = start
        for inserts in range(3):   # a third one is back where the first led
            for _, cost, to in _choices(kind, state):
                best[to] = min(best.get(to, NONE), INSERT * inserts + cost)
            state = _next(state)
        out.append([(c, s) for s, c in best.items()])
    return out


CHOICES = [[_choices(k, s) for s in range(4)] for k in range(DUPLICATE + 1)]
ARRIVALS = [_arrivals(k) for k in range(DUPLICATE + 1)]


def forward(kinds, start: list[int]) -> list[int]:
    """Least costs of being in each state after the rows."""
    now = start
    for k in kinds:
        after = [NONE] * 4
        for cost, ways in zip(now, ARRIVALS[k]):
            if cost < NONE:
                for c, s in ways:
                    if cost + c < after[s]:
                        after[s] = cost + c
        now = after
    return now


def backward(kinds, end: list[int]) -> list[int]:
    """Least costs from each state before the rows, given those after them."""
    now = end
    for k in reversed(kinds):
        now = [min(min(c + now[s] for c, s in ways), NONE) for ways in ARRIVALS[k]]
    return now


def solve(kinds, state: int, end: list[int], out: list[str]) -> int:
    """Appends each row's edits (inserts before it, then its own letter) to ``out``; the state reached.

    ``end`` holds the costs that remain in each state after the rows.
    """
    if len(kinds) == 1:
        left = backward(kinds, end)
        edits = ""
        while True:
            for letter, cost, to in CHOICES[kinds[0]][state]:
                if cost + end[to] == left[state] and (letter == "D" or INSERT + left[_next(state)] != left[state]):
                    out.append(edits + letter)
                    return to
            edits, state = edits + "I", _next(state)
    middle = len(kinds) // 2
    start = [NONE] * 4
    start[state] = 0
    there, rest = forward(kinds[:middle], start), backward(kinds[middle:], end)
    least = min(a + b for a, b in zip(there, rest))
    crossings = [b if a + b == least else NONE for a, b in zip(there, rest)]
    return solve(kinds[middle:], solve(kinds[:middle], state, crossings, out), end, out)


# ---- rows ----------------------------------------------------------------------------

def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by CRC-32 of ``conv_id:turn``; nulls of any column are one space."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = (F.when(F.col("_fate") == 1, F.lit("")).when(F.col("_fate") == 2, F.translate(known("text"), ENDS, ""))
            .otherwise(known("text")))
    return (turns.select("conv_id", "turn", "role", "text", fate.alias("_fate")).where("_fate <> 0")
            .select("conv_id", "turn", F.when(F.col("_fate") == 4, F.lit("user")).otherwise(known("role")).alias("role"),
                    text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("_fate") == 3, 2).otherwise(1))).alias("_copy"))
            .drop("_copy"))


def placed(turns: DataFrame) -> DataFrame:
    """Rows in order: ``conv_id, at`` (global place, from 0), ``turn, role, text, blank, cut``.

    Rows of a conversation go by turn (null first), ties by role and the text's SHA-256; null roles and texts are one
    space.  A null ``conv_id`` is a conversation; further columns are ignored.
    """
    bare = F.rtrim("text", F.lit(SPACE))
    rows = (turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"))
            .withColumns({"blank": bare == "", "cut": ~F.right(bare, F.lit(1)).isin(*ENDS), "_tie": F.sha2("text", 256)}))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("_tie").asc()]
    rows = ranked(rows, order, name="_place")
    return rows.select("conv_id", (F.col("_place") - 1).alias("at"), "turn", "role", "text", "blank", "cut")


def kinds_of(rows: DataFrame) -> DataFrame:
    """``conv_id, at, kind`` of :func:`placed` rows: the role's initial and the first fault.

    Faults are: blank, duplicate (role and text came before in the conversation) and cut off, in this order.
    """
    named = rows.select("conv_id", "at", *fingerprint("role", "text"))
    first = (named.groupBy("conv_id", "fp_a", "fp_b").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_n"))
             .where("_n > 1"))
    again = (named.alias("x").join(first.alias("y"), F.col("x.conv_id").eqNullSafe(F.col("y.conv_id"))
                                   & (F.col("x.fp_a") == F.col("y.fp_a")) & (F.col("x.fp_b") == F.col("y.fp_b")))
             .where("at > _first").select("at", F.lit(True).alias("again")))
    initial = F.substring("role", 1, 1)
    kind = (F.when(F.col("blank"), BLANK).when(F.col("again").isNotNull(), DUPLICATE)
            .otherwise(F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
                       + F.when(F.col("cut"), CUT).otherwise(0)))
    return rows.drop("text", "turn").join(again, "at", "left").select("conv_id", "at", kind.cast("int").alias("kind"))


# ---- edits ---------------------------------------------------------------------------

def _fragments(batches, keys: tuple[str, ...]):
    """(key, rows as tuples of the other columns) of each run of equal keys."""
    now, rows = None, []
    for b in batches:
        others = [n for n in b.schema.names if n not in keys]
        for key, row in zip(zip(*(b.column(k).to_pylist() for k in keys)), zip(*(b.column(n).to_pylist() for n in others))):
            if key != now:
                if rows:
                    yield now, rows
                now, rows = key, []
            rows.append(row)
    if rows:
        yield now, rows


def _batched(rows, schema: pa.Schema, size: int = 1000):
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)


def _python(df: DataFrame, work, schema: str) -> DataFrame:
    """``work(batches)`` yields tuples of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(trimmed(lambda batches: _batched(work(batches), arrow)), schema)


def _matrices(batches):
    """The cost matrix of each fragment, row by row of the state before it."""
    for key, rows in _fragments(batches, ("conv_id", "part")):
        kinds = [r[1] for r in rows]
        yield (*key, [c for s in range(4) for c in forward(kinds, [NONE] * s + [0] + [NONE] * (3 - s))])


def _ends(batches):
    """The costs that remain after each fragment; a conversation's fragments come last first."""
    now, costs = None, FINISH
    for b in batches:
        for conv, part, m in zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "costs"))):
            last = now != (conv,)
            now, costs = (conv,), FINISH if last else costs
            yield conv, part, costs, last
            costs = [min(min(m[4 * s + t] + costs[t] for t in range(4)), NONE) for s in range(4)]


def _leads(batches):
    """Where each fragment leads from every state."""
    for key, rows in _fragments(batches, ("conv_id", "part")):
        end, last, kinds = rows[0][2], rows[0][3], [r[1] for r in rows[1:]]
        left = backward(kinds, end)
        yield (*key, end, last, [solve(kinds, s, end, []) if left[s] < NONE else s for s in range(4)])


def _starts(batches):
    """The state that each fragment starts from; a conversation's fragments come first first."""
    now, state = None, EMPTY
    for b in batches:
        for conv, part, end, last, to in zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "costs", "last", "leads"))):
            if now != (conv,):
                now, state = (conv,), EMPTY
            yield conv, part, state, end, last
            state = to[state]


def _solved(batches):
    """Every row's edits; the last row of a conversation also has the turns inserted after it."""
    for (conv, _), rows in _fragments(batches, ("conv_id", "part")):
        state, end, last = EMPTY, FINISH, True
        if rows[0][0] < 0:
            (_, state, end, last), rows = rows[0], rows[1:]
        kinds, out = [r[1] for r in rows], []
        state = solve(kinds, state, end, out)
        if last:
            out[-1] += "I" * (FINISH[state] // INSERT)
        for r, edit in zip(rows, out):
            yield conv, r[0], r[1], edit


def _together(fragments: DataFrame, more: DataFrame) -> DataFrame:
    """Each fragment's rows after the row that says what it needs; one shuffle, no join."""
    return (fragments.unionByName(more, allowMissingColumns=True).repartition("conv_id", "part")
            .sortWithinPartitions("conv_id", "part", "at"))


def edits(kinds: DataFrame) -> DataFrame:
    """``conv_id, at, kind`` -> the same with ``edit``.

    ``edit`` is what is done up to the row and with it: ``I`` for a turn inserted before it, then ``K``, ``R`` or ``D``;
    the last row of a conversation may have further ``I``.  The edits of a conversation, joined, are its audit.
    """
    kind = kinds.schema["conv_id"].dataType.simpleString()
    codes = stored(kinds.select("conv_id", F.expr(f"at div {FRAGMENT}").alias("part"), "at", "kind"), "repair-kinds")
    # A conversation that goes on where a part of the table begins has several fragments.
    ended = codes.where(F.col("at") % FRAGMENT == FRAGMENT - 1).select("conv_id", (F.col("part") + 1).alias("part"))
    begun = codes.where(F.col("at") % FRAGMENT == 0).select("conv_id", "part")
    both = begun.alias("x").join(ended.alias("y"), (F.col("x.part") == F.col("y.part"))
                                 & F.col("x.conv_id").eqNullSafe(F.col("y.conv_id")))
    long = stored(both.select("x.conv_id").distinct(), "repair-long")
    cut = stored(codes.alias("x").join(long.alias("y"), F.col("x.conv_id").eqNullSafe(F.col("y.conv_id")), "left_semi"), "repair-cut")
    by_part = cut.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "at")
    key = f"conv_id {kind}, part long"
    costs = _python(by_part, _matrices, f"{key}, costs array<long>")
    ends = _python(costs.repartition("conv_id").sortWithinPartitions("conv_id", F.col("part").desc()), _ends,
                   f"{key}, costs array<long>, last boolean").withColumn("at", F.lit(-1).cast("bigint"))
    leads = _python(_together(cut, ends), _leads, f"{key}, costs array<long>, last boolean, leads array<int>")
    starts = stored(_python(leads.repartition("conv_id").sortWithinPartitions("conv_id", "part"), _starts,
                            f"{key}, kind int, costs array<long>, last boolean"), "repair-starts")
    return _python(_together(codes, starts.withColumn("at", F.lit(-1).cast("bigint"))), _solved,
                   f"conv_id {kind}, at long, kind int, edit string")


# ---- results -------------------------------------------------------------------------

def _read(batches, each):
    """Feeds each conversation's rows, in order, to ``each(state, conv_id, row)``, which yields rows; then its state.

    Yields (row, None) and (conv_id, state).
    """
    now, state = None, None
    for whole in batches:
        for b in slices(whole):
            for conv, kind, edit, *row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "kind", "edit", "turn", "role", "text"))):
                if now != (conv,):
                    if now is not None:
                        yield now[0], state
                    now, state = (conv,), {}
                if edit is not None:
                    state["edit"] = (edit, kind)
                else:
                    for x in each(state, conv, *row, *state.pop("edit")):
                        yield x, None
    if now is not None:
        yield now[0], state


def _turns_of(state: dict, role: str, text: str, edit: str):
    """Role and text of the turns that a row's edits leave."""
    at = state.get("at", EMPTY)
    for letter in edit:
        if letter == "K":
            at = SYSTEM if role[:1] == "s" else _next(at)
            yield role, text
        elif letter != "D":
            at = _next(at)
            yield ROLE[at], text if letter == "R" else ""
    state["at"] = at


def _repaired(batches):
    def each(state, conv, turn, role, text, edit, kind):
        for r, t in _turns_of(state, role, text, edit):
            state["n"] = state.get("n", 0) + 1
            yield conv, state["n"], r, t
    return (x for x, state in _read(batches, each) if state is None)


def _digests(batches):
    def each(state, conv, turn, role, text, edit, kind):
        if "sha" not in state:
            state.update(sha=hashlib.sha256(), any=False, audit=[], cost=0, illegal=0, low=None, high=None, distinct=0,
                         blank=0, duplicate=0, truncated=0, before=None)
        for r, t in _turns_of(state, role, text, edit):
            state["sha"].update(("\n" * state["any"] + f"{r}:{t}").encode())
            state["any"] = True
        state["audit"].append(edit)
        own = edit.rstrip("I")[-1]
        state["cost"] += INSERT * edit.count("I") + {"K": 0, "R": RETYPE, "D": DELETE}[own]
        if kind >= CUT:
            state["blank" if kind == BLANK else "duplicate" if kind == DUPLICATE else "truncated"] += 1
            state["cost"] += CUT_OFF * (own != "D")
        if state["before"] is not None:
            state["illegal"] += state["before"] + role[:1] not in ("su", "ua", "au")
        state["before"] = role[:1]
        if turn is not None and turn != state["high"]:
            state["low"] = turn if state["low"] is None else state["low"]
            state["high"], state["distinct"] = turn, state["distinct"] + 1
        return ()
    for conv, s in _read(batches, each):
        gaps = 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["distinct"]
        yield conv, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"], "".join(s["audit"]), s["sha"].hexdigest()


def _stream(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """Each conversation's rows in order, each after its edit: one shuffle of the texts, read as a stream."""
    both = rows.select("conv_id", "at", "turn", "role", "text").unionByName(edited, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "at", F.col("edit").desc())


def repaired_turns(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """``conv_id, place, role, text`` of the repaired conversations (those with nothing left have no row)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _python(_stream(rows, edited), _repaired, f"conv_id {kind}, place long, role string, text string")


def digests(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """Counts, cost, audit and the hash of the repaired turns, one row per conversation that has rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _python(_stream(rows, edited), _digests, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, "
                   "illegal long, cost long, audit string, repaired_sha256 string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows in order and their edits; give both to :func:`repaired_turns` or :func:`digests`."""
    rows = placed(turns)
    return rows, edits(kinds_of(rows))


def op13_conversation_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = digests(*repair(damage(turns)))
    every = turns.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    both = every.join(found, every["conv_id"].eqNullSafe(found["conv_id"]), "left")
    return both.select(every["conv_id"], *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


_BLANK = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"
_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"

ORACLE = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_of(f"({_KEY})")} % 20 AS fate
      FROM conversations, crc),
once AS (SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role, fate,
                CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM c WHERE fate <> 0),
e AS (SELECT conv_id, turn, role, text FROM once UNION ALL SELECT conv_id, turn, role, text FROM once WHERE fate = 3),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM e),
f AS (SELECT *, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
             CASE WHEN NOT regexp_matches(text, '{_BLANK}') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '{_ENDED}') THEN 'truncated' ELSE 'none' END AS fault FROM o),
way(state, symbol, after) AS (VALUES ('E', 's', 'S'), ('E', 'u', 'U'), ('S', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
ins(state, after, made) AS (SELECT state, state, '' FROM (VALUES ('E'), ('S'), ('U'), ('A')) v(state) UNION ALL
  SELECT state, after, 'I' FROM way WHERE symbol <> 's' UNION ALL VALUES ('E', 'A', 'II'), ('S', 'A', 'II')),
best(conv_id, i, state, cost, audit) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 'E', 0::BIGINT, '' FROM f UNION ALL
  SELECT conv_id, i, state, cost, audit FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) AS r FROM (
      SELECT b.conv_id, f.i, x.after AS state, b.cost + 3 * length(ins.made) + x.cost AS cost, b.audit || ins.made || x.letter AS audit
      FROM best b JOIN ins ON ins.state = b.state JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1,
      LATERAL (SELECT 'D' AS letter, 4 AS cost, ins.after AS after
               UNION ALL SELECT 'K', CASE f.fault WHEN 'truncated' THEN 3 ELSE 0 END, way.after FROM way
                 WHERE way.state = ins.after AND way.symbol = f.initial AND f.fault NOT IN ('blank', 'duplicate')
               UNION ALL SELECT 'R', CASE f.fault WHEN 'truncated' THEN 6 ELSE 3 END, way.after FROM way
                 WHERE way.state = ins.after AND way.symbol <> 's' AND f.fault NOT IN ('blank', 'duplicate')) x)) WHERE r = 1),
ends AS (SELECT conv_id, cost, audit FROM (
  SELECT b.conv_id, b.cost + 3 * length(ins.made) AS cost, b.audit || ins.made AS audit,
         row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + 3 * length(ins.made), b.audit || ins.made) AS r
  FROM best b JOIN (SELECT conv_id, max(i) AS n FROM f GROUP BY 1) m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.n = b.i
       JOIN ins ON ins.state = b.state AND ins.after IN ('E', 'A')) WHERE r = 1),
marks AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS p, unnest(string_split(audit, '')) AS letter FROM ends WHERE audit <> ''),
told AS (SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER w AS s
         FROM marks WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
turned AS (SELECT told.conv_id, p, letter, s, f.role, f.text, f.initial FROM told LEFT JOIN f
           ON f.conv_id IS NOT DISTINCT FROM told.conv_id AND f.i = told.i AND told.letter <> 'I' WHERE letter <> 'D'),
lead AS (SELECT conv_id, max(CASE WHEN s = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) AS shift FROM turned GROUP BY 1),
fixed AS (SELECT turned.conv_id, sha256(string_agg(
            CASE WHEN letter = 'K' THEN role WHEN (s - 1 - shift) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':'
            || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS sha
          FROM turned JOIN lead ON lead.conv_id IS NOT DISTINCT FROM turned.conv_id GROUP BY 1),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
SELECT v.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) v LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM v.conv_id
     LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM v.conv_id
"""
