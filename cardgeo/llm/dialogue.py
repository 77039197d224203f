"""Conversation structure repair: cheapest edits, as one sorted stream.

The rows of a conversation, by turn, are edited into ``s? (ua)+`` or nothing:
Keep 0, Rerole to user or assistant 3, Delete 4, Insert an empty user or
assistant row 3; a truncated row that stays adds 3; blank and duplicate rows
must go. Which initial a rerole or an insert makes follows from its place, so
the string of edits says everything.

Secondary-sorted streaming: rows are repartitioned by conversation and sorted
by turn, and ``mapInPandas`` carries, across Arrow batches, the state of a
dynamic program over four positions of the pattern: its cost and the rank of
its edits among the others'. Differences of cost are bounded, so such states
are few: each is met once and its transitions are kept in a table. Only back-
pointers grow with a conversation, four bytes a row; every ``CHUNK`` of them
leaves the task as an output row (a written table under the shared folder,
never a local file), and a second stream walks giant conversations' chunks
backwards. Texts never enter the first stream; the second applies the edits to
the texts as they pass, so memory is bounded by the edits' string, whose
length the result itself has.

A conversation is one sequence (its digest is of one ordered text), so one
task reads it from end to end, however long; nothing of it is held but the
above. Repeated texts are counted by (conversation, digest) with partial
aggregates before, not in the stream.

Defined results: a null role or text is one space (so a null text is blank);
rows without a turn come first; rows of one turn go by role, then text; a null
conversation id is a conversation like any other; turns' gaps wrap modulo
2 ** 64. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_batches

#: White space of the word rule, and what ends a whole sentence.
SPACE = "\x20\t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LEGAL = frozenset({"su", "ua", "au"})
#: Places in the pattern: nothing yet, after s, after u, after a; where each
#: role initial leads from them, and the rows still missing at the end.
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
MISSING = (0, 2, 1, 0)
ROLE = {"s": "system", "u": "user", "a": "assistant"}
NO_WAY = 255
#: From any place the rest of a conversation costs at most so much more than
#: from any other: delete a kept system row (4), insert two rows (6).
FARTHEST = DELETE + 2 * INSERT
#: Backpointers (four bytes each) of one output row.
CHUNK = 1 << 18
FAULTS = ("", "blank", "duplicate", "truncated")


# ----------------------------------------------------------- rows and keys


def conversation_key(conv: Column) -> Column:
    """A text key that tells a null id from every other one."""
    return F.when(conv.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), conv.cast("string")))


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return df.select(conversation_key(F.col(conv)).alias("k"), F.col(turn).isNotNull().alias("has"),
                     F.coalesce(F.col(turn), F.lit(0)).cast("long").alias("turn"),
                     space(role).alias("role"), space(text).alias("text"))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """``rows`` with planted faults, dealt by crc32(``conv:turn``) modulo 20:
    0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats
    it, 4 makes it a user's. Nulls count as one space."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = rows.select(conv, turn, F.coalesce(F.col(role), F.lit(" ")).alias(role),
                        F.coalesce(F.col(text), F.lit(" ")).alias(text),
                        (F.crc32(F.concat(name(conv), F.lit(":"), name(turn))) % 20).alias("__d"))
    d = F.col("__d")
    copies = F.when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (dealt.where(d != 0).select(
        conv, turn, F.when(d == 4, F.lit(ROLE["u"])).otherwise(F.col(role)).alias(role),
        F.when(d == 1, F.lit("")).when(d == 2, F.regexp_replace(text, f"[{ENDS}]", ""))
        .otherwise(F.col(text)).alias(text), F.explode(copies).alias("__d")).drop("__d"))


def _features(rows: DataFrame) -> DataFrame:
    """What the stream needs of each row, in its order: no texts."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    seen = rows.select("*", digest.alias("digest"))
    place = F.struct("has", "turn")  # false, i.e. no turn, comes first
    again = materialize(seen.groupBy("k", "digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                        .where("first < last").drop("last"), "op11-repeats")
    stripped = F.rtrim("text", F.lit(SPACE))
    fault = (F.when(stripped == "", 1).when(place > F.col("first"), 2)
             .when(~F.right(stripped, F.lit(1)).isin(*ENDS), 3).otherwise(0))
    return (seen.join(again, ["k", "digest"], "left")
            .repartition("k").sortWithinPartitions("k", "has", "turn", "role", "text")
            .select("k", "has", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "digest"))


# -------------------------------------------------------- the dynamic program


class Program:
    """States of the dynamic program and their transitions, each made once.

    A state is, for every place in the pattern, (cost above the least, rank of
    the edits among the places') or None, where no edits lead there or they
    cost over ``FARTHEST`` more than the least and cannot win any more. So
    there are few states. Edits up to a row boundary end in that row's edit (an
    insert belongs to the row after it), so none begins another and ranks
    decide every later comparison.
    """

    def __init__(self):
        self.states = [((0, 0), None, None, None)]
        self.ids = {self.states[0]: 0}
        self.table: dict[tuple[int, str, int], tuple[int, int, int]] = {}

    def step(self, state: int, initial: str, fault: int) -> tuple[int, int, int]:
        """``(state, added cost, packed backpointers)`` after a row."""
        key = (state, initial if initial in ROLE else "", fault)
        done = self.table.get(key)
        if done is None:
            done = self.table[key] = self._step(self.states[state], *key[1:])
        return done

    def _step(self, old, initial: str, fault: int):
        ways: list[list] = [[], [], [], []]
        for place, held in enumerate(old):
            if held is None:
                continue
            cost, rank = held
            for n in range(3):  # a third insert only repeats the first's place
                at = place
                for _ in range(n):
                    at = AFTER[at].get("u") or AFTER[at]["a"]
                here = cost + INSERT * n
                ways[at].append((here + DELETE, rank, "I" * n + "D", place, n, 0))
                if fault in (1, 2):
                    continue
                stay = here + (TRUNCATED if fault == 3 else 0)
                if initial in AFTER[at]:
                    ways[AFTER[at][initial]].append((stay + KEEP, rank, "I" * n + "K", place, n, 1))
                made = AFTER[at].get("u") or AFTER[at]["a"]
                ways[made].append((stay + REROLE, rank, "I" * n + "R", place, n, 2))
        best = [min(w) if w else None for w in ways]
        least = min(b[0] for b in best if b)
        best = [b if b and b[0] <= least + FARTHEST else None for b in best]
        order = {k: i for i, k in enumerate(sorted(b[1:3] for b in best if b))}
        new = tuple((b[0] - least, order[b[1:3]]) if b else None for b in best)
        packed = 0
        for place, b in enumerate(best):
            packed |= (b[3] | b[4] << 2 | b[5] << 4 if b else NO_WAY) << 8 * place
        if new not in self.ids:
            self.ids[new] = len(self.states)
            self.states.append(new)
        return self.ids[new], least, packed

    def finish(self, state: int) -> tuple[int, int]:
        """``(added cost, place)`` of the best end, with the rows missing there."""
        cost, _, place = min((held[0] + INSERT * MISSING[p], held[1], p)
                             for p, held in enumerate(self.states[state]) if held)
        return cost, place


def walk_back(back: Iterable[int], place: int) -> tuple[str, int]:
    """The edits that the backpointers ``back`` (in row order) lead to from
    ``place``, and the place before them."""
    out = []
    for packed in reversed(back):
        b = packed >> 8 * place & 255
        out.append("DKR"[b >> 4] + "I" * (b >> 2 & 3))
        place = b & 3
    return "".join(out)[::-1], place


# ----------------------------------------------------------------- streams

_PLAN = ("k string, part long, last boolean, place int, back binary, audit string, gaps long, blank long, duplicate long, "
         "truncated long, illegal long, cost long")


class _Conversation:
    """What the stream holds of the conversation that it is in."""

    def __init__(self, key):
        self.key, self.part, self.back = key, 0, array("I")
        self.state = self.cost = self.illegal = self.turns = 0
        self.low = self.high = self.before = self.last = None
        self.faults = [0, 0, 0, 0]

    def row(self, program, has, turn, initial, fault, digest):
        if fault == 0 or fault == 3:  # a repeat in the same turn comes next to its original
            if (has, turn, digest) == self.last:
                fault = 2
        self.last = (has, turn, digest)
        self.faults[fault] += 1
        if has and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.state, cost, packed = program.step(self.state, initial, fault)
        self.cost += cost
        self.back.append(packed)

    def spill(self):
        out = (self.key, self.part, False, None, self.back.tobytes(), *[None] * 7)
        self.part, self.back = self.part + 1, array("I")
        return out

    def end(self, program):
        cost, place = program.finish(self.state)
        audit = None
        if self.part == 0:
            audit = walk_back(self.back, place)[0] + "I" * MISSING[place]
        gaps = 0 if self.turns == 0 else (self.high - self.low + 1 - self.turns + 2 ** 63) % 2 ** 64 - 2 ** 63
        return (self.key, self.part, True, place, None if audit is not None else self.back.tobytes(), audit, gaps,
                *self.faults[1:], self.illegal, self.cost + cost)


def _frame(rows: list, schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")], dtype=object)


def _plan_stream(chunk: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        program, now = Program(), None
        for batch in batches:
            out = []
            for key, *row in zip(*(batch[c].tolist() for c in ("k", "has", "turn", "initial", "fault", "digest"))):
                if now is None or key != now.key:
                    if now is not None:
                        out.append(now.end(program))
                    now = _Conversation(key)
                now.row(program, *row)
                if len(now.back) >= chunk:
                    out.append(now.spill())
            if out:
                yield _frame(out, _PLAN)
        if now is not None:
            yield _frame([now.end(program)], _PLAN)

    return run


def _walk_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    place = None
    for batch in batches:
        out = []
        for key, part, last, end, back in zip(*(batch[c].tolist() for c in ("k", "part", "last", "place", "back"))):
            tail = ""
            if last:
                place = int(end)
                tail = "I" * MISSING[place]
            edits, place = walk_back(array("I", bytes(back)), place)
            out.append((key, part, edits + tail))
        yield _frame(out, "k string, part long, piece string")


def plan_repairs(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 *, chunk: int = CHUNK) -> DataFrame:
    """Per conversation (``k``: :func:`conversation_key`): gaps between turns,
    first faults, illegal neighbours, the least cost and ``audit``, the
    ASCII-least of the cheapest edits. ``chunk``: backpointers held in memory."""
    parts = materialize(_features(_rows(rows, conv, turn, role, text)).mapInPandas(_plan_stream(chunk), _PLAN),
                        "op11-plans")
    whole = parts.where("audit is not null").drop("part", "last", "place", "back")
    chunks = parts.where("audit is null")
    pieces = (chunks.select("k", "part", "last", "place", "back").repartition("k")
              .sortWithinPartitions("k", F.col("part").desc())
              .mapInPandas(_walk_stream, "k string, part long, piece string"))
    listed = F.array_sort(F.collect_list(F.struct("part", "piece")))
    audits = pieces.groupBy("k").agg(F.array_join(F.transform(listed, lambda x: x["piece"]), "").alias("audit"))
    giant = chunks.where("last").drop("part", "last", "place", "back", "audit").join(audits, "k")
    return whole.unionByName(giant)


_MESSAGE = "k string, position long, edit string, role string, text string"


def _apply_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, audit, at, place, position = None, "", 0, 0, 0
    for batch in batches:
        out = []

        def emit(edit, role, text):
            nonlocal position
            out.append((key, position, edit, role, text))
            position += 1

        def inserts():
            nonlocal at, place
            while at < len(audit) and audit[at] == "I":
                made = "u" if "u" in AFTER[place] else "a"
                place, at = AFTER[place][made], at + 1
                emit("I", ROLE[made], "")

        for k, edits, role, text in zip(*(batch[c].tolist() for c in ("k", "audit", "role", "text"))):
            if k != key:  # a conversation begins with its edits
                inserts()
                key, audit, at, place, position = k, edits, 0, 0, 0
                continue
            inserts()
            edit = audit[at]
            at += 1
            if edit == "K":
                place = AFTER[place][role[:1]]
                emit("K", role, text)
            elif edit == "R":
                made = "u" if "u" in AFTER[place] else "a"
                place = AFTER[place][made]
                emit("R", ROLE[made], text)
        if out:
            yield _frame(out, _MESSAGE)
    out = []
    while at < len(audit):  # only inserts are left
        made = "u" if "u" in AFTER[place] else "a"
        place, at = AFTER[place][made], at + 1
        out.append((key, position, "I", ROLE[made], ""))
        position += 1
    if out:
        yield _frame(out, _MESSAGE)


def repaired(rows: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """The repaired messages ``(k, position, edit, role, text)``: ``plans``
    applied to the rows that they were made of. A conversation's messages are
    in order within one partition."""
    none = lambda t: F.lit(None).cast(t)
    edits = plans.select("k", F.lit(0).alias("ord"), F.lit(False).alias("has"), F.lit(0).cast("long").alias("turn"),
                         none("string").alias("role"), none("string").alias("text"), "audit")
    both = edits.unionByName(_rows(rows, conv, turn, role, text).select(
        "*", F.lit(1).alias("ord"), none("string").alias("audit")))
    return (text_batches(both).repartition("k").sortWithinPartitions("k", "ord", "has", "turn", "role", "text")
            .select("k", "audit", "role", "text").mapInPandas(_apply_stream, _MESSAGE))


def _digest_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, digest = None, None
    for batch in batches:
        out = []
        for k, role, text in zip(*(batch[c].tolist() for c in ("k", "role", "text"))):
            if k != key:
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if out:
            yield _frame(out, "k string, sha256 string")
    if digest:
        yield _frame([(key, digest.hexdigest())], "k string, sha256 string")


def digests(messages: DataFrame) -> DataFrame:
    """sha256 of each conversation's ``role:text`` lines, from the ordered
    partitions of :func:`repaired`."""
    return messages.select("k", "role", "text").mapInPandas(_digest_stream, "k string, sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of ``conversations``: the plan of its rows in
    ``rows`` and the digest of what the plan makes of them (of no text, if
    nothing is left)."""
    plans = materialize(plan_repairs(rows, chunk=chunk), "op11-report")
    found = digests(repaired(rows, plans))
    ids = conversations.groupBy("conv_id").agg(F.lit(1).alias("__one")).select(
        "conv_id", conversation_key(F.col("conv_id")).alias("k"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (ids.join(plans, "k", "left").join(found, "k", "left").select(
        "conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))
