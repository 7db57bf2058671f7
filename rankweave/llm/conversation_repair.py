"""Conversation structure repair by iterative-deepening A*.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles: an
optional system turn, then pairs of user and assistant turns. Rows are damaged
(dropped, emptied, cut, repeated, re-roled) by a fixed rule, then each
conversation is repaired by the cheapest script of edits:

- ``K`` keep a row (0), ``R`` give it the role user or assistant (3),
  ``D`` delete it (4; required for blank and duplicate rows),
  ``I`` insert an empty user or assistant row anywhere (3);
  a truncated row that is not deleted adds 3.

Of scripts of equal cost the ASCII-least wins (``D`` < ``I`` < ``K`` < ``R``).
The search is a depth-first search in that edit order under increasing cost
bounds; a table keeps, per (row, automaton state), the lower bound of the cost
to finish that a failed search proved, so no state is searched twice for a
budget it cannot meet. The first script that the search accepts is the answer.

Spark damages the rows, flags blank and cut rows with built-in functions and
deals conversations by ``conv_id``; a conversation is searched in one task
(its rows in order are what the search walks, and its digest is one hash over
them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: costs, role names and the accepted language.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
USER, ASSISTANT, SYSTEM = "user", "assistant", "system"
LEGAL_PAIRS = ("su", "ua", "au")
SPACE = "\\x20\\x09-\\x0D"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

# Row faults, the first that holds counts.
NONE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
# Automaton of (s?(ua)+)?: 0 start, 1 after s, 2 after u, 3 after a.
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ACCEPT = (0, 3)
# The role that an inserted or re-roled row takes in each state.
_WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
_ROLE = {"u": USER, "a": ASSISTANT}

RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage, keyed ``_c``, with ``_dropped`` rows kept as markers.

    Null conv_id, turn, role and text read as one space; the damage is chosen
    by crc32 of ``conv_id:turn`` mod 20: 0 drops the row, 1 empties its text,
    2 removes its ``.!?``, 3 repeats it (same turn), 4 makes it a user row.
    A dropped row stays as a marker so that its conversation is still reported.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    kind = F.crc32(key.cast("binary")) % 20
    role = F.coalesce(F.col("role"), space)
    text = F.coalesce(F.col("text"), space)
    rows = conversations.select(
        F.col("conv_id").alias("_c"),
        F.col("turn").alias("_turn"),
        (kind == 0).alias("_dropped"),
        F.when(kind == 4, F.lit(USER)).otherwise(role).alias("_role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("_text"),
        F.when(kind == 3, 2).otherwise(1).alias("_copies"),
    )
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copies", "_copy")
    blank = ~F.col("_text").rlike(f"[^{SPACE}]")
    last = F.regexp_extract("_text", f"([^{SPACE}])[{SPACE}]*$", 1)
    return rows.withColumns({"_blank": blank, "_cut": ~blank & ~last.isin(".", "!", "?")})


def repair(conversations: DataFrame) -> DataFrame:
    """One row per original conv_id (null included) with its faults, cost, audit and digest.

    Rows are ordered by turn (nulls first), ties by role and text. ``gaps`` is
    maxTurn - minTurn + 1 - distinct turns over non-null turns (0 if none).
    A conversation with no rows after damage has zeros, an empty audit and the
    SHA-256 of the empty string; so has one whose rows are all deleted, but
    with its cost and audit. Extra input columns are ignored.
    """
    rows = damaged(conversations)
    return rows.groupBy("_c").applyInArrow(_repaired_group, RESULT)


def _repaired_group(key: tuple, rows: pa.Table) -> pa.Table:
    conv_id = key[0].as_py()
    turn, dropped, role, text, blank, cut = (rows.column(c).to_pylist() for c in ("_turn", "_dropped", "_role", "_text", "_blank", "_cut"))
    live = [i for i, gone in enumerate(dropped) if not gone]
    if not live:
        return _result(conv_id, 0, [0, 0, 0], 0, 0, "", EMPTY_SHA256)
    # By turn, nulls first; ties by role and text.
    live.sort(key=lambda i: (turn[i] is not None, turn[i] or 0, role[i], text[i]))
    roles, texts = [role[i] for i in live], [text[i] for i in live]
    faults = row_faults(roles, texts, [blank[i] for i in live], [cut[i] for i in live])
    turns = [turn[i] for i in live if turn[i] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
    cost, script = cheapest_script(initials, faults)
    lines, at = [], 0
    for letter, new_role in script:
        if letter == "I":
            lines.append(f"{_ROLE[new_role]}:")
            continue
        if letter == "K":
            lines.append(f"{roles[at]}:{texts[at]}")
        elif letter == "R":
            lines.append(f"{_ROLE[new_role]}:{texts[at]}")
        at += 1
    digest = hashlib.sha256("\n".join(lines).encode("utf-8")).hexdigest()
    counts = [sum(f == kind for f in faults) for kind in (BLANK, DUPLICATE, CUT)]
    audit = "".join(letter for letter, _ in script)
    return _result(conv_id, gaps, counts, illegal, cost, audit, digest)


def _result(conv_id, gaps, counts, illegal, cost, audit, digest) -> pa.Table:
    values = [conv_id, gaps, *counts, illegal, cost, audit, digest]
    return pa.table({name: pa.array([v], kind) for name, v, kind in zip(RESULT_COLUMNS, values, _TYPES)})


RESULT_COLUMNS = [part.split()[0] for part in RESULT.split(", ")]
_TYPES = [pa.int64()] * 7 + [pa.string(), pa.string()]


def row_faults(roles: list[str], texts: list[str], blank: list[bool], cut: list[bool]) -> list[int]:
    """First fault of each row: blank, duplicate (role and text seen before), truncated."""
    seen, out = set(), []
    for role, text, is_blank, is_cut in zip(roles, texts, blank, cut):
        pair = (role, text)
        out.append(BLANK if is_blank else DUPLICATE if pair in seen else CUT if is_cut else NONE)
        seen.add(pair)
    return out


def _moves(i: int, state: int, initials: list[str], faults: list[int]) -> list[tuple[str, int, int, int, str]]:
    """Edits at row i in ASCII order: (letter, cost, next row, next state, role initial)."""
    out = []
    n = len(initials)
    wanted = _WANTED[state]
    if i < n:
        out.append(("D", DELETE, i + 1, state, ""))
    out.append(("I", INSERT, i, _STEP[state, wanted], wanted))
    if i < n and faults[i] not in (BLANK, DUPLICATE):
        extra = TRUNCATED if faults[i] == CUT else 0
        kept = _STEP.get((state, initials[i]))
        if kept is not None:
            out.append(("K", KEEP + extra, i + 1, kept, initials[i]))
        out.append(("R", REROLE + extra, i + 1, _STEP[state, wanted], wanted))
    return out


def cheapest_script(initials: list[str], faults: list[int]) -> tuple[int, list[tuple[str, str]]]:
    """Cost and edits (letter, role initial) of the ASCII-least cheapest repair.

    Iterative-deepening A*: the bound starts at the admissible estimate of the
    start and rises to the least estimate that a search went beyond. ``known``
    holds, per (row, state), a proven lower bound of the cost to finish; a
    state whose bound exceeds the budget left is not entered again.
    """
    n = len(initials)
    forced = np.array([DELETE if f in (BLANK, DUPLICATE) else TRUNCATED if f == CUT else 0 for f in faults] + [0])
    after = np.cumsum(forced[::-1])[::-1]
    usable = np.cumsum(np.array([f not in (BLANK, DUPLICATE) for f in faults] + [False])[::-1])[::-1]

    def estimate(i: int, state: int) -> int:
        short = INSERT if state not in _ACCEPT and usable[i] == 0 else 0
        return int(after[i]) + short

    known: dict[tuple[int, int], int] = {}
    bound = estimate(0, 0)
    while True:
        found, least = _bounded_search(bound, n, initials, faults, estimate, known)
        if found is not None:
            return bound, found
        bound = least


def _bounded_search(bound, n, initials, faults, estimate, known):
    """Depth-first search of scripts within ``bound``; (script, None) or (None, next bound)."""
    inf = float("inf")
    # Frame: row, state, cost so far, moves, next move, least bound of its subtree.
    stack = [[0, 0, 0, None, 0, inf]]
    path: list[tuple[str, str]] = []
    returned = None
    while stack:
        frame = stack[-1]
        i, state, spent, moves, k, least = frame
        if returned is not None:
            step_cost = moves[k - 1][1]
            frame[5] = least = min(least, step_cost + returned)
            returned = None
            path.pop()
        if moves is None:
            lower = max(estimate(i, state), known.get((i, state), 0))
            if spent + lower > bound:
                returned = lower
                stack.pop()
                continue
            if i == n and state in _ACCEPT:
                return list(path), None
            frame[3] = moves = _moves(i, state, initials, faults)
        if k < len(moves):
            letter, cost, i2, state2, role = moves[k]
            frame[4] = k + 1
            path.append((letter, role))
            stack.append([i2, state2, spent + cost, None, 0, inf])
            continue
        known[(i, state)] = max(known.get((i, state), 0), int(least))
        returned = least
        stack.pop()
    return None, int(returned)
