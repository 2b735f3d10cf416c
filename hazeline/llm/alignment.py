"""The cheapest edits that give a sequence of turns an alternating form, by Wagner and Fischer's method.

The form is ``(s?(ua)+)?`` over the initials of roles: nothing, or any number of pairs of user and
assistant with at most one system turn in front. Edits, by initial: Keep 0, Rerole to user or assistant
1, Delete 2, Insert of a user or assistant turn 5. A turn that must go can only be deleted; a truncated
one that stays adds 5. Of equally cheap edits, those whose initials come first in ASCII are taken.

Turns are given as text, one character each: ``s``, ``u``, ``a`` or ``x`` (any other role), in capitals when
the turn is truncated, ``-`` if it must go.

All lengths that a target of one ending can have share one table: the cell (i, j) is the cost of aligning the
last i turns to the last j roles, and those do not depend on the length. A cheap alignment is the
incumbent; cells of no alignment that is as cheap are left out (Ukkonen's band): with L turns that
may stay among the last i, an alignment through (i, j) deletes at least L - j of them or inserts j - L roles.

A long sequence is cut into segments. Within a segment, targets begin and end at any place of the form; the
segments' costs are then added up along the sequence. Each segment ends with the edit of its last turn, so
edits that differ differ before either of them ends, and comparing them segment by segment gives the first in ASCII.
"""

from __future__ import annotations

from functools import lru_cache

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: How far a target has got: nothing yet, behind the system turn, behind a user's, behind an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Turns of a segment.
SEGMENT = 128
_NEVER = 1 << 60


def _next(place: int) -> str:
    return "a" if place == USER else "u"


def _stays(turn: str) -> int:
    return TRUNCATED if turn.isupper() else 0


def _incumbent(turns: str, place: int, end: int) -> int:
    """The cost of some edits that lead from ``place`` to ``end``, or more than any."""
    if end in (START, SYSTEM):
        if place == end:
            return DELETE * len(turns)
        if (place, end) != (START, SYSTEM) or "s" not in turns.lower():
            return _NEVER
        return DELETE * (len(turns) - 1) + (0 if "s" in turns else TRUNCATED)
    cost, at, begun = 0, place, place in (USER, ASSISTANT)
    for turn in turns:
        if turn == "-" or turn.isupper():
            cost += DELETE
            continue
        if turn == "s" and at == START:
            at = SYSTEM
            continue
        cost += KEEP if turn == _next(at) else REROLE
        at, begun = (ASSISTANT if at == USER else USER), True
    while at != end or not begun:
        cost += INSERT
        at, begun = (ASSISTANT if at == USER else USER), True
    return cost


def _table(turns: str, last: str, limit: int) -> tuple[list[dict[int, int]], list[int]]:
    """Cells of alignments no dearer than ``limit``, by turns left, and the turns left that may stay.

    ``last`` is the role that targets end in.
    """
    roles = (last, "u" if last == "a" else "a")  # the role before which an even or odd number is left
    n = len(turns)
    may_stay = [0]
    for turn in reversed(turns):
        may_stay.append(may_stay[-1] + (turn != "-"))
    slack = limit - DELETE * (n - may_stay[-1])
    rows: list[dict[int, int]] = []
    for i in range(n + 1):
        least = max(0, may_stay[i] - slack // DELETE)
        most = may_stay[i] + slack // INSERT
        above = rows[-1] if rows else {}
        row: dict[int, int] = {}
        if i:
            turn = turns[n - i]
            stays, role = _stays(turn), turn.lower()
        for j in range(least, most + 1):
            best = 0 if not i and not j else _NEVER
            if i:
                best = min(best, above.get(j, _NEVER) + DELETE)
                if turn != "-":
                    change = KEEP if role == roles[(j - 1) % 2] else REROLE
                    best = min(best, above.get(j - 1, _NEVER) + change + stays)
            best = min(best, row.get(j - 1, _NEVER) + INSERT)
            if best < _NEVER:
                row[j] = best
        rows.append(row)
    return rows, may_stay


def _edits(turns: str, rows: list[dict[int, int]], last: str, skip: int, j: int) -> str:
    """The first in ASCII of the cheapest edits of the turns behind ``skip`` to the last j roles."""
    roles = (last, "u" if last == "a" else "a")
    n, found = len(turns), []
    i = n - skip
    while i or j:
        cost = rows[i][j]
        if i and rows[i - 1].get(j, _NEVER) + DELETE == cost:
            found.append("D")
            i -= 1
        elif j and rows[i].get(j - 1, _NEVER) + INSERT == cost:
            found.append("I")
            j -= 1
        else:
            found.append("K" if turns[n - i].lower() == roles[(j - 1) % 2] else "R")
            i, j = i - 1, j - 1
    return "".join(found)


def _better(found: tuple[int, str] | None, cost: int, edits: str) -> tuple[int, str]:
    return (cost, edits) if found is None else min(found, (cost, edits))


def _segment(turns: str, places: tuple[int, ...], ends: tuple[int, ...], closed: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and edits of the best alignment from each place to each end.

    Unless ``closed``, no edits follow that of the last turn: a role inserted there is one that the next segment
    inserts in front.
    """
    n, found = len(turns), {}
    for place in places:
        for end in ends:
            if end == place and (place == START or place == SYSTEM):
                found[place, end] = (DELETE * n, "D" * n)
            elif (place, end) == (START, SYSTEM):
                for at, turn in enumerate(turns):
                    if turn in "sS":
                        cost = DELETE * (n - 1) + _stays(turn)
                        edits = "D" * at + "K" + "D" * (n - 1 - at)
                        found[place, end] = _better(found.get((place, end)), cost, edits)
    for end in {USER, ASSISTANT} & set(ends):
        last = "u" if end == USER else "a"
        pairs = [place for place in places if _incumbent(turns, place, end) < _NEVER]
        limits = {place: _incumbent(turns, place, end) for place in pairs}
        rows, may_stay = _table(turns, last, max(limits.values()))
        if not closed:
            _forbid_behind(rows, turns, last)
        for place in pairs:
            best, choices = _NEVER, []
            for j, cost in rows[n].items():
                # The first role of a target of j roles that ends in ``last``.
                first = last if j % 2 else ("a" if last == "u" else "u")
                if (first == _next(place)) if j else (place == end):
                    choices.append((cost, 0, j, ""))
            if place == START:
                choices += _with_system(turns, rows, last)
            for cost, *_ in choices:
                best = min(best, cost)
            for cost, skip, j, before in choices:
                if cost == best:
                    edits = before + _edits(turns, rows, last, skip, j)
                    found[place, end] = _better(found.get((place, end)), cost, edits)
    return found


def _with_system(turns: str, rows: list[dict[int, int]], last: str) -> list[tuple[int, int, int, str]]:
    """Choices that keep a system turn, delete all before it and align the turns behind it."""
    choices = []
    for at, turn in enumerate(turns):
        if turn in "sS":
            cost = DELETE * at + _stays(turn)
            for j, behind in rows[len(turns) - at - 1].items():
                if j and (j % 2 == 1) == (last == "u"):
                    choices.append((cost + behind, at + 1, j, "D" * at + "K"))
    return choices


def _forbid_behind(rows: list[dict[int, int]], turns: str, last: str) -> None:
    """Take alignments that insert behind the last turn out of the table."""
    roles = (last, "u" if last == "a" else "a")
    n = len(turns)
    rows[0] = {0: 0} if 0 in rows[0] else {}
    for i in range(1, n + 1):
        turn, above, row = turns[n - i], rows[i - 1], {}
        for j in sorted(rows[i]):
            best = min(above.get(j, _NEVER) + DELETE, row.get(j - 1, _NEVER) + INSERT)
            if turn != "-":
                change = KEEP if turn.lower() == roles[(j - 1) % 2] else REROLE
                best = min(best, above.get(j - 1, _NEVER) + change + _stays(turn))
            if best < _NEVER:
                row[j] = best
        rows[i] = row


def align(turns: str, segment: int = SEGMENT) -> tuple[int, str]:
    """The least cost, and the initials of the edits."""
    if len(turns) > segment:
        return _long(turns, segment)
    return _short(turns)


@lru_cache(maxsize=1 << 14)
def _short(turns: str) -> tuple[int, str]:
    return min(_segment(turns, (START,), (START, ASSISTANT), True).values())


def _long(turns: str, segment: int) -> tuple[int, str]:
    cuts = range(0, len(turns), segment)
    parts = []
    for at in cuts:
        closed = at + segment >= len(turns)
        ends = (START, ASSISTANT) if closed else (START, SYSTEM, USER, ASSISTANT)
        places = (START,) if at == 0 else (START, SYSTEM, USER, ASSISTANT)
        parts.append(_segment(turns[at : at + segment], places, ends, closed))
    rest = [{START: 0, ASSISTANT: 0}]
    for part in reversed(parts):
        costs: dict[int, int] = {}
        for (place, end), (cost, _) in part.items():
            if end in rest[-1]:
                costs[place] = min(costs.get(place, _NEVER), cost + rest[-1][end])
        rest.append(costs)
    rest.reverse()
    place, found = START, []
    for number, part in enumerate(parts):
        edits, place = min(
            (edits, end)
            for (start, end), (cost, edits) in part.items()
            if start == place and end in rest[number + 1] and cost + rest[number + 1][end] == rest[number][place]
        )
        found.append(edits)
    return rest[0][START], "".join(found)
