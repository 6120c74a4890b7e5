"""Repair of a sequence of turns as a Viterbi search whose survivors emit what they agree on.

States say what the repaired roles look like so far: nothing, a system turn, an open user turn, an answered one. A
path's label per row is the edits made for it: ``I`` for every inserted turn before it, then ``K``, ``R`` or ``D``. As
only the last letter of a label is not ``I``, no path's labels are a prefix of another's of the same rows: ties of
cost are settled by the first row whose labels differ, and the winner does not depend on what follows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

NOTHING, SYSTEM, USER, ANSWERED = range(4)
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: Inserted turns that lead from a state to another before a row is looked at.
BEFORE = {NOTHING: {NOTHING: "", USER: "I", ANSWERED: "II"}, SYSTEM: {SYSTEM: "", USER: "I", ANSWERED: "II"},
          USER: {USER: "", ANSWERED: "I"}, ANSWERED: {ANSWERED: "", USER: "I"}}
#: Inserted turns that end a path.
AFTER = {NOTHING: "", SYSTEM: "II", USER: "I", ANSWERED: ""}
#: What it costs at most to go on from the second state as one would from the first.
INSTEAD = {
    (NOTHING, USER): 2, (NOTHING, ANSWERED): 4, (SYSTEM, USER): 2, (SYSTEM, ANSWERED): 4, (USER, ANSWERED): 2, (ANSWERED, USER): 2,
    # an answered path lacks only the system turn of one that has nothing yet, which it deletes instead
    (ANSWERED, SYSTEM): 0, (ANSWERED, NOTHING): 3}


def next_state(state: int, initial: str) -> int | None:
    """State after a turn whose role has this initial."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return None if state == USER else USER
    return ANSWERED if initial == "a" and state == USER else None


@lru_cache
def moves(initial: str, must_delete: bool, truncated: bool) -> dict[int, list[tuple[int, int, str]]]:
    """Per state after a row, ``(state before, cost, label)``: of each two states the cheapest label, of equal ones the least."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start, ways in BEFORE.items():
        for middle, inserted in ways.items():
            edits = [(DELETE, "D", middle)]
            if not must_delete:
                extra = TRUNCATED * truncated
                edits += [(extra, "K", next_state(middle, initial))]
                edits += [(REROLE + extra, "R", next_state(middle, role)) for role in "ua"]
            for cost, letter, end in edits:
                if end is not None:
                    offer = (cost + INSERT * len(inserted), inserted + letter)
                    best[start, end] = min(offer, best.get((start, end), offer))
    return {end: [(i, *best[i, j]) for i, j in best if j == end] for end in {j for _, j in best}}


class _Node:
    __slots__ = ("parent", "label", "row", "children", "depth")

    def __init__(self, parent: _Node | None, label: object, row: object):
        self.parent, self.label, self.row, self.children = parent, label, row, 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.children += 1


def _less(a: _Node, label_a, b: _Node, label_b) -> bool:
    """Is the path through ``a`` before the one through ``b`` (of the same length)? Compares all labels that they do not share."""
    first = (label_a, label_b)
    while a is not b:
        if a.label != b.label:
            first = (a.label, b.label)
        a, b = a.parent, b.parent
    return first[0] < first[1]


class Survivors:
    """The cheapest path to each state, as a tree of back pointers with counts of children.

    ``emit`` receives ``(label, row)`` of every step as soon as all survivors share it. Paths that another one beats
    whatever follows are given up, so the unresolved part of the tree stays small unless ties persist.
    """

    def __init__(self, start: int, emit: Callable[[object, object], None]):
        self.emit = emit
        self.root = _Node(None, None, None)
        self.alive: dict[int, tuple[int, _Node]] = {start: (0, self.root)}

    def step(self, ways: dict[int, list[tuple[int, int, object]]], row: object, give_up: bool = True) -> None:
        old, new = self.alive, {}
        for end, offers in ways.items():
            best = None
            for start, cost, label in offers:
                if start not in old:
                    continue
                total, node = old[start][0] + cost, old[start][1]
                if best is None or total < best[0] or (total == best[0] and _less(node, label, best[1], best[2])):
                    best = (total, node, label)
            if best:
                new[end] = best
        if give_up:
            new = {j: b for j, b in new.items()
                   if not any(new[i][0] + extra < b[0] for (i, k), extra in INSTEAD.items() if k == j and i in new)}
        self.alive = {j: (total, _Node(node, label, row)) for j, (total, node, label) in new.items()}
        for _, node in old.values():
            self._drop(node)
        self._emit_shared()

    @staticmethod
    def _drop(node: _Node) -> None:
        """Remove a path that no survivor goes through."""
        while node.children == 0 and node.parent is not None:
            parent = node.parent
            parent.children -= 1
            node.parent, node = None, parent

    def _emit_shared(self) -> None:
        if self.root.children != 1:
            return
        # the latest step that all survivors share: go back until one node is left, then to where the root's only path ends
        nodes = list({id(node): node for _, node in self.alive.values()}.values())
        while len(nodes) > 1:
            nodes = list({id(n.parent): n.parent for n in nodes}.values())
        self._emit_path(nodes[0])

    def _emit_path(self, node: _Node) -> None:
        path, shared = [], node
        while node is not self.root:
            path.append((node.label, node.row))
            node = node.parent
        for label, row in reversed(path):
            self.emit(label, row)
        shared.parent, shared.label, shared.row = None, None, None
        self.root = shared

    def unresolved(self, end: int) -> str:
        """Labels of the path to ``end`` that have not been emitted."""
        labels, node = [], self.alive[end][1]
        while node is not self.root:
            labels.append(node.label)
            node = node.parent
        return "".join(reversed(labels))

    def finish(self, end: int) -> int:
        """Emit the rest of the path to ``end``; its cost."""
        total, node = self.alive[end]
        self._emit_path(node)
        return total

    def end_of_all(self) -> int:
        """The state in which the best path ends, with the turns inserted after it."""
        best = None
        for state, (total, node) in self.alive.items():
            offer = (total + INSERT * len(AFTER[state]), node, state)
            # a path goes on with what is inserted after it only where the labels before are the same, and then in one state
            if best is None or offer[0] < best[0] or (offer[0] == best[0] and _less(node, "", best[1], "")):
                best = offer
        return best[2]
