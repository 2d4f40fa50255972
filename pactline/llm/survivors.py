"""Survivor-coalescence Viterbi over the edits of one conversation.

Four states say what the repaired rows so far end with: nothing, a system row, a
user row, an assistant row. For each state one cheapest path of edits survives.
The survivors' paths form a tree of back-pointers; every node counts who refers
to it, children and survivors, and goes when nobody does. Where all survivors
share an ancestor, the edits up to it are certain: they are emitted and their
nodes go. So memory holds the unresolved edits alone, however long the
conversation is.

Paths of one cost that meet in one state are compared by their whole unresolved
edits as text. Both have passed the same rows, so none is the start of the
other (it would have fewer inserts and a lower cost), and the order of two paths
never changes with what follows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, NamedTuple

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
NEVER = 1 << 60

# The state after a user or assistant row, whichever is due.
DUE = (USER, USER, ASSISTANT, USER)
# What it costs to end after each state: inserts until an assistant row is last.
ENDING = (0, 2 * INSERT_COST, INSERT_COST, 0)
_KEPT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}


class Turn(NamedTuple):
    """One row: the first letter of its role, its fault, and what the caller keeps with it."""

    initial: str
    fault: str | None
    data: Any = None


class Node:
    __slots__ = ("parent", "edit", "turn", "depth", "children", "pins")

    def __init__(self, parent: Node | None, edit: str, turn: Turn | None):
        self.parent, self.edit, self.turn = parent, edit, turn
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []
        self.pins = 0

    @property
    def references(self) -> int:
        return self.pins + len(self.children)


class Path(NamedTuple):
    """A candidate: its cost, the node it goes on from and the edits after that."""

    cost: int
    node: Node
    edits: str


def _steps(state: int, turn: Turn):
    """Edit, cost and next state of all that can be done with a row."""
    yield DELETE, DELETE_COST, state
    if turn.fault in ("blank", "duplicate"):
        return
    more = TRUNCATED_COST if turn.fault else 0
    kept = _KEPT.get((state, turn.initial))
    if kept is not None:
        yield KEEP, more, kept
    yield REROLE, REROLE_COST + more, DUE[state]


def _inserted(state: int):
    """Inserts before a row: how many, and the state after them."""
    once = DUE[state]
    return ((0, state), (1, once), (2, DUE[once]))


def _earlier(a: Path, b: Path) -> bool:
    """Whether ``a``'s edits come before ``b``'s, from their last common node on."""
    first, second = [a.edits[::-1]], [b.edits[::-1]]
    left, right = a.node, b.node
    while left is not right:
        if left.depth >= right.depth:
            first.append(left.edit)
            left = left.parent
        else:
            second.append(right.edit)
            right = right.parent
    return "".join(first)[::-1] < "".join(second)[::-1]


def _offer(best: dict[int, Path], state: int, path: Path) -> None:
    have = best.get(state)
    if (
        have is None
        or path.cost < have.cost
        or (path.cost == have.cost and _earlier(path, have))
    ):
        best[state] = path


class Survivors:
    """Feed rows with ``step``; certain edits come out through ``emit(edit, turn)``."""

    def __init__(self, emit: Callable[[str, Turn | None], None], state: int = START):
        self.emit = emit
        self.root = Node(None, "", None)
        self.alive = {state: (0, self.root)}
        self.root.pins = 1

    def _with_inserts(self) -> dict[int, Path]:
        best: dict[int, Path] = {}
        for state, (cost, node) in self.alive.items():
            for count, after in _inserted(state):
                _offer(best, after, Path(cost + count * INSERT_COST, node, INSERT * count))
        return best

    def step(self, turn: Turn) -> None:
        best: dict[int, Path] = {}
        for state, path in self._with_inserts().items():
            for edit, cost, after in _steps(state, turn):
                _offer(best, after, Path(path.cost + cost, path.node, path.edits + edit))
        self._survive(_worth_keeping(best), turn)

    def _survive(self, best: dict[int, Path], turn: Turn | None) -> None:
        made: dict[tuple[int, str], Node] = {}
        after = {}
        for state, path in best.items():
            node = path.node
            for edit in path.edits:
                child = made.get((id(node), edit))
                if child is None:
                    child = Node(node, edit, None if edit == INSERT else turn)
                    node.children.append(child)
                    made[id(node), edit] = child
                node = child
            node.pins += 1
            after[state] = (path.cost, node)
        for _, node in self.alive.values():
            node.pins -= 1
            while not node.references and node.parent is not None:
                node.parent.children.remove(node)
                node = node.parent
        self.alive = after
        self._resolve()

    def _resolve(self) -> None:
        root = self.root
        while not root.pins and len(root.children) == 1:
            (root,) = root.children
            self.emit(root.edit, root.turn)
            root.parent = None
        self.root = root

    def finish(self, ending: tuple[int, ...] | None = None) -> tuple[int, int]:
        """Resolve everything; the last state and the cost.

        Without ``ending`` the conversation ends here, and inserts complete it;
        else ``ending`` is what the rest costs after each state.
        """
        best: dict[int, Path] = {}
        if ending is None:
            paths = self._with_inserts()
            for state in (START, ASSISTANT):
                if state in paths:
                    _offer(best, ASSISTANT, paths[state])
            ends = {ASSISTANT: ASSISTANT}
        else:
            ends = {}
            for state, (cost, node) in self.alive.items():
                have = best.get(START)
                _offer(best, START, Path(cost + ending[state], node, ""))
                if best[START] is not have:
                    ends[START] = state
        ((kind, path),) = best.items()
        self._survive({kind: path}, None)
        return ends[kind], path.cost

    def unresolved(self) -> int:
        """Edits that wait for their survivors to meet."""
        count, nodes = 0, [self.root]
        while nodes:
            children = nodes.pop().children
            count += len(children)
            nodes += children
        return count


def _worth_keeping(best: dict[int, Path]) -> dict[int, Path]:
    """Survivors without those that are dearer than another one whatever follows.

    After an assistant row everything may follow that may follow a system row,
    and all that may follow at the start but a kept system row, which it can
    delete instead. A user or assistant row is an insert away from the other.
    """
    cost = [best[s].cost if s in best else NEVER for s in STATES]
    user = min(cost[USER], cost[ASSISTANT] + INSERT_COST)
    assistant = min(cost[ASSISTANT], cost[USER] + INSERT_COST)
    limits = (assistant + DELETE_COST, assistant, user, assistant)
    return {s: p for s, p in best.items() if p.cost <= limits[s]}


def passage_costs(turns: list[Turn]) -> list[list[int]]:
    """Least cost from each state before the rows to each state after them."""
    table = []
    for entry in STATES:
        cost = [NEVER] * 4
        cost[entry] = 0
        for turn in turns:
            opened = [NEVER] * 4
            for state in STATES:
                for count, after in _inserted(state):
                    opened[after] = min(opened[after], cost[state] + count * INSERT_COST)
            cost = [NEVER] * 4
            for state in STATES:
                if opened[state] < NEVER:
                    for _, more, after in _steps(state, turn):
                        cost[after] = min(cost[after], opened[state] + more)
        table.append([min(c, NEVER) for c in cost])
    return table
