"""Which merges come next: foreseen from one look at the counts, confirmed by exact ones.

The look is the most frequent pairs with, for each, how often its most frequent neighbours
stood before and after it. From that the driver plays training on, estimating the counts of the
pairs that merges create or thin out. All words then take these merges in turn and tell how
each changes the counts; what was the best pair at its step by those counts is a merge, and the
first one that was not ends the batch. What the others changed is kept: the next look foresees with
measured effects, so most of a batch is right.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

from glyphmill.functions import symbols as sy

CANDIDATES = 1024
NEIGHBOURS = 32


@dataclass
class Vocabulary:
    """Tokens and merges so far. A symbol stands for its bytes, however they were reached."""

    merges: list[tuple[bytes, bytes]] = field(default_factory=list)
    freqs: list[int] = field(default_factory=list)
    token_of: dict[str, bytes] = field(
        default_factory=lambda: {sy.symbol(sy.FIRST_BYTE_ID + b): bytes([b]) for b in range(256)}
    )
    # Hex of every token in id order.
    token_hex: list[str] = field(default_factory=lambda: [f"{b:02x}" for b in range(256)])

    def __post_init__(self):
        self.symbol_of = {token: char for char, token in self.token_of.items()}

    def add(self, pair: str, freq: int) -> tuple[str, bool]:
        """Record a merge; returns its symbol and whether that existed before."""
        left, right = (self.token_of[char] for char in pair)
        merged = left + right
        known = merged in self.symbol_of
        char = self.symbol_of.setdefault(merged, sy.symbol(sy.FIRST_MERGE_ID + len(self.merges)))
        self.token_of.setdefault(char, merged)
        self.token_hex.append(merged.hex())
        self.merges.append((left, right))
        self.freqs.append(freq)
        return char, known


#: A pair as the bytes of its two tokens.
Pair = tuple[bytes, bytes]


class _Outlook:
    """Estimated counts of pairs, and of what stands after and before each."""

    def __init__(self, candidates: list, spelled: dict[str, bytes]):
        self.count: dict[Pair, float] = {}
        self.after: dict[Pair, dict[bytes, float]] = defaultdict(dict)
        self.before: dict[Pair, dict[bytes, float]] = defaultdict(dict)
        for row in candidates:
            pair = spelled[row.pair[0]], spelled[row.pair[1]]
            self.count[pair] = row.freq
            sides = self.after[pair], self.before[pair]
            for n in row.neighbours:
                sides[0 if n.after else 1][spelled[n.neighbour]] = n.freq

    def _thin(self, pair: Pair, taken: float, gone: bytes, mine: dict, others: dict) -> float:
        """Take from a pair the places where ``gone`` stood on one side; returns their share."""
        share = min(1.0, taken / self.count[pair]) if self.count[pair] > 0 else 1.0
        self.count[pair] -= taken
        others[pair].pop(gone, None)
        mine[pair] = {x: f * (1 - share) for x, f in mine[pair].items()}
        return share

    def merge(self, pair: Pair, least: float) -> None:
        """Estimates after ``pair`` became a token; new pairs below ``least`` are not followed."""
        left, right = pair
        token = left + right
        count = max(self.count.pop(pair), 1)
        after, before = self.after.pop(pair, {}), self.before.pop(pair, {})
        for near, far, mine, others in ((after, before, self.after, self.before), (before, after, self.before, self.after)):
            on_right = mine is self.after
            join = (lambda a, b: (a, b)) if on_right else (lambda a, b: (b, a))
            for x, freq in near.items():
                if freq < least:
                    continue
                new, old = join(token, x), join(right if on_right else left, x)
                self.count[new] = self.count.get(new, 0) + freq
                beyond: dict[bytes, float] = {}
                if old in self.count:
                    known = mine[old]
                    share = self._thin(old, freq, left if on_right else right, mine, others)
                    beyond = {y: f * share for y, f in known.items() if f * share >= least}
                mine[new] = beyond
                others[new] = {y: f * freq / count for y, f in far.items() if f * freq >= least * count}
                # What stands beyond the neighbour now has the new token on its other side.
                for y, f in beyond.items():
                    outer = join(x, y)
                    gone = right if on_right else left
                    if outer in self.count and gone in others[outer]:
                        others[outer][gone] -= f
                        others[outer][token] = others[outer].get(token, 0) + f


def foresee(candidates: list, vocabulary: Vocabulary, limit: int, measured: dict[Pair, dict[Pair, int]] | None = None) -> list[str]:
    """Rules that training is likely to take next, in order; the first one is certain.

    ``measured`` has, for merges foreseen before, by how much each changed the counts of which pairs;
    it goes before estimates. The list ends where counts fall below those of the candidates, and
    after a merge whose bytes are a token already: only that can make a pair not listed more frequent.
    """
    if not candidates:
        return []
    least = candidates[-1].freq if len(candidates) == CANDIDATES else 1
    outlook, measured = _Outlook(candidates, vocabulary.token_of), measured or {}
    count, symbol_of, rules, used = outlook.count, dict(vocabulary.symbol_of), [], set()
    heap = [(-n, *pair) for pair, n in count.items()]
    heapify(heap)
    while heap and len(rules) < limit:
        freq, left, right = heappop(heap)
        pair = left, right
        if pair in used or -freq != round(count.get(pair, -1)) or left not in symbol_of or right not in symbol_of:
            continue
        if rules and -freq < least:
            break
        known = left + right in symbol_of
        char = symbol_of.setdefault(left + right, sy.symbol(sy.FIRST_MERGE_ID + len(vocabulary.merges) + len(rules)))
        rules.append(symbol_of[left] + symbol_of[right] + char)
        used.add(pair)
        if known:
            break
        before = dict(count)
        outlook.merge(pair, least)
        if pair in measured:
            changed = measured[pair]
            for other in count.keys() | changed.keys():
                if other not in used:
                    count[other] = before.get(other, 0) + changed.get(other, 0)
        for other, n in count.items():
            if before.get(other) != n or left + right in other:
                heappush(heap, (-round(n), *other))
    return rules


def effects(rules: list[str], candidates: list, changes: list, vocabulary: Vocabulary) -> dict[Pair, dict[Pair, int]]:
    """What each foreseen merge changed, for later looks: see ``foresee``."""
    spelled = dict(vocabulary.token_of)
    for rule in rules:
        spelled[rule[2]] = spelled[rule[0]] + spelled[rule[1]]
    count = {row.pair: row.freq for row in candidates}
    found: dict[Pair, dict[Pair, int]] = {(spelled[r[0]], spelled[r[1]]): {} for r in rules}
    for row in sorted(changes, key=lambda row: row.step):
        rule = rules[row.step - 1]
        delta = row.freq - count.get(row.pair, 0)
        count[row.pair] = row.freq
        found[spelled[rule[0]], spelled[rule[1]]][spelled[row.pair[0]], spelled[row.pair[1]]] = delta
    return found


def confirm(rules: list[str], candidates: list, changes: list, vocabulary: Vocabulary, limit: int) -> list[str]:
    """Add the merges among ``rules`` that one-at-a-time training makes next; returns their rules.

    ``changes`` has ``(pair, step, freq)``: a pair's exact count after a step, for all listed pairs and
    all with a new symbol that ever reach the last listed count. Why the order is the same: pairs
    not listed come after all listed ones as these were, and no merge but the last possible one can
    add to them unless they hold a new symbol, in which case ``changes`` has them. So the best of the
    known counts is the best of all if it is above the last listed count, or is a listed one no merge
    has touched.
    """
    floor = candidates[-1].freq if len(candidates) == CANDIDATES else 0
    count = {row.pair: row.freq for row in candidates}
    untouched = set(count)
    by_step: dict[int, list] = {}
    for row in changes:
        by_step.setdefault(row.step, []).append(row)
    spelled = dict(vocabulary.token_of)
    taken: list[str] = []

    def entry(pair: str):
        return -count[pair], spelled[pair[0]], spelled[pair[1]], pair

    heap = [entry(pair) for pair in count]
    heapify(heap)
    for step, rule in enumerate(rules[:limit], 1):
        while heap and -heap[0][0] != count[heap[0][3]]:
            heappop(heap)
        if not heap or heap[0][3] != rule[:2] or count[rule[:2]] <= (0 if rule[:2] in untouched else floor):
            break
        char, _ = vocabulary.add(rule[:2], count[rule[:2]])
        taken.append(rule[:2] + char)
        spelled[char] = vocabulary.token_of[char]
        for row in by_step.get(step, ()):
            count[row.pair] = row.freq
            untouched.discard(row.pair)
            heappush(heap, entry(row.pair))
    return taken
