"""Words, merge rules and ids by whole Arrow columns: the code that runs in Python workers."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from glyphmill.functions.text import WHITESPACE

#: Bytes of words that are merged at a time, one word at least: what a worker holds does not grow with its input.
BLOCK = 1 << 19
#: Bytes of texts that are encoded at a time, one text at least.
TEXT_BLOCK = 2 << 20
#: Bytes of texts whose words are counted at a time, one text at least.
COUNT_BLOCK = 8 << 20
#: Bits of a symbol, and of a rule's rank.
BITS = 21
#: Where a worker process keeps its merger; outlives the functions a task unpickles.
_KEPT = "glyphmill_worker_mergers"
#: A place whose symbol has gone into the one before it, and the pair of such a place.
_GONE = -1
#: White space in UTF-8: which bytes are one, which begin a longer one, and the longer ones as numbers.
_SPACE = np.isin(np.arange(256), [ord(c) for c in WHITESPACE if c < "\x80"])
_LONGER = [c.encode() for c in WHITESPACE if c >= "\x80"]
_LEAD = np.isin(np.arange(256), [c[0] for c in _LONGER])
_TWO, _THREE = (np.array([int.from_bytes(c, "big") for c in _LONGER if len(c) == n]) for n in (2, 3))


def merger_of(rules: list[str]) -> Merger:
    """The merger of some rules, built once per worker process; that of the latest rules is kept."""
    kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__
    if kept.get("rules") != rules:
        kept["merger"], kept["rules"] = Merger(rules), rules
    return kept["merger"]


class Merger:
    """Merge rules, each applied once in rank order, left to right and not overlapping.

    A pair may occur in several rules. Pairs that a merge creates wait for the next rule of
    theirs above the rank just applied, which is what going through the whole list would do. All
    words of a block are merged at once, as one row of symbols with a mark before each word and after
    the last: a rule costs a few array operations on the places it meets.
    """

    def __init__(self, rules: list[str]):
        points = np.array([[ord(c) for c in rule] for rule in rules], np.int64).reshape(-1, 3)
        self.pairs = points[:, 0] << BITS | points[:, 1]
        self.merged = points[:, 2]
        self.keys = np.sort(self.pairs << BITS | np.arange(len(rules)))
        # Which symbols some rule has on its left, and on its right; the last entry is for all others.
        self.sides = np.zeros((2, points[:, :2].max(initial=0) + 2), bool)
        for side, symbols in zip(self.sides, (points[:, 0], points[:, 1])):
            side[symbols] = True

    def begun(self, row: np.ndarray) -> np.ndarray:
        """The places of a row where some rule may meet a pair."""
        known = np.minimum(row, self.sides.shape[1] - 1)
        left, right = self.sides
        return np.flatnonzero(left[known[:-1]] & right[known[1:]]).astype(np.int32)

    def next_ranks(self, pairs: np.ndarray, rank: int) -> np.ndarray:
        """The first rule of each pair above ``rank``, or -1."""
        if not len(self.keys):
            return np.full(len(pairs), -1)
        at = np.searchsorted(self.keys, (pairs << BITS) + (rank + 1))
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return np.where((at < len(self.keys)) & (found >> BITS == pairs), found & ((1 << BITS) - 1), -1)

    def run(self, row: np.ndarray, told: Callable[[int, np.ndarray, np.ndarray, np.ndarray], None] | None = None) -> None:
        """Merge a marked row in place; symbols that went into others are ``_GONE``.

        ``told`` hears of each rule that met something: its rank, the places whose pairs changed, and
        the pairs there before and after.
        """
        if len(row) < 2:
            return
        before, after = np.arange(-1, len(row) - 1, dtype=np.int32), np.arange(1, len(row) + 1, dtype=np.int32)
        pairs = np.append(row[:-1] << BITS | row[1:], _GONE)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(places: np.ndarray, rank: int) -> None:
            ranks = self.next_ranks(pairs[places], rank)
            some = np.flatnonzero(ranks >= 0)
            if not len(some):
                return
            order = some[np.argsort(ranks[some], kind="stable")]
            ranks = ranks[order]
            starts = np.flatnonzero(np.diff(ranks, prepend=-1))
            for found, part in zip(ranks[starts].tolist(), np.split(places[order], starts[1:])):
                if found not in waiting:
                    heappush(heap, found)
                waiting.setdefault(found, []).append(part)

        wait(self.begun(row), -1)
        while heap:
            rank = heappop(heap)
            parts = waiting.pop(rank)
            at = parts[0] if len(parts) == 1 else _distinct(*parts)
            pair = self.pairs[rank]
            # Some places have merged since they were noted.
            at = at[pairs[at] == pair]
            if not len(at):
                continue
            if pair >> BITS == pair & ((1 << BITS) - 1):
                # Of places that overlap, in a run of equal symbols, every second one merges.
                index = np.arange(len(at))
                first = np.append(True, before[at[1:]] != at[:-1])
                at = at[(index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0]
            gone = after[at]
            beyond = after[gone]
            if told:
                touched = _distinct(before[at], at, gone)
                old = pairs[touched]
            row[at], row[gone] = self.merged[rank], _GONE
            after[at], before[beyond], pairs[gone] = beyond, at, _GONE
            changed = _distinct(before[at], at)
            pairs[changed] = row[changed] << BITS | row[after[changed]]
            if told:
                told(rank, touched, old, pairs[touched])
            wait(changed, rank)

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words, one word after the other, and how many each has."""
        values, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for (block,) in blocks([pa.RecordBatch.from_arrays([words], ["word"])], "word"):
            data, ends = _data(block)
            row, marks = marked(data, ends)
            self.run(row)
            points, lengths = unmarked(row, marks)
            values.append(point_ids(points))
            sizes.append(lengths)
        return np.concatenate(values), np.concatenate(sizes)

    def merge(self, word: str) -> str:
        row, marks = marked(np.array([ord(c) for c in word], np.int64), np.array([0, len(word)]))
        self.run(row)
        return "".join(map(chr, unmarked(row, marks)[0]))


def _distinct(*parts: np.ndarray) -> np.ndarray:
    """The distinct numbers of some rows of them, in order: sorting beats the hashing of ``np.unique``."""
    values = np.sort(np.concatenate(parts))
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _offsets(strings: pa.Array) -> np.ndarray:
    """Where each string begins in the array's bytes, and the last ends."""
    kind = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    buffer = strings.buffers()[1]
    return np.frombuffer(buffer, kind)[strings.offset : strings.offset + len(strings) + 1] if buffer else np.zeros(1, kind)


def _data(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, one string after the other, and where each begins and the last ends."""
    ends, data = _offsets(strings).astype(np.int64), strings.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def code_points(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of strings, one string after the other, and where each begins and the last ends."""
    data, ends = _data(strings)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, np.append(0, np.cumsum((data & 0xC0) != 0x80))[ends]


def marked(points: np.ndarray, ends: np.ndarray, edge: str = "\U0010ffff") -> tuple[np.ndarray, np.ndarray]:
    """Words as one row with a mark before each and after the last, and the places of the marks."""
    marks = ends + np.arange(len(ends))
    row = np.full(len(points) + len(ends), ord(edge), np.int64)
    inside = np.ones(len(row), bool)
    inside[marks] = False
    row[inside] = points
    return row, marks


def unmarked(row: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the words in a row, without what has gone, and how many each word has."""
    live = row != _GONE
    lengths = np.diff(np.append(0, np.cumsum(live))[marks]) - 1
    live[marks] = False
    return row[live], lengths


def blocks(batches: Iterable[pa.RecordBatch], measured: str) -> Iterator[tuple[pa.Array, ...]]:
    """Columns of rows dealt anew: about ``BLOCK`` bytes of a column of strings at a time, one row at least."""
    held, room = [], BLOCK

    def whole() -> tuple[pa.Array, ...]:
        return tuple(pa.concat_arrays(list(parts)) for parts in zip(*(b.columns for b in held)))

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(measured)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            done = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, done + room, "right")), start + (not held))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                room -= ends[stop - 1] - done
            start = stop
            if start < len(ends):
                yield whole()
                held, room = [], BLOCK
    if held:
        yield whole()


def _strings(keys: np.ndarray, width: int) -> pa.Array:
    """Keys of ``width`` symbols, as strings."""
    points = np.stack([keys >> BITS * (width - 1 - i) & ((1 << BITS) - 1) for i in range(width)], 1).astype(np.uint32)
    text = points.tobytes().decode("utf-32-le")
    return pa.array([text[i : i + width] for i in range(0, len(text), width)], pa.string())


class _Sums:
    """Sums by integer keys, held by a task until there are many of them."""

    def __init__(self):
        self.parts, self.entries = [], 0

    def add(self, keys: np.ndarray, freqs: np.ndarray) -> None:
        self.parts.append((keys, freqs))
        self.entries += len(keys)

    def shrink(self) -> None:
        keys, freqs = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(keys)
        keys, freqs = keys[order], freqs[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        keys, freqs = keys[starts], np.add.reduceat(freqs, starts) if len(starts) else freqs
        self.parts, self.entries = [(keys[freqs != 0], freqs[freqs != 0])], int(np.count_nonzero(freqs))

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """What is held, summed; nothing is held after."""
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.shrink()
        ((keys, freqs),) = self.parts
        self.parts, self.entries = [], 0
        return keys, freqs


class Steps:
    """Merge rules in order, with one word before and after each rule that changes it: what :class:`Merger` does to many."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        # A pair's rules from the last to the first; almost all pairs have one.
        self.ranks: dict[tuple[str, str], int] = {}
        self.earlier: dict[tuple[str, str], list[int]] = {}
        for rank, rule in enumerate(rules):
            pair = rule[0], rule[1]
            if pair in self.ranks:
                self.earlier.setdefault(pair, []).append(self.ranks[pair])
            self.ranks[pair] = rank

    def of(self, word: str) -> Iterator[tuple[int, str, str]]:
        rank, get = -1, self.ranks.get
        while True:
            pairs = zip(word, word[1:])
            ahead = [k for k in map(get, pairs) if k is not None and k > rank]
            if not ahead:
                return
            best = min(ahead)
            if self.earlier:
                for pair in set(zip(word, word[1:])) & self.earlier.keys():
                    best = min([best, *(k for k in self.earlier[pair] if k > rank)])
            rule = self.rules[best]
            merged = word.replace(rule[:2], rule[2])
            yield best, word, merged
            word, rank = merged, best

    def last(self, word: str) -> str:
        for _, _, word in self.of(word):  # noqa: B007, PLW2901
            pass
        return word


#: Sums that a task holds before it hands them on.
HELD = 1 << 20


def _numbers(freq: pa.Array) -> np.ndarray:
    return freq.to_numpy(zero_copy_only=False).astype(np.int64)


def trigrams(batches: Iterator[pa.RecordBatch], edge: str) -> Iterator[pa.RecordBatch]:
    """``(freq, symbols)`` rows to ``(trigram, freq)``, of each pair of a word and what comes after it.

    ``edge`` comes after the last pair. Counts of a task are summed before they leave.
    """
    sums, mark = _Sums(), ord(edge)

    def rows() -> pa.RecordBatch:
        keys, freqs = sums.taken()
        return pa.RecordBatch.from_arrays([_strings(keys, 3), pa.array(freqs, pa.int64())], ["trigram", "freq"])

    for freq, words in _columns(batches):
        row, marks = marked(*code_points(words), edge)
        # The last place but one begins no pair, as the row ends in a mark.
        weight = np.repeat(_numbers(freq), np.diff(marks))[:-1]
        first, second, third = row[: len(weight)], row[1 : len(weight) + 1], row[2 : len(weight) + 2]
        inside = (first != mark) & (second != mark)
        sums.add((first << 2 * BITS | second << BITS | third)[inside], weight[inside])
        if sums.entries > HELD:
            sums.shrink()
            if 2 * sums.entries > HELD:
                yield rows()
    yield rows()


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    return blocks((pa.RecordBatch.from_arrays([b.column("freq"), b.column("symbols")], ["freq", "symbols"]) for b in batches), "symbols")


def changed_pairs(batches: Iterator[pa.RecordBatch], rules: list[str], listed: set[str], fresh: str, edge: str) -> Iterator[pa.RecordBatch]:
    """``(freq, symbols)`` rows to ``(step, pair, freq)``: how each rule in turn changes the pairs' counts.

    Steps count from 1. Only ``listed`` pairs are told, and those with a symbol from ``fresh`` on.
    Changes of a task are summed before they leave.
    """
    merger, mark, least = Merger(rules), ord(edge), ord(fresh)
    known = np.sort(np.array([ord(p[0]) << BITS | ord(p[1]) for p in listed], np.int64))
    sums: dict[int, _Sums] = {}

    def told(rank: int, places: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        pairs, freqs = np.concatenate([old, new]), np.concatenate([-weight[places], weight[places]])
        left, right = pairs >> BITS, pairs & ((1 << BITS) - 1)
        wanted = (left >= least) | (right >= least)
        if len(known):
            wanted |= known[np.minimum(np.searchsorted(known, pairs), len(known) - 1)] == pairs
        wanted &= (pairs >= 0) & (left != mark) & (right != mark)
        sums.setdefault(rank, _Sums()).add(pairs[wanted], freqs[wanted])

    def rows() -> pa.RecordBatch:
        kept = [(rank, *own.taken()) for rank, own in sorted(sums.items())]
        sums.clear()
        steps = [np.full(len(keys), rank + 1, np.int32) for rank, keys, _ in kept]
        pairs, freqs = (np.concatenate([np.zeros(0, np.int64), *(k[i] for k in kept)]) for i in (1, 2))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(0, np.int32), *steps])), _strings(pairs, 2), pa.array(freqs, pa.int64())],
            ["step", "pair", "freq"],
        )

    for freq, words in _columns(batches):
        row, marks = marked(*code_points(words), edge)
        weight = np.append(np.repeat(_numbers(freq), np.diff(marks)), 0)
        merger.run(row, told)
        if sum(own.entries for own in sums.values()) >= HELD:
            for own in sums.values():
                own.shrink()
            if 2 * sum(own.entries for own in sums.values()) >= HELD:
                yield rows()
    yield rows()


def merged_words(batches: Iterator[pa.RecordBatch], rules: list[str]) -> Iterator[pa.RecordBatch]:
    """``(freq, symbols)`` rows after all rules; words of one symbol left out."""
    merger = Merger(rules)
    for freq, words in _columns(batches):
        row, marks = marked(*code_points(words))
        merger.run(row)
        points, lengths = unmarked(row, marks)
        text = points.astype(np.uint32).tobytes().decode("utf-32-le").encode("utf-8")
        sizes = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(lengths))].astype(np.int32)
        done = pa.StringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(text))
        yield pa.RecordBatch.from_arrays([freq, done], ["freq", "symbols"]).filter(pa.array(lengths > 1))


def point_ids(points: np.ndarray) -> np.ndarray:
    """Token ids of symbols: their code points, shifted past the special tokens."""
    return (np.where(points >= 0xE000, points - 0x800, points) + 4).astype(np.int32)


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to white space."""
    found = _SPACE[data]
    at = np.flatnonzero(_LEAD[data])
    if len(at):
        one, two, three = (np.append(data, np.zeros(2, np.uint8))[at + i].astype(np.int64) for i in range(3))
        short, long = np.isin(one << 8 | two, _TWO), np.isin(one << 16 | two << 8 | three, _THREE)
        for i, longer in enumerate((short | long, short | long, long)):
            found[at[longer] + i] = True
    return found


def split_words(texts: pa.Array) -> pa.LargeListArray:
    """The words of texts, separated by Unicode white space; null for null."""
    data, ends = _data(texts)
    outside = ~_spaces(data)
    first = outside.copy()
    first[1:] &= ~outside[:-1]
    begins = ends[:-1][ends[:-1] < len(data)]
    first[begins] = outside[begins]
    # Without white space, the words are one after the other already.
    word_ends = np.append(np.flatnonzero(first[outside]), np.count_nonzero(outside))
    words = pa.LargeStringArray.from_buffers(len(word_ends) - 1, pa.py_buffer(word_ends), pa.py_buffer(data[outside]))
    bounds = np.searchsorted(np.flatnonzero(first), ends)
    return pa.LargeListArray.from_arrays(pa.array(bounds), words, mask=texts.is_null())


def _by_size(column: pa.Array, ends: np.ndarray, most: int) -> Iterator[pa.Array]:
    """A column in slices of up to ``most``, one row at least; ``ends`` sums up the rows' sizes, from 0."""
    start = 0
    while start < len(column):
        stop = max(int(np.searchsorted(ends, ends[start] + most, "right")) - 1, start + 1)
        yield column.slice(start, stop - start)
        start = stop


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one column of texts to ``(word, freq)``: the words of about ``COUNT_BLOCK`` bytes of text at a time."""
    for batch in batches:
        (texts,) = batch.columns
        for some in _by_size(texts, _offsets(texts).astype(np.int64), COUNT_BLOCK):
            counts = split_words(some).flatten().value_counts()
            yield pa.RecordBatch.from_arrays([counts.field("values").cast(pa.string()), counts.field("counts")], ["word", "freq"])


def encode_texts(texts: pa.Array, merger: Merger, space: int) -> Iterator[pa.Array]:
    """Token ids of texts, ``space`` between words; null for null.

    Texts are taken by about ``TEXT_BLOCK`` bytes at a time, so memory is bounded by the longest one. The
    distinct words of a block are merged once each; all else is done on whole columns.
    """
    for some in _by_size(texts, _offsets(texts).astype(np.int64), TEXT_BLOCK):
        yield _encoded(split_words(some), merger, space)


def encode_lists(words: pa.Array, merger: Merger, space: int) -> Iterator[pa.Array]:
    """Token ids of lists of words, as :func:`encode_texts` of texts."""
    bounds = words.offsets.to_numpy().astype(np.int64)
    # A word counts with a space, so that many short ones are not taken for nothing.
    for some in _by_size(words, _offsets(words.values)[bounds] + bounds, TEXT_BLOCK):
        yield _encoded(some, merger, space)


def encode_each(words: pa.Array, merger: Merger, space: int) -> Iterator[pa.Array]:
    """Token ids of rows that hold one word each; null for null. No space is needed."""
    # A word counts as longer by one, so that many short ones are not taken for nothing.
    ends = _offsets(words).astype(np.int64) + np.arange(len(words) + 1)
    for some in _by_size(words, ends, TEXT_BLOCK):
        coded = some.dictionary_encode()
        values, sizes = merger.ids(coded.dictionary)
        starts = np.append(0, np.cumsum(sizes)).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(starts), pa.array(values)).take(coded.indices)


def _encoded(words: pa.Array, merger: Merger, space: int) -> pa.Array:
    words = words.cast(pa.large_list(pa.large_string()))
    valid = words.is_valid().to_numpy(zero_copy_only=False)
    counts = np.where(valid, np.diff(words.offsets.to_numpy()), 0)
    coded = words.flatten().dictionary_encode()
    values, sizes = merger.ids(coded.dictionary)
    # Every word brings a space before its ids, which goes again before the first word of a text.
    starts = np.append(0, np.cumsum(sizes + 1)).astype(np.int32)
    spaced = np.full(starts[-1], space, np.int32)
    inside = np.ones(len(spaced), bool)
    inside[starts[:-1]] = False
    spaced[inside] = values
    taken = pa.ListArray.from_arrays(pa.array(starts), pa.array(spaced)).take(coded.indices)
    ends, word_ends = taken.offsets.to_numpy(), np.append(0, np.cumsum(counts))
    ids = np.ones(len(taken.values), bool)
    ids[ends[word_ends[:-1][counts > 0]]] = False
    text_ends = ends[word_ends] - np.append(0, np.cumsum(counts > 0))
    return pa.ListArray.from_arrays(
        pa.array(text_ends.astype(np.int32)), pa.array(taken.values.to_numpy()[ids]), mask=pa.array(~valid)
    )
