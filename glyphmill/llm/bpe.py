"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton over the tokens finds the longest token at every place of a word in
one pass. The encoder takes longest matches from the left; a token may follow another only if
merging both texts together would have kept that boundary, which a walk down the two merge
trees decides and a table remembers. If nothing fits, the last token is shortened to its
longest prefix that is a token. Places found to be dead ends are never entered again, so a
word costs time linear in its length, and the result is exactly that of the merges.

Texts are split and new words encoded side by side, as columns; long words, and a few at the
end of a block, take the same steps one by one.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from glyphmill.llm.plan import small_batches

#: Pairs of tokens that a worker process remembers; beyond, it starts afresh.
REMEMBERED_PAIRS = 200_000
#: Pieces of text it remembers in one turn; then a new turn begins, and those of the turn before go unless met again.
REMEMBERED = 60_000
#: Remembered pieces are at most so many characters long; longer ones are encoded each time.
REMEMBERED_LENGTH = 64
#: Places of the table of pairs for words encoded side by side, 8 bytes each; a pair takes the place of the one before.
PAIR_PLACES = 1 << 20
#: Characters of the words that are encoded side by side; each takes some 200 bytes meanwhile.
TOGETHER = 1 << 16
#: So few words are encoded one by one.
FEW = 16
#: Pieces of listed texts that are held at a time.
HELD = 1 << 16
#: Tokens gathered at a time by a decoder, which needs some 24 bytes for every byte it gathers.
GATHERED = 1 << 16
#: Texts of more characters are split piece by piece instead of into a list of all pieces.
LISTED = 1 << 20
#: Bytes of texts that a worker encodes before it hands on what it has, one text at least.
ENCODED = 1 << 19

# What is neither ASCII nor a Latin-1 letter, and the default pattern for texts without any.
_OTHER = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]")
_SIMPLE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Kinds of lower-case Latin-1 characters as that pattern tells them apart: space, letter, digit, other.
_KINDS = np.array([[bool(re.match(kind, chr(c))) for kind in ("[\t-\r ]", "[a-zß-öø-ÿ]", "[0-9]", "")].index(True) for c in range(256)], np.uint8)


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(0x100 + len(letters) - len(plain))
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tokens, merges and pattern of a byte-level BPE tokenizer file, as plain lists.

    Small (a few MB) and fixed: it travels with the function that uses it.
    """

    def __init__(self, tokens: list[str], merges: list[tuple[str, str]], suffix: str, pattern: str, added: dict[str, int]):
        self.tokens, self.merges, self.suffix, self.pattern, self.added = tokens, merges, suffix, pattern, added
        self.fingerprint = hashlib.sha256(repr((tokens, merges, suffix, pattern, sorted(added.items()))).encode()).hexdigest()

    def packed(self) -> bytes:
        """All of it in some hundred KB: what a worker gets with every task, and unpacks at most once."""
        parts = (self.tokens, [list(m) for m in self.merges], self.suffix, self.pattern, self.added)
        return zlib.compress(json.dumps(parts).encode())

    @classmethod
    def unpacked(cls, packed: bytes) -> Vocabulary:
        tokens, merges, *rest = json.loads(zlib.decompress(packed))
        return cls(tokens, [tuple(m) for m in merges], *rest)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a tokenizer file of the ``tokenizers`` library, read on the driver."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        tokens = [""] * (max(model["vocab"].values()) + 1)
        for token, i in model["vocab"].items():
            tokens[i] = token
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return cls(tokens, merges, model.get("end_of_word_suffix") or "", split["pattern"]["Regex"], added)


def _matches(pattern, text: str) -> Iterable[str]:
    return pattern.findall(text) if len(text) <= LISTED else (m[0] for m in pattern.finditer(text))


class Lookup:
    """Whole numbers (not negative) to whole numbers, found by columns; -1 for what is not there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << (4 * len(keys)).bit_length()
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[free]
            put = self.keys[place] == keys
            self.values[place[put]] = values[put]
            keys, values, place = keys[~put], values[~put], (place[~put] + 1) % size

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return _scattered(keys) % len(self.keys)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        place = self._place(keys)
        held, out = self.keys[place], self.values[place]
        row = np.flatnonzero((held != keys) & (held >= 0))
        while len(row):
            place[row] = (place[row] + 1) % len(self.keys)
            held = self.keys[place[row]]
            out[row] = self.values[place[row]]
            row = row[(held != keys[row]) & (held >= 0)]
        return out


def _scattered(keys: np.ndarray) -> np.ndarray:
    """31 bits of each number, well mixed; products may wrap."""
    return (keys ^ keys >> 29) * 0x1E3779B97F4A7C15 >> 32 & 0x7FFFFFFF


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of ranges, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class Encoder(dict):
    """Texts to token ids; also the table of pieces already encoded, to packed ids.

    A symbol is a byte within a word or, with the end suffix, a word's last byte; symbols are
    single characters here, so a token is a string and a word is matched as text.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.older: dict[str, bytes] = {}
        if vocabulary.pattern != _PATTERN:
            raise ValueError("texts are split by another pattern than this encoder knows")
        self.piece = regex.compile(vocabulary.pattern)
        self.added = vocabulary.added
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        numbers = {letter: b for b, letter in enumerate(byte_letters())}
        suffix = vocabulary.suffix
        self.inner = [chr(0x100 + b) for b in range(256)]
        self.last = [chr(0x300 + b) for b in range(256)] if suffix else self.inner

        def symbols(token: str) -> str:
            ends = bool(suffix) and token.endswith(suffix)
            body = token[: len(token) - len(suffix)] if ends else token
            out = [self.inner[numbers[c]] for c in body]
            if ends:
                out[-1] = self.last[numbers[body[-1]]]
            return "".join(out)

        special = set(self.added)
        self.by_text = {symbols(t): i for i, t in enumerate(vocabulary.tokens) if t and t not in special}
        n = len(vocabulary.tokens)
        # The order in which a token comes about: symbols first, then merges by rank.
        self.rank = [-1] * n
        self.left, self.right = list(range(n)), list(range(n))
        self.pairs: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(vocabulary.merges):
            sa, sb = symbols(a), symbols(b)
            ia, ib, made = self.by_text[sa], self.by_text[sb], self.by_text[sa + sb]
            self.pairs.setdefault((ia, ib), r)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = r, ia, ib
        self.sizes = [0] * n
        automaton = ahocorasick.Automaton()
        for text, i in self.by_text.items():
            self.sizes[i] = len(text)
            if len(text) == 1 or self.rank[i] >= 0:
                automaton.add_word(text, i)
        automaton.make_automaton()
        self.automaton = automaton
        self.by_text = {text: i for text, i in self.by_text.items() if len(text) == 1 or self.rank[i] >= 0}
        # The trie of the tokens, from its root 0, and the longest token on the way to each node, or -1.
        nodes, deepest = {"": 0}, [-1]
        # The longest proper prefix of each token that is a token, or -1.
        self.shorter = [-1] * n
        edges: list[int] = []
        for text, i in sorted(self.by_text.items()):
            node = 0
            for cut in range(1, len(text) + 1):
                above, node = node, nodes.setdefault(text[:cut], len(nodes))
                if node == len(deepest):
                    edges.append(above << 10 | ord(text[cut - 1]))
                    deepest.append(deepest[above])
            self.shorter[i], deepest[node] = deepest[node], i
        self.edges, self.deepest = Lookup(np.array(edges), np.arange(1, len(nodes))), np.array(deepest)
        # By both tokens in one number, which takes less room than a pair.
        self.compatible: dict[int, bool] = {}
        self.widest = max(map(len, self.by_text))
        self.letters = dict(enumerate(self.inner))
        # The same tables as columns; no token (-1) has the size 0 and nothing shorter.
        self.size_of, self.shorter_of = np.array([*self.sizes, 0]), np.array([*self.shorter, -1])
        self.rank_of, self.left_of, self.right_of = np.array(self.rank), np.array(self.left), np.array(self.right)
        self.rank_of_pair = Lookup(np.array([a << 32 | b for a, b in self.pairs], np.int64), np.fromiter(self.pairs.values(), np.int64))
        # Twice a pair's number, and one more if it fits.
        self.places = np.full(PAIR_PLACES, -1, np.int64)

    def fits(self, a: int, b: int) -> bool:
        """Whether the merges keep token ``a`` next to token ``b`` apart.

        The latest merge inside either token is undone step by step along the boundary; if at
        some step a merge across it came earlier than what was undone, they would have joined.
        """
        known = self.compatible.get(a << 32 | b)
        if known is not None:
            return known
        x, y, limit, good = a, b, 1 << 60, True
        while True:
            # A merge across the boundary wins if its rank is lower, or equal and more to the left.
            across = self.pairs.get((x, y))
            if across is not None and across < limit:
                good = False
                break
            rx, ry = self.rank[x], self.rank[y]
            if rx < 0 and ry < 0:
                break
            if rx > ry:
                limit, x = rx, self.right[x]
            else:
                limit, y = ry + 1, self.left[y]
        if len(self.compatible) >= REMEMBERED_PAIRS:
            self.compatible.clear()
        self.compatible[a << 32 | b] = good
        return good

    def encode_symbols(self, word: str) -> list[int]:
        """Longest matches from the left if all of them fit, else by backtracking."""
        out, known = [], self.compatible
        last = -1
        for _, token in self.automaton.iter_long(word):
            if last >= 0:
                fit = known.get(last << 32 | token)
                if not (self.fits(last, token) if fit is None else fit):
                    return self._backtrack(word)
            out.append(token)
            last = token
        return out

    def _longest(self, word: str, at: int) -> int:
        """The longest token that starts at a place: down the trie, then back to a token's end."""
        rest = word[at : at + self.widest]
        size = self.automaton.longest_prefix(rest)
        tokens = self.by_text
        while (token := tokens.get(rest[:size], -1)) < 0:
            size -= 1
        return token

    def _backtrack(self, word: str) -> list[int]:
        out: list[int] = []
        sizes, shorter, known = self.sizes, self.shorter, self.compatible
        at, end, alive = 0, len(word), bytearray(b"\1") * (len(word) + 1)
        token = self._longest(word, 0)
        while at < end:
            last = out[-1] if out else -1
            while token >= 0:
                stop = at + sizes[token]
                if alive[stop]:
                    if last < 0:
                        break
                    fit = known.get(last << 32 | token)
                    if self.fits(last, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = stop
                if at < end:
                    token = self._longest(word, at)
            else:
                alive[at] = 0
                token = out.pop()
                at -= sizes[token]
        return out

    def _walks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``fits`` of many pairs, all walks side by side."""
        good, row = np.ones(len(a), bool), np.arange(len(a))
        x, y, limit = a, b, np.full(len(a), 1 << 60)
        while len(row):
            across = self.rank_of_pair[x << 32 | y]
            joins = (across >= 0) & (across < limit)
            good[row[joins]] = False
            rx, ry = self.rank_of[x], self.rank_of[y]
            go = ~joins & ((rx >= 0) | (ry >= 0))
            row, x, y, rx, ry = row[go], x[go], y[go], rx[go], ry[go]
            left = rx > ry
            limit = np.where(left, rx, ry + 1)
            x, y = np.where(left, self.right_of[x], x), np.where(left, y, self.left_of[y])
        return good

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``fits`` of many pairs, from the table or by walks that it then remembers."""
        pair = a << 32 | b
        place = _scattered(pair) % len(self.places)
        held = self.places[place]
        good = (held & 1).astype(bool)
        new = np.flatnonzero(held >> 1 != pair)
        if len(new):
            _, first, back = np.unique(pair[new], return_index=True, return_inverse=True)
            row = new[first]
            fits = self._walks(a[row], b[row])
            self.places[place[row]] = pair[row] << 1 | fits
            good[new] = fits[back]
        return good

    def _longest_at(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The longest token that starts at each of the places: all of them down the trie."""
        node, row = np.zeros(len(at), np.int64), np.arange(len(at))
        while len(row):
            below = self.edges[node[row] << 10 | symbols[at]]
            go = below >= 0
            row, at = row[go], at[go] + 1
            node[row] = below[go]
        return self.deepest[node]

    def _side_by_side(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of pieces, by the steps of ``encode_symbols`` for all of them at once."""
        raw = [piece.encode("utf-8") for piece in pieces]
        end = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1) - 1
        begin = np.concatenate([[0], end[:-1] + 1])
        # One string of symbols, each word followed by one that no token has.
        symbols = np.frombuffer(b"\0".join([*raw, b""]), np.uint8).astype(np.int64) + ord(self.inner[0])
        symbols[end - 1] += ord(self.last[0]) - ord(self.inner[0])
        symbols[end] = 0
        found = self.automaton.iter_long(symbols.astype("<u2").tobytes().decode("utf-16-le"))
        stop, token = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2).T
        row = np.searchsorted(end, stop)
        # The token that ends at each place.
        ending = np.full(len(symbols), -1)
        ending[stop + 1] = token
        near = np.flatnonzero(row[1:] == row[:-1])
        misfit = np.bincount(row, self.size_of[token], len(raw)) != end - begin
        misfit[row[near[~self._fit(token[near], token[near + 1])]]] = True
        one_by_one = self._backtracks(symbols, begin, end, np.flatnonzero(misfit), ending)

        # Back from the ends, along the tokens that stayed.
        at, start = np.delete(end, one_by_one), np.delete(begin, one_by_one)
        stays = np.zeros(len(symbols), bool)
        while len(at):
            stays[at] = True
            at = at - self.size_of[ending[at]]
            go = at > start
            at, start = at[go], start[go]
        ids = ending[stays].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum(stays)[end]).tolist()]
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        for i in one_by_one.tolist():
            out[i] = array("I", self.encode_piece(pieces[i])).tobytes()
        return out

    def _backtracks(self, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray, ending: np.ndarray) -> np.ndarray:
        """``_backtrack`` of many words into ``ending``; the rows it leaves are few."""
        longest, places = np.full(len(symbols), -1), _gather(begin[row], end[row] - begin[row])
        longest[places] = self._longest_at(symbols, places)
        alive = np.ones(len(symbols), bool)
        at, token = begin[row], longest[begin[row]]
        while len(row) > FEW:
            last = ending[at]
            stop = at + self.size_of[token]
            good = (token >= 0) & alive[stop]
            ask = np.flatnonzero(good & (last >= 0))
            good[ask] = self._fit(last[ask], token[ask])
            ending[stop[good]] = token[good]
            # What does not fit is shortened; with nothing left its place is dead, and the token before is shortened.
            dead = token < 0
            alive[at[dead]] = False
            shorter = self.shorter_of[np.where(dead, last, token)]
            at = np.where(good, stop, np.where(dead, at - self.size_of[last], at))
            token = np.where(good, longest[at], shorter)
            go = at < end[row]
            row, at, token = row[go], at[go], token[go]
        return row

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Packed ids of different pieces, by blocks that are encoded side by side."""
        out: dict[str, bytes] = {}
        ends = np.cumsum([0, *map(len, pieces)])
        cuts = np.searchsorted(ends[:-1], np.arange(0, ends[-1] + TOGETHER, TOGETHER)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            block = pieces[a:b]
            if len(block) > FEW:
                out.update(zip(block, self._side_by_side(block)))
            else:
                out.update((piece, array("I", self.encode_piece(piece)).tobytes()) for piece in block)
        return out

    def encode_piece(self, piece: str) -> list[int]:
        if piece.isascii():
            word = piece[:-1].translate(self.letters) + self.last[ord(piece[-1])]
        else:
            raw = piece.encode("utf-8")
            word = raw[:-1].decode("latin-1").translate(self.letters) + self.last[raw[-1]]
        return self.encode_symbols(word)

    def known(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of different pieces: remembered, or encoded and then remembered."""
        out = list(map(self.get, pieces))
        missing = [i for i, ids in enumerate(out) if ids is None]
        older = self.older.get
        for i in missing:
            out[i] = older(pieces[i])
        fresh = self.encode_pieces([p for i in missing if out[i] is None and len(p := pieces[i]) <= REMEMBERED_LENGTH])
        for i in missing:
            piece = pieces[i]
            if len(piece) > REMEMBERED_LENGTH:
                out[i] = array("I", self.encode_piece(piece)).tobytes()
                continue
            if out[i] is None:
                out[i] = fresh[piece]
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = out[i]
        return out

    def _pieces(self, text: str) -> Iterable[str]:
        """A text normalised, in lower case, split by the pattern.

        Letters are lower-cased one by one: no final sigma. Texts of ASCII and Latin-1 letters take
        the same steps with Python's faster matcher; characters newer than Python's tables are
        classed by the library's own splitter.
        """
        if not _OTHER.search(text):
            return _matches(_SIMPLE, text.lower())
        text = unicodedata.normalize("NFC", text)
        if "Cn" not in set(map(unicodedata.category, set(text))):
            return _matches(self.piece, text.replace("Σ", "σ").lower())
        split = pre_tokenizers.Split(Regex(self.piece.pattern), "removed", invert=True)
        return [p for p, _ in split.pre_tokenize_str(normalizers.Lowercase().normalize_str(text))]

    def encode(self, text: str) -> bytes:
        """Packed ids of a text; the vocabulary's added tokens are found in it as they stand."""
        return self.encode_texts([text])[0]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts: those of ASCII and Latin-1 letters as columns, others as lists of pieces."""
        out: list[list[bytes]] = [[] for _ in texts]
        plain: list[int] = []
        held: list[list[str]] = []
        owners: list[int] = []

        def settle():
            pieces = pa.array(chain.from_iterable(held), pa.string())
            for i, ids in zip(owners, self._ids(pieces, list(map(len, held)))):
                out[i].append(ids)
            held.clear(), owners.clear()

        for i, text in enumerate(texts):
            if len(text) <= LISTED and not _OTHER.search(text) and not ("<" in text and self.special and self.special.search(text)):
                plain.append(i)
                continue
            pieces = self._marked(text)
            while run := list(islice(pieces, HELD)):
                held.append(run)
                owners.append(i)
                if sum(map(len, held)) >= HELD:
                    settle()
        settle()
        for i, ids in zip(plain, self._ids(*_cut([texts[i] for i in plain]))):
            out[i].append(ids)
        return [b"".join(runs) for runs in out]

    def _marked(self, text: str) -> Iterator[str]:
        """The pieces of a text; an added token is one that begins with a space, as no other does."""
        at = 0
        if self.special and "<" in text:
            for m in self.special.finditer(text):
                yield from self._pieces(text[at : m.start()])
                yield " " + m[0]
                at = m.end()
        yield from self._pieces(text[at:])

    def _ids(self, pieces: pa.Array, counts: list[int]) -> list[bytes]:
        """Packed ids of texts of so many pieces each; every different piece is looked up once."""
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        added = {" " + t: np.uint32(i).tobytes() for t, i in self.added.items()}
        ids = iter(self.known([w for w in words if w not in added]))
        ids = [added[w] if w in added else next(ids) for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, index = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        data = np.frombuffer(b"".join(ids), "<u4")[_gather(starts[index], sizes[index])].tobytes()
        ends = np.concatenate([[0], 4 * np.cumsum(sizes[index])])[np.cumsum([0, *counts])].tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]


def _cut(texts: list[str]) -> tuple[pa.Array, list[int]]:
    """The pieces that ``_SIMPLE`` finds in texts of ASCII and Latin-1 letters in lower case, and how many each text has."""
    # Between texts stands a space; three more characters at the end keep looks ahead inside.
    chars = np.frombuffer("\n".join([*texts, "\n\n\n"]).lower().encode("latin-1"), np.uint8)
    kind = _KINDS[chars]
    first = kind > 0
    first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    # An apostrophe that begins a piece takes the letters of a contraction with it.
    at = np.flatnonzero((chars == ord("'")) & first)
    one, two = chars[at + 1], chars[at + 2]
    short = np.isin(one, list(b"stmd"))
    long = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    first[at[short | long] + 1] = False
    rest = np.concatenate([at[short] + 2, at[long] + 3])
    first[rest] = kind[rest] > 0

    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    counts = np.diff(np.searchsorted(np.flatnonzero(first), ends)).tolist()
    kept = kind > 0
    chars, first = chars[kept], first[kept]
    wide = np.cumsum(chars > 0x7F)
    offsets = np.flatnonzero(np.append(first, True)).astype(np.int32)
    offsets[1:] += wide[offsets[1:] - 1].astype(np.int32)
    data = chars.tobytes().decode("latin-1").encode("utf-8")
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)), counts


class Decoder:
    """Token texts in one buffer with an offset table; a text is gathered, not concatenated."""

    def __init__(self, vocabulary: Vocabulary):
        names = {i: t for t, i in vocabulary.added.items()}
        n = max([len(vocabulary.tokens), *(i + 1 for i in names)])
        texts = [(names.get(i) or vocabulary.tokens[i]).encode("utf-8") + b" " for i in range(n)]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """Tokens joined by one space: the vocabulary has no decoder of its own."""
        return b"".join(self._gathered(ids[a : a + GATHERED]) for a in range(0, len(ids), GATHERED))[:-1]

    def _gathered(self, ids: np.ndarray) -> bytes:
        starts = self.offsets[ids]
        return self.data[_gather(starts, self.offsets[ids + 1] - starts)].tobytes()


#: Where a worker process keeps what it has built; outlives the functions a task unpickles.
_KEPT = "glyphmill_worker_codecs"


def _codec(fingerprint: str, packed: bytes) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a packed vocabulary, built once per worker process; one vocabulary is kept."""
    kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__
    if kept.get("fingerprint") != fingerprint:
        vocabulary = Vocabulary.unpacked(packed)
        kept["codec"] = Encoder(vocabulary), Decoder(vocabulary)
        kept["fingerprint"] = fingerprint
    return kept["codec"]


def _parts(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """A column of texts in slices of up to ``most`` bytes, one text at least; an empty column is one slice."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    if not len(texts):
        yield texts
    while start < len(texts):
        stop = max(int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")), start + 1)
        yield texts.slice(start, stop - start)
        start = stop


def _lists(column: pa.Array) -> list[np.ndarray]:
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(column.offsets.to_numpy()[:-1], column.offsets.to_numpy()[1:])]


def encode(vocabulary: Vocabulary, text: Column | str, packed: bool = False, decoded: bool = True) -> Column:
    """``struct<ids, decoded>`` of a text: its token ids and the text they decode to; null is the empty text.

    Ids are an ``array<int>``, or with ``packed`` a binary of little-endian unsigned 32-bit integers.
    One function gives both, so that no plan encodes a text twice; without ``decoded`` that field is null.
    """
    id_type = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    fingerprint, tables = vocabulary.fingerprint, vocabulary.packed()

    @F.arrow_udf(T.StructType([T.StructField("ids", id_type), T.StructField("decoded", T.StringType())]))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = _codec(fingerprint, tables)
        for batch in batches:
            for texts in _parts(batch, ENCODED):
                yield coded(texts, encoder, decoder)
            # What the batch took is given back, so that an idle worker holds its tables only.
            pa.default_memory_pool().release_unused()

    def coded(texts: pa.Array, encoder: Encoder, decoder: Decoder) -> pa.Array:
        parts = encoder.encode_texts([t or "" for t in texts.to_pylist()])
        lists = [np.frombuffer(p, np.dtype("<u4")) for p in parts]
        back = [(decoder.decode(x) if len(x) else b"") if decoded else None for x in lists]
        if packed:
            ids = pa.array(parts, pa.binary())
        else:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))
        return pa.StructArray.from_arrays([ids, pa.array(back, pa.binary()).cast(pa.string())], ["ids", "decoded"])

    return run(text)


def decode(vocabulary: Vocabulary, ids: Column | str) -> Column:
    """The text of an array of token ids; null ids count as none."""

    fingerprint, tables = vocabulary.fingerprint, vocabulary.packed()

    @F.arrow_udf(T.StringType())
    def run(column: pa.Array) -> pa.Array:
        decoder = _codec(fingerprint, tables)[1]
        return pa.array([decoder.decode(x) if len(x) else b"" for x in _lists(column)], pa.binary()).view(pa.string())

    return run(ids)


def tokenised(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", packed: bool = False) -> DataFrame:
    """``(row, ids, decoded)``: each row as a struct, its token ids and the text they decode to.

    Null and empty texts have no ids. Rows are a map: repeated rows each give one, extra columns
    stay inside ``row``, whatever their names; an empty table gives an empty one.
    """
    rows = small_batches(docs).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        encode(vocabulary, F.col(f"`{text}`"), packed).alias("coded"),
    )
    return rows.select("row", "coded.ids", "coded.decoded")


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))


def digests(rows: DataFrame) -> DataFrame:
    return rows.select(
        "row.doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(tokenised(docs, default_vocabulary(), packed=True))
