"""Plain restatements of the algorithms, for comparison on small fixtures."""

import re
from collections import Counter

# The Unicode White_Space code points.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
WHITE_SPACE += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = re.compile(f"[{''.join(map(chr, WHITE_SPACE))}]+")


def words(text):
    return [w for w in WS.split(text) if w]


def word_counts(texts):
    return Counter(w for t in texts if t is not None for w in words(t))


def merge(tokens, left, right):
    i, out = 0, []
    while i < len(tokens):
        if tokens[i : i + 2] == [left, right]:
            out.append(left + right)
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


def train(counts, n):
    table = [([bytes([b]) for b in w.encode()], f) for w, f in counts.items()]
    learned = []
    for _ in range(n):
        pairs = Counter()
        for tokens, freq in table:
            for pair in zip(tokens, tokens[1:]):
                pairs[pair] += freq
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        learned.append((*best, pairs[best]))
        table = [(merge(t, *best), f) for t, f in table]
    return learned


def encode(merges, text):
    ids = {bytes([b]): 4 + b for b in range(256)}
    for rank, (left, right) in enumerate(merges):
        ids.setdefault(left + right, 260 + rank)
    out = []
    for word in words(text):
        tokens = [bytes([b]) for b in word.encode()]
        for left, right in merges:
            tokens = merge(tokens, left, right)
        out += [ids[t] for t in tokens] + [36]
    return out[:-1]


def decode(merges, ids):
    vocab = [b"<PAD>", b"<UNK>", b"<BOS>", b"<EOS>"] + [bytes([b]) for b in range(256)]
    vocab += [left + right for left, right in merges]
    data = b"".join(vocab[i] for i in ids if i not in (0, 2, 3) and 0 <= i < len(vocab))
    return data.decode("utf-8", "replace")
