"""PPM with escape method D and exclusion, symbol by symbol, straight from its definition."""

import math
from collections import Counter, defaultdict


def symbols(text, order):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in low.encode().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(
        b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w]
    return [0xFE] * order + list(b" ".join(words)) + [0xFF], words


def train(texts, order):
    contexts = defaultdict(Counter)
    for t in texts:
        s, _ = symbols(t, order)
        for i in range(order, len(s)):
            for k in range(order + 1):
                contexts[tuple(s[i - k:i])][s[i]] += 1
    return contexts


def log10_probability(contexts, text, order):
    s, _ = symbols(text, order)
    total = 0.0
    for i in range(order, len(s)):
        excluded, p = set(), 1.0
        for k in range(order, -1, -1):
            seen = contexts.get(tuple(s[i - k:i]))
            if not seen:
                continue
            left = {x: n for x, n in seen.items() if x not in excluded}
            whole = 2 * sum(left.values())
            if s[i] in left:
                p *= (2 * left[s[i]] - 1) / whole
                break
            if left:
                p *= len(left) / whole
            excluded |= set(seen)
        else:
            p /= 255 - len(excluded)
        total += math.log10(p)
    return total
