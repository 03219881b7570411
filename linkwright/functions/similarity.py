"""String similarity of pairs: edit-based scores as Arrow UDFs, which Spark has no function for.

lcs to jaro_winkler tell one pair's score; the UDFs tell the same of all pairs of a batch at once, with a
bit of a 64-bit word for each character and an array of such words for the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, 64 and more characters a step by whole-integer bits."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & places.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    """Normalized insert-delete similarity, 0 to 100; two empty strings are equal."""
    n = len(a) + len(b)
    return 200.0 * lcs(a, b) / n if n else 100.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """The best of common tokens against either side and of both sides; 100 if one holds the other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = sorted(x & y)
    left, right = sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    c, l, r = " ".join(both), " ".join(left), " ".join(right)
    cl, cr = f"{c} {l}".strip(), f"{c} {r}".strip()
    best = ratio(cl, cr)
    return max(best, ratio(c, cl), ratio(c, cr)) if both else best


def partial(a: str, b: str) -> float:
    """The best window of the longer string against the shorter; windows may stick out at either end."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) > len(b):
        a, b = b, a
    n, best = len(a), 0.0
    letters = set(a)
    for i in range(1 - n, len(b)):
        window = b[max(i, 0) : i + n]
        edge = window[-1] if i + n <= len(b) else window[0]
        if edge in letters:
            best = max(best, ratio(a, window))
            if best == 100.0:
                break
    return best if len(a) != len(b) or best == 100.0 else max(best, *(ratio(b, a[max(i, 0) : i + n]) for i in range(1 - n, n)))


def partial_token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    return 100.0 if x & y else partial(" ".join(sorted(x)), " ".join(sorted(y)))


def jaro(a: str, b: str) -> float:
    """Jaro similarity, 0 to 1; two empty strings are equal."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    m = len(hits)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(hits, (c for c, u in zip(b, used) if u))) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Jaro with a bonus of a tenth per equal leading letter, four at most, above 0.7."""
    s = jaro(a, b)
    if s <= 0.7:
        return s
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return s + 0.1 * prefix * (1 - s)


#: Pairs and words of bits that are worked on at once, and those of all windows of a string.
PAIRS, WORDS, WINDOW_WORDS = 1024, 1 << 20, 1 << 16
_BITS = np.append((np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1), ~np.uint64(0))


def _lengths(found: list[str]) -> np.ndarray:
    return np.fromiter(map(len, found), np.int64, len(found))


def _codes(found: list[str]) -> np.ndarray:
    """Code points and 1, a row per string, 0 beyond its end."""
    sizes = _lengths(found)
    out = np.zeros((len(found), max(1, int(sizes.max()))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    return out


def _places(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Of each character of b, by place and pair, the places in a that are equal: 64 of them a word."""
    seen = np.zeros(max(a.max(), b.max()) + 1, bool)
    seen[0] = seen[a] = seen[b] = True
    rank = np.cumsum(seen) - 1
    a, b, row = rank[a], rank[b].T, np.arange(len(a))
    out = []
    for low in range(0, a.shape[1], 64):
        at = np.zeros((len(a), rank[-1] + 1), np.uint64)
        for k in range(low, min(low + 64, a.shape[1])):
            at[row, a[:, k]] |= np.uint64(1 << k - low)
        at[:, 0] = 0
        out.append(at[row, b])
    return out


def _common(places: Callable[[int, int], np.ndarray], words: int, steps: int, shape: tuple[int, ...]) -> np.ndarray:
    """Longest common subsequences, as in lcs; places(w, k) are the k-th characters' places of word w."""
    state = [np.full(shape, ~np.uint64(0)) for _ in range(words)]
    for k in range(steps):
        carry = None
        for w in range(words):
            hit = state[w] & places(w, k)
            total = state[w] + hit
            over = total < hit
            if carry is not None:
                total += carry
                over |= total < carry
            carry = over.astype(np.uint64) if words > 1 else None
            state[w] = total | state[w] ^ hit
    return sum(np.bitwise_count(~x).astype(np.int64) for x in state)


def _runs(order: np.ndarray, cost: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """order, of ascending cost, in runs of at most PAIRS and, where one alone is not more, of this cost."""
    at = 0
    while at < len(order):
        to = min(at + PAIRS, len(order))
        while to > at + 1 and (to - at) * cost[order[to - 1]] > most:
            to = at + max(1, (to - at) // 2)
        yield order[at:to]
        at = to


def lcs_all(a: list[str], b: list[str]) -> np.ndarray:
    x, y = _lengths(a), _lengths(b)
    out = np.zeros(len(a), np.int64)
    cost = np.maximum(x, y) * (np.maximum(x, y) // 64 + 1)
    order = np.argsort(cost, kind="stable")
    for at in _runs(order[(x > 0)[order] & (y > 0)[order]], cost, WORDS):
        places = _places(_codes([a[i] for i in at]), _codes([b[i] for i in at]))
        out[at] = _common(lambda w, k: places[w][k], len(places), len(places[0]), (len(at),))
    return out


def ratio_all(a: list[str], b: list[str]) -> np.ndarray:
    n = _lengths(a) + _lengths(b)
    return np.where(n > 0, 200.0 * lcs_all(a, b) / np.maximum(n, 1), 100.0)


def token_sort_all(a: list[str], b: list[str]) -> np.ndarray:
    return ratio_all(*([" ".join(sorted(x.split())) for x in side] for side in (a, b)))


def token_set_all(a: list[str], b: list[str]) -> np.ndarray:
    """As token_set: what both sides begin with is in any longest subsequence, so only the rest is measured."""
    known = {x: frozenset(x.split()) for x in {*a, *b}}
    out, todo, common, left, right = np.zeros(len(a)), [], [], [], []
    for k, (s, t) in enumerate(zip(a, b, strict=True)):
        x, y = known[s], known[t]
        if x and y:
            both = x & y
            if both and (len(both) == len(x) or len(both) == len(y)):
                out[k] = 100.0
            else:
                todo.append(k)
                common.append(sum(map(len, both)) + max(len(both) - 1, 0))
                left.append(" ".join(sorted(x - y)))
                right.append(" ".join(sorted(y - x)))
    if todo:
        c = np.array(common, np.int64)
        first = np.where(c > 0, c + 1, 0)
        l, r = _lengths(left) + first, _lengths(right) + first
        best = 200.0 * (first + lcs_all(left, right)) / (l + r)
        out[todo] = np.where(c > 0, np.maximum(best, np.maximum(200.0 * c / (c + l), 200.0 * c / (c + r))), best)
    return out


def _windows(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of each a, all of one length, with windows of that length of b, which may stick out."""
    n, sizes = len(a[0]), _lengths(b)
    places = _places(_codes(a), _codes(b))
    # By pair and place, with nothing beyond either end.
    places = [np.pad(x.T, ((0, 0), (n - 1, n - 1))) for x in places]
    many = places[0].shape[1] - n + 1
    found = _common(lambda w, k: places[w][:, k : k + many], len(places), n, (len(a), many))
    at = np.arange(many)[None, :] - n + 1
    size = np.minimum(at + n, sizes[:, None]) - np.maximum(at, 0)
    return np.where(found > 0, 200.0 * found / np.maximum(n + size, 1), 0.0).max(1)


def partial_all(a: list[str], b: list[str]) -> np.ndarray:
    turned = [(y, x) if len(x) > len(y) else (x, y) for x, y in zip(a, b, strict=True)]
    a, b = [p[0] for p in turned], [p[1] for p in turned]
    x, y = _lengths(a), _lengths(b)
    out = np.where(y > 0, 0.0, 100.0)
    cost = (x + y) * (x // 64 + 1)
    order = np.lexsort((cost, x))
    order = order[x[order] > 0]
    for group in np.split(order, np.nonzero(np.diff(x[order]))[0] + 1) if len(order) else []:
        for at in _runs(group, cost, WINDOW_WORDS):
            out[at] = _windows([a[i] for i in at], [b[i] for i in at])
            if len(again := at[(x[at] == y[at]) & (out[at] < 100.0)]):
                out[again] = np.maximum(out[again], _windows([b[i] for i in again], [a[i] for i in again]))
    return out


def partial_token_set_all(a: list[str], b: list[str]) -> np.ndarray:
    known = {x: frozenset(x.split()) for x in {*a, *b}}
    sets = [(known[s], known[t]) for s, t in zip(a, b, strict=True)]
    out = np.array([100.0 if x & y else 0.0 for x, y in sets])
    if todo := [k for k, (x, y) in enumerate(sets) if x and y and not x & y]:
        out[todo] = partial_all(*([" ".join(sorted(sets[k][side])) for k in todo] for side in (0, 1)))
    return out


def _jaro(a: list[str], b: list[str]) -> np.ndarray:
    """As jaro, of pairs without an empty string: each character of a takes the first equal one in reach."""
    x, y = _lengths(a), _lengths(b)
    ca, cb = _codes(a), _codes(b)
    places = _places(cb, ca)
    reach = np.maximum(np.maximum(x, y) // 2 - 1, 0)
    used, hits = [np.zeros(len(a), np.uint64) for _ in places], np.zeros(ca.shape, bool)
    for i in range(ca.shape[1]):
        for w, place in enumerate(places):
            low, high = (_BITS[np.clip(z - 64 * w, 0, 64)] for z in (i - reach, i + reach + 1))
            free = place[i] & high & ~low & ~used[w]
            free[hits[:, i]] = 0
            used[w] |= free & (~free + np.uint64(1))
            hits[:, i] |= free > 0
    taken = np.concatenate([(u[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(bool) for u in used], 1)[:, : cb.shape[1]]
    m = hits.sum(1)
    swaps = np.bincount(np.nonzero(hits)[0], ca[hits] != cb[taken], len(a)).astype(np.int64) // 2
    return np.where(m > 0, (m / x + m / y + (m - swaps) / np.maximum(m, 1)) / 3, 0.0)


def jaro_winkler_all(a: list[str], b: list[str]) -> np.ndarray:
    x, y = _lengths(a), _lengths(b)
    out = np.array([1.0 if s == t else 0.0 for s, t in zip(a, b, strict=True)])
    cost = np.maximum(x, y) * (np.maximum(x, y) // 64 + 1)
    order = np.argsort(cost, kind="stable")
    for at in _runs(order[((out < 1) & (x > 0) & (y > 0))[order]], cost, WORDS):
        out[at] = _jaro([a[i] for i in at], [b[i] for i in at])
    first = np.array([next((k for k, (c, d) in enumerate(zip(s[:4], t[:4])) if c != d), min(len(s), len(t), 4)) for s, t in zip(a, b, strict=True)], np.int64)
    return np.where(out > 0.7, out + 0.1 * first * (1 - out), out)


def _over(function: Callable[[list[str], list[str]], np.ndarray]):
    @F.pandas_udf(DoubleType())
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        pairs = list(zip(a.fillna(""), b.fillna("")))
        known = {p: k for k, p in enumerate(dict.fromkeys(pairs))}
        if not known:
            return pd.Series([], dtype="float64")
        found = function([p[0] for p in known], [p[1] for p in known])
        return pd.Series(found[[known[p] for p in pairs]], dtype="float64")

    return score


ratio_udf, token_sort_udf, token_set_udf = _over(ratio_all), _over(token_sort_all), _over(token_set_all)
partial_udf, partial_token_set_udf, jaro_winkler_udf = _over(partial_all), _over(partial_token_set_all), _over(jaro_winkler_all)
