"""The string kernels pair by pair, as the tests' brute force."""

from __future__ import annotations


def damerau(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance."""
    last: dict[str, int] = {}
    big = len(a) + len(b)
    d = [[big] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i, x in enumerate(a, 1):
        at = 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), at
            if x == y:
                at = j
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[x] = i
    return d[len(a) + 1][len(b) + 1]


def damerau_similarity(a: str, b: str) -> float:
    most = max(len(a), len(b))
    return 1 - damerau(a, b) / most if most else 1.0


def jaro_winkler(a: str, b: str) -> float:
    """Prefix weight 0.1 up to four characters, given above a Jaro of 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, hits = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                hits.append(x)
                break
    if not hits:
        return 0.0
    other = [y for j, y in enumerate(b) if used[j]]
    swaps = sum(x != y for x, y in zip(hits, other, strict=True)) / 2
    m = len(hits)
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def _indel(a: str, b: str) -> float:
    """2 x longest common subsequence over both lengths."""
    if not a and not b:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return 2 * row[-1] / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """0 to 1: the best of the three pairings of common and remaining sorted tokens; 0 if either has none."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (not x - y or not y - x):
        return 1.0
    common = " ".join(sorted(both))
    one, two = (" ".join([common, *sorted(rest)]).strip() for rest in (x - y, y - x))
    pairs = [(one, two)] + [(common, one), (common, two)] * bool(both)
    return max(_indel(*p) for p in pairs)
