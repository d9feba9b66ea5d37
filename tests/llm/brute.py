"""Plain versions of operators, for comparison on small tables."""

from __future__ import annotations


def sets_and_components(rows: list[tuple], words: int, percent: int = 80) -> list[tuple]:
    """(id, size of the shingle set, smallest linked id) of (id, text) rows, all pairs compared."""
    sets = []
    for _, text in rows:
        own = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        k = min(words, len(own))
        sets.append({tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set())
    best = [i for i, _ in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and None not in (rows[a][0], rows[b][0]):
                links.append((a, b))
    moved = True
    while moved:
        moved = False
        for a, b in links:
            if best[a] != best[b]:
                best[a] = best[b] = min(best[a], best[b])
                moved = True
    return [(i, len(s), c) for (i, _), s, c in zip(rows, sets, best, strict=True)]


def runs(words: list) -> list[tuple[int, int, int]]:
    """(start, end, period) of maximal runs, by trying every period."""
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def negatives(rows: list[tuple], every: int = 100, positives: int = 5, wanted: int = 10) -> list[tuple]:
    """(anchor, positive, rank, negative, scores) of (id, label, vector) rows, all scores computed."""
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, lab, [*v, *[0.0] * (width - len(v))]) for i, lab, v in rows]
    out = []
    for anchor, label, vector in rows:
        if anchor % every:
            continue
        scored = sorted((-int(sum(x * y for x, y in zip(vector, v, strict=True))), i, lab) for i, lab, v in rows)
        best = [(-s, i) for s, i, lab in scored if lab == label and i != anchor][:positives]
        for score, positive in best:
            own = [(-s, i) for s, i, lab in scored if lab != label and 30 * score <= 100 * -s <= 90 * score][:wanted]
            out += [(anchor, positive, k + 1, i, score, s) for k, (s, i) in enumerate(own)]
    return out
