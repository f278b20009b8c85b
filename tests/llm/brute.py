"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SEPARATED = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def shingles(text: str | None, width: int = 5) -> frozenset:
    w = SEPARATED.findall((text or "").translate(LOWER))
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def components(rows: list[tuple[int | None, str | None]], threshold: int = 80) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]


def decontamination(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = ALNUM.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def targets(sizes: dict, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict:
    """Targets by sharing again and again, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, done, free = share * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(done.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return done | {s: level * weight[s] for s in free}
        done |= {s: most * sizes[s] for s in over}
        free -= set(over)
    return done


def top_k(vectors: list[tuple], k: int = 10) -> list[tuple]:
    """(query_id, rank, vec_id, score)."""
    import math

    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is None or i % 100:
            continue
        found = [(-sum(x * y for x, y in zip(q, v)), j is None, j) for b, (j, v) in enumerate(ok) if a != b and len(v) == len(q)]
        out += [(i, r, j, -s) for r, (s, _, j) in enumerate(sorted(found)[:k], 1)]
    return out
