"""Plain definitions the operators are held against; written for clarity, used on small inputs only."""

from __future__ import annotations

import hashlib
import re

SECRETS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, re.A | re.I),
    ("access", r"AKIA[A-Z0-9]+", 20, 0, re.A),
    ("hex", r"[0-9a-f]+", 24, 0, re.A),
)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text: str | None) -> list[tuple[str, int, int]]:
    found = [
        (m.start(), k, kind, m.end())
        for k, (kind, pattern, least, group, flags) in enumerate(SECRETS)
        for m in re.finditer(pattern, text or "", flags)
        if m.end(group) - m.start(group) >= least
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text: str | None) -> int:
    import xxhash

    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def components(prints: list[int], distance: int = 3) -> list[int]:
    """Per fingerprint the position of the first one reachable."""
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, found, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        level = budget / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            return found | {s: level * weight[s] for s in open_}
        found |= {s: float(most * sizes[s]) for s in above}
        budget -= sum(most * sizes[s] for s in above)
        open_ -= above
    return found


def least_capacity(sizes: list[int], shards: int) -> int:
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, (low + high) // 2
        for size in sizes:
            if size > room:
                used, room = used + 1, middle
            room -= size
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low
