"""Plain Python versions of the operators, written from their definitions, for small inputs."""
from __future__ import annotations

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_spans(text: str | None) -> list[tuple[str, int, int]]:
    def ok(kind: str, m: str) -> bool:
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 12 <= len(d) <= 19 and luhn(d)
        return kind != "phone" or 9 <= len(d) <= 15
    found = [(m.start(), n, m.end()) for n, (k, p) in enumerate(PII.items()) for m in re.finditer(p, text or "") if ok(k, m[0])]
    return [(list(PII)[n], a, b) for a, n, b in sorted(found)]


def quality_counts(text: str | None) -> tuple[int, int, int, int, int]:
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    joined = "".join(words)
    return len(words), len(joined), sum(c in "#*$%&|<>" for c in joined), len(lines) - len(set(lines)), len(covered)


def url_parts(url: str | None) -> tuple[str, str]:
    if "://" not in (url or ""):
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def url_rule(host: str, path: str, rules) -> tuple[str | None, str | None]:
    fits = []
    for verdict, rule in rules:
        at, _, rest = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def bag(text: str | None) -> collections.Counter:
    w = WORD.findall((text or "").lower())
    if len(w) < 5:
        return collections.Counter([tuple(w)] if w else [])
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def near_classes(rows: list[tuple[int, str | None]], threshold: float = 0.8) -> dict[int, int]:
    """doc_id -> smallest doc_id of its class, comparing all pairs of distinct texts."""
    texts = sorted({t or "" for _, t in rows})
    bags, parent = [bag(t) for t in texts], list(range(len(texts)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] | bags[j]).values())
            if both and sum((bags[i] & bags[j]).values()) / both >= threshold:
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[find(texts.index(t or ""))].append(d)
    return {d: min(g) for g in groups.values() for d in g}


def leaks(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], window: int = 8) -> set[tuple[int, int]]:
    """(doc_id, item_id) for texts without numbers or names: matched windows cover half of the item."""
    norm = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    out = set()
    for i, it in items:
        w = norm(it)
        k = min(window, len(w))
        if len(w) < 4:
            continue
        for d, dt in docs:
            v = norm(dt)
            at = collections.defaultdict(set)
            for a in range(len(w) - k + 1):
                for b in range(len(v) - k + 1):
                    if w[a:a + k] == v[b:b + k]:
                        at[b - a] |= set(range(a, a + k))
            if any(2 * len(c) >= len(w) for c in at.values()):
                out.add((d, i))
    return out
