"""Plain versions of the contracts, one text at a time, to hold the operators' results against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np

from millrace.llm.pii import luhn

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _valid(kind: str, text: str) -> bool:
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part[-400:]) <= 255 and (len(part.lstrip("0")) <= 3) for part in text.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def personal(text: str | None) -> list[tuple[str, int, int]]:
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in p.finditer(text or "") if _valid(kind, m[0])]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def personal_digest(text: str | None) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in personal(text)).encode()).hexdigest()


def quality_measures(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows: dict[tuple, list[int]] = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    hit = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(hit)


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text: str | None) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(texts: list[str | None], items: list[tuple]) -> list[tuple[int, int, list]]:
    """For each text: words, hit words, sorted ids of items with occurring windows."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = bench_words(text)
        for k in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[k : k + 13]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        words, hit, found = bench_words(text), set(), set()
        for k in range(len(words)):
            for size in sizes:
                if k + size <= len(words) and (items_of := windows.get(tuple(words[k : k + size]))):
                    hit.update(range(k, k + size))
                    found |= items_of
        out.append((len(words), len(hit), sorted(found)))
    return out


def shingles(text: str | None, k: int = 4) -> set[tuple]:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def jaccard_classes(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """For each id: size of the set and smallest id reachable by links."""
    sets = {d: shingles(t) for d, t in texts.items()}
    top = {d: d for d in sets}

    def find(d):
        while top[d] != d:
            d = top[d]
        return d

    at: dict[tuple, list] = {}
    for d, items in sets.items():
        for item in items:
            at.setdefault(item, []).append(d)
    shared: dict[tuple[int, int], int] = {}
    for ids in at.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), both in shared.items():
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    return {d: (len(items), find(d)) for d, items in sets.items()}


def packed_documents(rows: list[tuple], tokenizer) -> list[tuple[int, int, int, int]]:
    """(doc_id, start, ids with the end id, crc32) in ascending order of ids."""
    out, start = [], 0
    for doc, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def toxic_scores(rows: list[tuple], labels: list[tuple], discount: float = 0.75, strongest: int = 2) -> dict:
    """Score by (doc_id, text), from (doc_id, text) rows and (doc_id, toxic) labels of the documents to learn from. Letters and digits of spaced scripts only."""
    part = lambda d: zlib.crc32(str(d).encode()) % 3
    toxic: dict = {}
    for d, t in labels:
        if d is not None and t is not None and part(d) != 1:
            toxic[d] = max(t, toxic.get(d, 0))
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    texts = [(d, t, words(t)) for d, t in rows]

    def model(kept):
        counts = [{}, {}]
        for d, _, own in texts:
            if d in toxic and kept(d):
                for w in set(own):
                    counts[toxic[d]][w] = counts[toxic[d]].get(w, 0) + 1
        total = [sum(c.values()) for c in counts]
        spare = [sum(min(n, discount) for n in c.values()) for c in counts]
        different = len({*counts[0], *counts[1]})

        def ratio(w):
            shared = (counts[0].get(w, 0) + counts[1].get(w, 0) + 0.5) / (sum(total) + different / 2)
            p = [max(counts[k].get(w, 0) - discount, 0) / total[k] + spare[k] / total[k] * shared for k in (0, 1)]
            return math.log(p[1]) - math.log(p[0])

        return ratio

    def signs(ratio, own):
        best = sorted((ratio(w) for w in set(own)), reverse=True)[:strongest]
        best += [ratio("")] * (strongest - len(best))
        return sum(best) / strongest, sum(map(ratio, own)) / max(1, len(own))

    def logistic(x, y):
        x = np.array([[*v, 1.0] for v in x])
        y, w, pull = np.array(y, float), np.zeros(3), np.diag([0.1, 0.1, 0])
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + pull, x.T @ (p - y) + pull @ w)
            w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        return w

    known = model(lambda d: part(d) != 2)
    second = [(d, own) for d, _, own in texts if d in toxic and part(d) == 2]
    step = lambda v: (math.floor(v / 0.02) + 0.5) * 0.02
    w = logistic([[step(v) for v in signs(known, own)] for _, own in second], [toxic[d] for d, _ in second])
    full = model(lambda d: True)
    return {(d, t): 1 / (1 + math.exp(-float(np.dot(w, [*signs(full, own), 1.0])))) for d, t, own in texts}
