"""Plain single-process versions of the corpus operators, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def find(root: dict, x):
    while root[x] != x:
        root[x] = root[root[x]]
        x = root[x]
    return x


def near_duplicates(docs: list[tuple[int, str | None]], n: int, num: int, den: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (size of the set, least id of its component), over all pairs that share an n-gram."""
    sets = {}
    for doc_id, text in docs:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    holders = defaultdict(list)
    for doc_id, grams in sets.items():
        for g in grams:
            holders[g].append(doc_id)
    shared = defaultdict(int)
    for ids in holders.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[a, b] += 1
    root = {d: d for d in sets}
    for (a, b), both in shared.items():
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(root, a), find(root, b)
            root[max(x, y)] = min(x, y)
    return {d: (len(g), find(root, d)) for d, g in sets.items()}


def substring_removal(docs: list[tuple[int, str | None]], window: int) -> list[tuple[int, int, int, str]]:
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    seen = defaultdict(int)
    for _, words in split:
        for i in range(len(words) - window + 1):
            seen[tuple(words[i : i + window])] += 1
    out = []
    for d, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((d, len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def line_removal(docs: list[tuple[int, str | None]], window: int = 3) -> dict[int, str | None]:
    first, places = {}, {}
    for d, text in sorted(docs):
        lines = (text or "").split("\n")
        full = [i for i, x in enumerate(lines) if WORD.search(x)]
        places[d] = (lines, full)
        for k in range(len(full) - window + 1):
            first.setdefault(tuple(lines[p] for p in full[k : k + window]), (d, k))
    out = {}
    for d, text in docs:
        lines, full = places[d]
        gone = set()
        for k in range(len(full) - window + 1):
            if first[tuple(lines[p] for p in full[k : k + window])] != (d, k):
                gone.update(full[k : k + window])
        out[d] = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def pieces(tokenizer, docs: list[tuple[int, str | None]], capacity: int, end_id: int) -> list[tuple[int, int, int, int, int]]:
    out = []
    for d, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        a, b, k = 0, (len(ids) - 1) % capacity + 1, 0
        while a < len(ids):
            out.append((d, k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))))
            a, b, k = b, b + capacity, k + 1
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    spans = [("assign", *m.span()) for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))
