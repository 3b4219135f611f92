"""Plain versions of the operators' contracts, over lists of rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def fold(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def unigram_scores(rows):
    counts, own = Counter(), {}
    for doc_id, text in rows:
        own[doc_id] = [*words(text), None]
        if fold(doc_id, 7) != 2:
            counts.update(own[doc_id])
    n, v = sum(counts.values()), len(counts)
    return {
        k: (len(x), sum(counts[w] > 0 for w in x), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in x))
        for k, x in own.items()
    }


def shingle_sets(rows):
    out = {}
    for doc_id, text in rows:
        w = words(text)
        out[doc_id] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def jaccard_groups(rows):
    sets = shingle_sets(rows)
    holders, shared = defaultdict(list), Counter()
    for doc_id, own in sets.items():
        for x in own:
            holders[x].append(doc_id)
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                shared[a, b] += 1
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k: (len(sets[k]), find(k)) for k in sets}


def base_spans(text):
    """(kind, start, end) by the rules themselves; slow on long runs."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    kinds = ["email", "ip", "card", "phone"]
    return sorted(out, key=lambda x: (x[1], kinds.index(x[0])))


def span_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def quality_base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    inside = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
    n, r = len(w), len(inside)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n)
