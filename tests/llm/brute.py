"""Plain versions of the operators' contracts, on lists of (doc_id, text)."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
KINDS = ("email", "ip", "card", "phone")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    """Base spans (start, kind number, end)."""
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def shingle_set(text, k):
    w = SPACE_WORDS.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near(rows, k, percent):
    """doc_id -> (set size, component)."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = Counter()
    for ids in holders.values():
        common.update(itertools.combinations(sorted(ids), 2))
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def contamination(text, items, span=10):
    """(n_words, n_hit, sorted item ids) of a text against (item_id, text) rows."""
    words = ALNUM_WORDS.findall(lower(text))
    hit, found = set(), set()
    places = defaultdict(list)
    for n in range(1, span + 1):
        for i in range(len(words) - n + 1):
            places[tuple(words[i:i + n])].append(i)
    for item, body in items:
        w = ALNUM_WORDS.findall(lower(body))
        n = min(span, len(w))
        for i in range(len(w) - n + 1) if n else ():
            for p in places.get(tuple(w[i:i + n]), ()):
                hit.update(range(p, p + n))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def quality_stats(text):
    text = text or ""
    words = SPACE_WORDS.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            repeated.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "n_lines": len(lines),
            "n_capitals": len(re.findall("[A-Z]", text))}


def base_failed(s):
    return s["n_words"] < 10 or 100 * s["n_repeat_words"] > 20 * s["n_words"]


def substring_dedup(rows, length=50):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest)."""
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            least[w] = min(least.get(w, i), i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return out


def viterbi(text, pieces, longest, unknown, byte_ids):
    """Ids of the best segmentation; pieces: text -> (id, score)."""
    if not text:
        return []
    s = "▁" + "".join("▁" if c == " " else "\U0010ffff" if c == "▁" else c for c in text)
    best = [(0.0, 0)] + [None] * len(s)
    for e in range(1, len(s) + 1):
        top = None
        for n in range(1, min(e, longest) + 1):
            p = pieces.get(s[e - n:e])
            score = p[1] if p else unknown if n == 1 else None
            if score is not None and (top is None or best[e - n][0] + score >= top[0]):
                top = (best[e - n][0] + score, n)
        best[e] = top
    out, e = [], len(s)
    while e:
        n = best[e][1]
        piece = s[e - n:e]
        if piece in pieces:
            out.append([pieces[piece][0]])
        else:
            out.append([byte_ids[b] for b in ("▁" if piece == "\U0010ffff" else piece).encode()])
        e -= n
    return [x for part in reversed(out) for x in part]
