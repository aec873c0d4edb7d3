"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def substring_dedup(rows, length=35):
    """[(doc_id, n_words, n_removed, sha256)] of (doc_id, text) rows."""
    docs = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[s:s + length]) for _, w in docs for s in range(len(w) - length + 1))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if seen[tuple(w[s:s + length])] > 1:
                gone[s:s + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def lower_ascii(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def shingles(text, n=5):
    w = words(lower_ascii(text))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def classes(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def jaccard(rows):
    """[(doc_id, n_shingles, component_id)] of (doc_id, text) rows."""
    sets = {i: shingles(t) for i, t in rows}
    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    common = Counter()
    for ids in at.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                common[a, b] += 1
    links = [(a, b) for (a, b), n in common.items()
             if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    c = classes(sets, links)
    return [(i, len(s), c[i]) for i, s in sets.items()]


def jaccard_links(rows):
    """{doc_id: n_links} of (doc_id, text) rows, every two of them compared."""
    sets, count = {i: shingles(t) for i, t in rows}, Counter()
    for a, x in sets.items():
        for b, y in sets.items():
            k = len(x & y)
            count[a] += a != b and k > 0 and 100 * k >= 75 * (len(x) + len(y) - k)
    return {i: count[i] for i in sets}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)


def secret_base(text):
    """(n_assign, n_access, n_hex, listing)."""
    t = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    n = Counter(k for _, k, _ in spans)
    text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return n[0], n[1], n[2], text


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(hit))


def embeddings(rows, least=0.98):
    """{vec_id: (n_links, component_id)} of (vec_id, vector, label) rows."""
    import numpy as np

    good, out = [], {}
    for i, v, label in rows:
        out[i] = (0, i)
        if v is None or label is None or i is None or len(v) == 0 or any(c is None for c in v):
            continue
        x = np.array(v, np.float64)
        if np.isfinite(x).all() and x.any():
            good.append((i, x / np.linalg.norm(x), label))
    links, count = [], Counter()
    for label in {g[2] for g in good}:
        for dim in {len(g[1]) for g in good if g[2] == label}:
            own = [g for g in good if g[2] == label and len(g[1]) == dim]
            x = np.stack([g[1] for g in own])
            for a in range(len(own)):
                for b in np.flatnonzero(x[a] @ x.T >= least):
                    if b != a:
                        count[own[a][0]] += 1
                        links.append((own[a][0], own[b][0]))
    c = classes([i for i in out if i is not None], links)
    return {i: (count[i], c.get(i)) for i in out}


# -- 13 ------------------------------------------------------------------------

def damage(rows):
    """(conv_id, turn, role, text) -> the damaged rows."""
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        deal = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if deal == 1:
            text = ""
        if deal == 2:
            text = re.sub("[.!?]", "", text)
        if deal == 4:
            role = "user"
        out += [] if deal == 0 else [(c, t, role, text)] * (2 if deal == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit, repaired lines) over all edits of (role, text, must go, cut off),
    every string of edits kept until its row is done."""
    alive = {("", ()): 0}                                  # (initials so far, edits) -> cost; lines by replay
    done = {}
    for role, _, goes, cut in rows:
        new = {}

        def put(k, v):
            new[k] = min(v, new.get(k, 1 << 60))

        for (seen, edits), cost in alive.items():
            for n in range(3):                             # inserts before the row
                s, at = seen, cost + 3 * n
                for _ in range(n):
                    s += "a" if s[-1:] == "u" else "u"
                e = edits + ("I",) * n
                put((s, (*e, "D")), at + 4)
                if not goes:
                    put((s + role[:1], (*e, "K")), at + 3 * cut)
                    for r in "ua":
                        put((s + r, (*e, "R")), at + 3 + 3 * cut)
        # a prefix of a legal sequence, told by its last initial and whether anything was said
        best = {}
        for (s, e), cost in new.items():
            if re.fullmatch("(s?(ua)*u?)?", s):
                k = (s[-1:], len(s) > 1)
                best.setdefault(k, []).append((cost, "".join(e), s))
        alive = {}
        for k, found in best.items():
            least = min(f[0] for f in found)
            for cost, e, s in found:
                if cost == least:
                    alive[s, tuple(e)] = cost
        # among equal costs the least edits go on (none begins another)
        keep = {}
        for (s, e), cost in alive.items():
            k = (s[-1:], len(s) > 1)
            if k not in keep or "".join(e) < "".join(keep[k][0][1]):
                keep[k] = ((s, e), cost)
        alive = dict(keep.values())
    for (s, e), cost in alive.items():
        for n in range(3):
            t, at = s, cost + 3 * n
            for _ in range(n):
                t += "a" if t[-1:] == "u" else "u"
            if re.fullmatch("(s?(ua)+)?", t):
                k = (at, "".join(e) + "I" * n)
                done[k] = t
    cost, audit = min(done)
    lines, i, said = [], 0, done[cost, audit]
    for e in audit:
        row = None if e == "I" else rows[i]
        i += e != "I"
        if e == "D":
            continue
        who = said[len(lines)]
        role = row[0] if e == "K" else {"u": "user", "a": "assistant"}[who]
        lines.append(f"{role}:{row[1] if row else ''}")
    return cost, audit, "\n".join(lines)


def every_repair(rows):
    """Least (cost, audit) over all edit strings of few rows, by enumeration."""
    from itertools import product

    found = []
    per_row = [["D"] + ([] if goes else ["K", "R"]) for _, _, goes, _ in rows]
    for edits in product(*per_row):
        for gaps in product(range(3), repeat=len(rows) + 1):
            said, cost = {""}, 0
            for i, n in enumerate(gaps):
                for _ in range(n):
                    said = {s + r for s in said for r in "ua"}
                cost += 3 * n
                if i < len(rows):
                    role, _, _, cut = rows[i]
                    if edits[i] == "K":
                        said = {s + role[:1] for s in said}
                    if edits[i] == "R":
                        said = {s + r for s in said for r in "ua"}
                    cost += {"D": 4, "K": 0, "R": 3}[edits[i]] + 3 * (edits[i] != "D" and cut)
                said = {s for s in said if re.fullmatch("(s?(ua)*u?)?", s)}
            if any(re.fullmatch("(s?(ua)+)?", s) for s in said):
                audit = "".join("I" * n + e for n, e in zip(gaps, [*edits, ""]))
                found.append((cost, audit))
    return min(found)


def repairs(rows, damaged=True):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)."""
    convs = {r[0]: [] for r in rows}
    for r in damage(rows) if damaged else rows:
        convs[r[0]].append(r[1:])
    out = {}
    for c, own in convs.items():
        own = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in own]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = {t for t, *_ in own if t is not None}
        n, seen, marked = Counter(), set(), []
        for _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not end else "duplicate" if (role, text) in seen
                     else "truncated" if end[-1] not in ".!?" else None)
            seen.add((role, text))
            n[fault] += 1
            marked.append((role or " ", text, fault in ("blank", "duplicate"), fault == "truncated"))
        n["illegal"] = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked) if marked else (0, "", "")
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"],
                  n["truncated"], n["illegal"], cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


# -- 11 ------------------------------------------------------------------------

ITEM_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return ITEM_WORD.findall(lower)


def contaminated(docs, items, window=10):
    """doc_id -> (n_words, n_hit, n_items, item ids) of (id, text) rows."""
    tests = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            tests[tuple(w[s:s + k])].add(None if i is None else str(i))
    out = {}
    for i, t in docs:
        w, hit, found = item_words(t), set(), set()
        for k in {len(x) for x in tests}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in tests:
                    hit.update(range(s, s + k))
                    found |= tests[tuple(w[s:s + k])]
        out[i] = len(w), len(hit), len(found), sorted(x for x in found if x is not None)
    return out


# -- 12 ------------------------------------------------------------------------

def vocabulary(rows, typo=31, least=7):
    out = Counter()
    for i, t in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for r in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % typo == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            if len(r) >= least:
                out[r] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(n, ratio=10):
    """word -> (n, n_near, form, form_n, root), comparing all pairs."""
    by_size, form, near = defaultdict(list), {}, {}
    for w in n:
        by_size[len(w)].append(w)
    for w in n:
        own = [x for k in (-1, 0, 1) for x in by_size[len(w) + k] if one_edit(w, x)]
        best = min(own, key=lambda x: (-n[x], x), default=None)
        near[w] = len(own)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        r = w
        while form[r]:
            r = form[r]
        out[w] = n[w], near[w], form[w], n.get(form[w]), r
    return out
