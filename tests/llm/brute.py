"""Plain versions of the document operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

SPACES = "[\x20\x09-\x0d]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, fold=True):
    text = (text or "").translate(FOLD) if fold else (text or "")
    return [w for w in re.split(SPACES, text) if w]


def part(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def kneser_ney(rows):
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of (doc_id, text) rows."""
    tokens = [(d, [*words(t), "</s>"]) for d, t in rows]
    train = [t for d, t in tokens if part(d, 10)]
    uni, bi = Counter(), Counter()
    for t in train:
        uni.update(t)
        bi.update(zip(["<s>", *t[:-1]], t))
    total, types = sum(uni.values()), len(uni)
    before = Counter(w for _, w in bi)
    classes = defaultdict(lambda: [0, 0, 0])
    for (v, _), c in bi.items():
        classes[v][min(c, 3) - 1] += 1
    context = Counter({v: sum(c for (x, _), c in bi.items() if x == v) for v in classes})

    def discounts(values):
        n1, n2, n3, n4 = (sum(v == i for v in values) for i in (1, 2, 3, 4))
        if not n1 or not n2:
            return 0.5, 0.75, 0.9
        y = n1 / (n1 + 2 * n2)
        d2 = 2 - 3 * y * n3 / n2
        d = (1 - 2 * y * n2 / n1, d2, 3 - 4 * y * n4 / n3 if n3 else d2)
        return tuple(min(max(x, 0.05), top - 0.05) for x, top in zip(d, (1.0, 2.0, 3.0)))

    d, e = discounts(list(bi.values())), discounts(list(before.values()))
    n_pairs = len(bi)
    mass = sum(e[min(c, 3) - 1] for c in before.values())

    def low(w):
        if not n_pairs:
            return 1 / (types + 1)
        c = before[w]
        return (max(c - (e[min(c, 3) - 1] if c else 0), 0) + mass / (types + 1)) / n_pairs

    def p(v, w):
        if v not in classes:
            return low(w)
        c = bi[v, w]
        gamma = sum(x * n for x, n in zip(d, classes[v])) / context[v]
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / context[v] + gamma * low(w)

    out = []
    for doc, t in tokens:
        base = sum(math.log10((uni[w] + 0.1) / (total + 0.1 * (types + 1))) for w in t)
        score = sum(math.log10(p(v, w)) for v, w in zip(["<s>", *t[:-1]], t))
        out.append((doc, len(t), sum(uni[w] > 0 for w in t), total, base, score))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def rule_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def figures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text, fold=False)
    seen, covered = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)), set()
    for k in range(len(w) - 4):
        if seen[tuple(w[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def binomial_tail(k, n, rate):
    rate = Fraction(rate)
    return float(sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1)))


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def components(rows, least_percent=85):
    """component_id by place of (doc_id, text) rows with ids."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in where[g])
        for j, n in common.items():
            if 100 * n >= least_percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            where[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(rows))], [len(s) for s in sets]


def cut_strings(rows, length=50):
    """n_bytes, n_removed, n_spans, kept bytes of (doc_id, text) rows."""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for p in range(len(b) - length + 1):
                s = b[p : p + length]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if d is not None and first[b[p : p + length]] < d:
                gone[p : p + length] = b"\1" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


def planted_words(doc_id, ws):
    """The words of a document after its planted repetition."""
    n, h = len(ws), zlib.crc32(str(doc_id).encode())
    if doc_id is None or not n or h % 10:
        return ws
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def runs(ws, least=24, times=3):
    """(start, length, period) of all runs, by start, then period."""
    best = {}
    for q in range(1, len(ws) // times + 1):
        low = 0
        for i in range(len(ws) - q + 1):
            if i == len(ws) - q or ws[i] != ws[i + q]:
                if i - low + q >= max(least, times * q):
                    best.setdefault((low, i - low + q), q)  # the smallest period comes first
                low = i + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(doc_id, text, plant=True):
    """The row of the runs query without its id, and the kept words."""
    ws = words(text, fold=False)
    ws = planted_words(doc_id, ws) if plant else ws
    found = runs(ws)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
    top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    shown = sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode())
    return (len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2], shown, sha(kept.encode())), kept


def vocabulary(rows, plant=True):
    out = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(FOLD)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if plant and h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if n >= 2 and len(w) >= 7}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(count):
    """word, form, root, n, n_near, form_n of a vocabulary."""
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 10 * count[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), form[w] and count[form[w]]) for w, n in count.items())


def cut_windows(rows, size=13):
    """n_words, n_removed, kept words of (doc_id, text) rows."""
    first = {}
    for d, t in rows:
        ws = words(t, fold=False)
        if d is not None:
            for i in range(len(ws) - size + 1):
                g = tuple(ws[i : i + size])
                first[g] = min(first.get(g, d), d)
    out = []
    for d, t in rows:
        ws = words(t, fold=False)
        gone = {i + k for i in range(len(ws) - size + 1) if d is not None and first[tuple(ws[i : i + size])] < d for k in range(size)}
        out.append((len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out
