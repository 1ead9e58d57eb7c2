"""Plain Python restatements of the corpus operators' contracts, to hold small results against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def _join(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], kinds.index(x[2]))))


def secrets(text):
    t, kinds, out = text or "", ("assign", "access", "hex"), []
    name = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    for m in re.finditer(rf"({name}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t):
        if len(m[2]) >= 8:
            out.append((m.start(), m.end(), "assign"))
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    c = Counter(x[2] for x in out)
    return c["assign"], c["access"], c["hex"], sha(_join(out, kinds))


def luhn(d):
    return sum((x := int(c) * (1 + i % 2)) - 9 * (x > 9) for i, c in enumerate(reversed(d))) % 10 == 0


def pii(text):
    t, kinds, out = text or "", ("email", "ip", "card", "phone"), []
    out += [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        if 12 <= len(d := re.sub(r"\D", "", m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    c = Counter(x[2] for x in out)
    return *(c[k] for k in kinds), sha(_join(out, kinds))


def warc(pages):
    """pages: (page_id, html) -> page_id: (bytes, digest, type, refers_to)."""
    data = {i: (h or "").encode() for i, h in pages}
    last = {}
    for i, d in data.items():
        if len(d) >= 1000:
            last[d] = max(i, last.get(d, i))
    return {i: (len(d), hashlib.sha1(d).hexdigest(), *(("revisit", last[d]) if last.get(d, i) != i else ("response", None))) for i, d in data.items()}


def decontamination(docs, items):
    """(doc_id, text) and (item_id, text) -> rows of op3."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = word.findall(low(t))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = word.findall(low(t)), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if x := windows.get(tuple(w[k : k + m])):
                    hit |= set(range(k, k + m))
                    found |= x
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def quality(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(docs):
    """(doc_id, text) -> (doc_id, n_shingles, component_id)."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    having = {}
    for i, s in sets.items():
        for g in s:
            having.setdefault(g, []).append(i)
    done = set()
    for own in having.values():
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                if (a, b) not in done:
                    done.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                        x, y = sorted((find(a), find(b)))
                        parent[y] = x
    return [(i, len(s), find(i)) for i, s in sets.items()]


def chat(rows):
    """(conv_id, turn, role, text) -> conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)."""
    by = {}
    for c, k, r, t in rows:
        by.setdefault(c, []).append((k, r, t or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(said), sha(said)
    return out


def held(doc_id, n, remainder):
    return zlib.crc32(str(doc_id).encode()) % n == remainder


def near(docs, n, percent):
    """(doc_id, text) -> (doc_id, size of its set of n-word shingles, smallest doc_id reachable by links of percent)."""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", low(t)) for i, t in docs}
    sets = {i: {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set() for i, w in words.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [(i, len(s), find(i)) for i, s in sets.items()]


def lloyd(rows, first, rounds):
    """Integer vectors and starting points -> (index of the nearest point, squared distance) of each vector, and the points, after some rounds."""
    points = [list(p) for p in first]
    nearest = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, p, strict=True)), i) for i, p in enumerate(points))
    for _ in range(rounds):
        own = {}
        for v in rows:
            own.setdefault(nearest(v)[1], []).append(v)
        for i, vs in own.items():
            points[i] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    return [nearest(v)[::-1] for v in rows], points


def clusters(rows, k, rounds, scale, seed=1):
    """(vec_id, vector) -> rows of op12."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    first = sorted((sha(f"{seed}:{i}"), v) for i, v in kept if i is not None)[:k]
    found, points = lloyd([v for _, v in kept], [v for _, v in first], rounds)
    inertia = Counter()
    for c, d in found:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), sha(",".join(map(str, points[c])))) for (i, _), (c, d) in zip(kept, found, strict=True)]


def codes(rows, parts, entries, rounds, scale):
    """(vec_id, label, vector) -> rows of op13."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows]
    first, width = sorted((i, v) for i, _, v in kept if i is not None)[:entries], len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    found = [lloyd([cut(v, p) for *_, v in kept], [cut(v, p) for _, v in first], rounds) for p in range(parts)]
    digest = sha(",".join(str(x) for _, points in found for e in points for x in e))
    error = [sum(f[0][k][1] for f in found) for k in range(len(kept))]
    by = Counter()
    for (_, lab, _), e in zip(kept, error, strict=True):
        by[lab] += e
    return [(i, "".join(f"{f[0][k][0]:02x}" for f in found), error[k], by[lab], digest) for k, (i, lab, _) in enumerate(kept)]


def clause_patterns(symbols):
    """Symbols of a clause -> its matched patterns, by looking around each insult (I) and threat (H)."""
    out = []
    for i, s in enumerate(symbols):
        if s not in ("I", "H"):
            continue
        if "N" in symbols[max(0, i - 5) : i]:
            out.append(s + "-")
        elif "R" in symbols[:i]:
            out.append(s + "~")
        elif "T" in symbols[max(0, i - 5) : i] or "T" in symbols[i + 1 : i + 5]:
            out.append(s + "@")
        else:
            out.append(s)
    return out


def toxicity(text, model, fixed):
    """Score of a text by a model; fixed has the transducers' own words."""
    entries = {e: ("T", 0.0) for e in fixed.TARGETS} | {e: ("N", 0.0) for e in fixed.NEGATIONS} | {e: ("R", 0.0) for e in fixed.REPORTS}
    entries |= {e: ("H", 1.0) for e in (*fixed.THREATS, *fixed.THREAT_PHRASES)} | {e: ("I", w) for e, w in model["insults"].items()}
    longest = max(len(e.split()) for e in entries)
    clauses = re.split(r"[.!?;:\n]+", (text or "").lower())
    in_clauses, matched, most, heaviest = Counter(), 0, 0, 0.0
    for c in clauses:
        words, symbols, weight, i = re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", c), [], 0.0, 0
        while i < len(words):
            for k in range(min(longest, len(words) - i), 0, -1):
                if (e := entries.get(" ".join(words[i : i + k]))) is not None:
                    break
            else:
                e, k = ("w", 0.0), 1
            symbols.append(e[0])
            weight, i = weight + e[1], i + k
        if found := clause_patterns(symbols):
            matched, most = matched + 1, max(most, len(found))
            if any(f[-1] not in "-~" for f in found):
                heaviest = max(heaviest, weight)
            in_clauses.update(set(found))
    order = ("I", "I@", "I-", "I~", "H", "H@", "H-", "H~")
    f = [*(math.log1p(in_clauses[p]) for p in order), float(matched > 0), 10 * matched / (len(clauses) + 5) if matched else 0.0, heaviest, math.log1p(most)]
    z = sum(w * x for w, x in zip(model["weights"], f, strict=True)) + model["bias"]
    return 1 / (1 + math.exp(-z))


def language_vector(text, idf, bits=14):
    """{feature: value} of a text's character n-grams; empty without a letter."""
    if not text or not any(c.isalpha() for c in text):
        return {}
    s = f" {re.sub(r'[\W\d_]+', ' ', text).lower().strip()} "
    n = Counter()
    for size in (1, 2, 3):
        for i in range(len(s) - size + 1):
            code = 0
            for c in s[i : i + size]:
                code = code << 21 | ord(c)
            n[((code * 0x9E3779B97F4A7C15 + size - 1) % (1 << 64)) >> (64 - bits)] += 1
    v = {k: (1 + math.log(c)) * idf[k] for k, c in n.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / norm for k, x in v.items()}


def language(text, model, dim):
    """(lang_pred, score) of a text by a model."""
    v = language_vector(text, model["idf"])
    if not v:
        return "und", 0.0
    z = [(sum(w[k] * x for k, x in v.items()) + w[dim]) / model["temperature"] for w in model["weights"]]
    e = [math.exp(x - max(z)) for x in z]
    k = e.index(max(e))
    return model["langs"][k], e[k] / sum(e)


def ftrl(rows, classes, alpha, beta, l1, l2):
    """Weights {(class, feature): w} after rows ({feature: value}, class), one coordinate after the other."""
    z, n = Counter(), Counter()

    def w(k):
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    for v, y in rows:
        scores = [sum(w((c, f)) * x for f, x in v.items()) for c in range(classes)]
        e = [math.exp(s - max(scores)) for s in scores]
        grads = {(c, f): (e[c] / sum(e) - (c == y)) * x for c in range(classes) for f, x in v.items()}
        for k, g in grads.items():
            old = w(k)
            z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha * old
            n[k] += g * g
    return {k: w(k) for k in z}
