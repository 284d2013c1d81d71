"""Plain-Python versions of the operators' contracts."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [l for l in t.split("\n") if WORD.search(l)]
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {p for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    symbols = len(re.findall(r"[#*$%&|<>]", t))
    chars, n = sum(map(len, w)), len(w)
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    passed = not (
        100 * symbols > 10 * n or chars < 3 * n or chars > 10 * n or 100 * dup > 40 * len(lines)
        or 100 * len(re.findall("[A-Z]", t)) > 30 * chars
    )
    return n, chars, symbols, dup, len(covered), failed, passed and not failed


def luhn(digits):
    each = [int(c) if i % 2 == 0 else int(c) * 2 - (9 if int(c) > 4 else 0) for i, c in enumerate(reversed(digits))]
    return sum(each) % 10 == 0


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)).encode()).hexdigest()


def personal(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [sum(o[2] == k for o in out) for k in ("email", "ip", "card", "phone")] + [digest(out)]


def redacted(text, spans):
    """The text with the union of overlapping spans replaced; ``spans`` as the operator prints them."""
    if text is None:
        return None
    at = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x)]
    out, done, i = "", 0, 0
    while i < len(at):
        start, end, kind = at[i]
        i += 1
        while i < len(at) and at[i][0] < end:
            end = max(end, at[i][1])
            i += 1
        out += text[done:start] + f"<{kind.upper()}>"
        done = end
    return out + text[done:]


def secrets(text):
    t, out = text or "", []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, t, re.A | re.I):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return [sum(o[2] == k for o in out) for k in ("assign", "access", "hex")] + [digest(out)]


def licence_base(text, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    found = sorted(
        (i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()
    )
    places = [i for i, _ in found]
    labels = ",".join(sorted({l for _, l in found}))
    return len(w), len(found), min(places, default=None), max(places, default=None), labels


def shingle_set(text):
    w = WORD.findall(lowered(text))
    if len(w) >= 5:
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def near_components(texts, percent=85):
    """id -> (size of its set, smallest id reachable)."""
    sets = {k: shingle_set(t) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for k in sorted(sets):
        common = collections.Counter(other for s in sets[k] for other in holders[s])
        for other, n in common.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[other]) - n):
                a, b = sorted((root(k), root(other)))
                parent[b] = a
        for s in sets[k]:
            holders[s].append(k)
    return {k: (len(sets[k]), root(k)) for k in sets}


def targets(sizes, weights=(5, 2, 1), most=3):
    """source -> target, by rounds of sharing over the open sources."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, open_ = {}, set(order)
    while open_:
        rest = sum(sizes.values()) - sum(fixed.values())
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if rest * weight[s] / total > most * sizes[s]}
        if not above:
            return fixed | {s: rest * weight[s] / total for s in open_}
        fixed |= {s: most * sizes[s] for s in above}
        open_ -= above
    return fixed


def fits(host, path, rules):
    best = None
    for rule in rules:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            best = rule if best is None or len(rule) > len(best) else best
    return best
