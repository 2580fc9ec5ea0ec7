"""Plain, slow versions of the operators, to hold the Spark results against."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
GAP = r"[\x20\x09\x0B-\x0D]+"


def quality(rows, max_share=0.01, min_docs=5, max_removed=0.5, copies_count=False):
    """rows: (doc_id, text, host). -> list of tuples in the query's column order."""
    norm = lambda l: re.sub(GAP, " ", l).lower().strip(" ")
    seen, host = defaultdict(set), defaultdict(set)
    for k, (_, t, h) in enumerate(rows):
        for l in (t or "").split("\n"):
            if norm(l):
                seen[h, norm(l)].add(k if copies_count else t)
                host[h].add(k if copies_count else t)
    often = lambda h, l: len(seen[h, l]) > max(min_docs, max_share * len(host[h]))
    out = []
    for i, t, h in rows:
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        win = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        c = Counter(win)
        rep = set()
        for k, x in enumerate(win):
            if c[x] > 1:
                rep.update(range(k, k + 8))
        bad = len(w) < 20 or 100 * len(rep) > 30 * len(w)
        lost = sum(len(WORD.findall(x)) for x in t.split("\n") if norm(x) and often(h, norm(x)))
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep), bad, not bad and not lost > max_removed * len(w), lost))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
OTHER = {"access": (re.compile(r"AKIA[A-Z0-9]+"), 20), "hex": (re.compile(r"[0-9a-f]+"), 24)}


def base_secrets(text):
    """-> (start, kind order, end) of the base kinds."""
    text = text or ""
    got = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for k, (p, least) in enumerate(OTHER.values(), 1):
        got += [(m.start(), k, m.end()) for m in p.finditer(text) if len(m[0]) >= least]
    return sorted(got)


WEAK_KINDS = ("assign", "access", "hex", "access_id", "secret_part", "endpoint")


def weak_parts(text):
    """-> (start, kind order, end) of login names, short key ids and mail addresses; secret-looking runs; endpoints."""
    got = [(m.start(), 3, m.end()) for m in re.finditer(r"(?<![A-Za-z0-9_])A[A-Z]IA[A-Z0-9]{8,15}|(?<![A-Za-z0-9_])(?:[Uu]ser|[Uu]sername|[Ll]ogin|client_id|access_key_id) *[=:] *[-\w.@]{3,64}|(?<![-\w.%+])[-\w.%+]+@[-A-Za-z0-9]+(?:\.[-A-Za-z0-9]+)+", text, re.A) if "_" not in m[0] or "=" in m[0] or ":" in m[0] or "@" in m[0]]
    for m in re.finditer(r"[A-Za-z0-9+/]+", text):
        r = m[0]
        if len(r) == 40 and re.search(r"[0-9]", r) and re.search(r"[A-Z]", r):
            got.append((m.start(), 4, m.end()))
    for m in re.finditer(r"(?<![0-9a-z])[0-9a-f]{16,23}(?![0-9a-z])", text):
        if re.search(r"[0-9]", m[0]) and re.search(r"[a-f]", m[0]):
            got.append((m.start(), 4, m.end()))
    got += [(m.start(), 5, m.end()) for m in re.finditer(r"(?:https?|ftp|s3|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9][-A-Za-z0-9.]*(?::[0-9]{1,5})?", text)]
    return sorted(got)


def linked_secrets(text, scope=300):
    text, base = text or "", base_secrets(text)
    role = {0: "secret", 1: "id", 2: "secret", 3: "id", 4: "secret", 5: "endpoint"}
    weak, out = weak_parts(text), list(base)
    for s, k, e in weak:
        if any(a < e and b > s for a, _, b in base):
            continue
        mates = {"secret": ("id", "endpoint"), "id": ("secret",), "endpoint": ("secret",)}[role[k]]
        if any(role[j] in mates and a < e + scope and b + scope > s for a, j, b in [*base, *weak]):
            out.append((s, k, e))
    return sorted(out)


def span_text(spans):
    return ",".join(f"{WEAK_KINDS[k]}:{s}:{e}" for s, k, e in spans)


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(rows):
    """rows: (doc_id, text) -> (doc_id, n_shingles, component_id)."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in at[x] if j < i)
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            r = top(i)
            least[r] = min(d, least.get(r, d))
    return [(d, len(sets[i]), least.get(top(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def suffixes(rows, depth=50):
    """rows: (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    order = lambda d: float("inf") if d is None else d
    low = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - depth + 1):
            s = b[i : i + depth]
            if order(d) < low.get(s, float("inf")):
                low[s] = order(d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - depth + 1):
            if low.get(b[i : i + depth], float("inf")) < order(d):
                gone[i : i + depth] = b"\1" * depth
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def luhn(text):
    d = [int(c) for c in text if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def personal(text):
    """(start, end, kind) of mail addresses, internet addresses, telephone, security and card numbers of the kinds that the tables hold."""
    text, got = text or "", []
    for kind, p in (
        ("email", r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
        ("ip", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"),
        ("ssn", r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])"),
        ("phone", r"(?<![\w+])\+\d{1,3} \(\d{3}\) \d{3}-\d{4}(?!\d)"),
        ("card", r"(?<!\d)\d{13,19}(?!\d)"),
    ):
        for m in re.finditer(p, text, re.A):
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not luhn(m[0]):
                continue
            if not any(a < m.end() and b > m.start() for a, b, _ in got):
                got.append((m.start(), m.end(), kind))
    return sorted(got)
