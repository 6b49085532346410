"""Plain-Python versions of the operators, written from their contracts."""

import re


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def near_dup(rows, percent=75, size=5):
    """rows: [(doc_id, text)] -> {doc_id: (n_shingles, component_id)}"""
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or ""))
        sets[d] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    index, parent = {}, {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for d in sorted(sets):
        seen = {}
        for s in sets[d]:
            for o in index.setdefault(s, []):
                seen[o] = seen.get(o, 0) + 1
            index[s].append(d)
        for o, both in seen.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[o]) - both):
                a, b = sorted((find(d), find(o)))
                parent[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for kind, p in PII.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
