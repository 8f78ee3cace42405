"""Plain Python versions of the operators, written from their contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_dedup(docs: list[tuple[int, str | None]], min_docs: int = 3, min_chars: int = 20) -> dict[int, tuple]:
    key = lambda line: line.strip(SPACE).translate(UPPER)
    holders = defaultdict(set)
    for d, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    out = {}
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and d != max(holders[key(x)]))]
        out[d] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def substring_dedup(docs: list[tuple[int, str | None]], window: int = 50) -> dict[int, tuple]:
    first: dict[tuple, int] = {}
    for d, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def decontaminate(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], window: int = 13) -> dict[int, tuple]:
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
    windows = defaultdict(set)
    for i, text in items:
        w = split(text)
        for k in {tuple(w)} if 0 < len(w) < window else {tuple(w[j : j + window]) for j in range(len(w) - window + 1)}:
            windows[k].add(str(i))
    sizes = {len(k) for k in windows}
    out = {}
    for d, text in docs:
        w = split(text)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit[j : j + n] = [True] * n
                    found |= windows[tuple(w[j : j + n])]
        out[d] = (len(w), sum(hit), len(found), sha(",".join(sorted(found))), sum(hit) > 0 and 20 * sum(hit) >= len(w))
    return out


def pii_base(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def pii_method(docs: list[tuple[int, str | None]], threshold: float = 0.9, min_seeds: int = 5) -> dict[int, list[tuple[str, int, int]]]:
    """doc_id -> what the bootstrapped method adds: mentions, a graph of patterns and instances, rounds to the fixed point."""
    runs = {"number": r"[+(0-9][0-9+().\x20-]*", "mail": rf"(?<![^{SPACE}])[^{SPACE}@]*@[^{SPACE}]*", "long": r"(?<![0-9A-Za-z+/_-])[0-9A-Za-z+/_-]{20,}"}
    within = {"number": ("ip", "card", "phone"), "mail": ("email",), "long": ()}
    digits = lambda x: re.sub("[^0-9]", "", x)
    known, edges, loose, found = set(), set(), [], defaultdict(list)
    for d, text in docs:
        text = text or ""
        base = pii_base(text)
        for run, form in runs.items():
            end = 0
            for m in re.finditer(form, text):
                gap, end, at = text[end : m.start()], m.end(), m.start()
                ahead = re.search(rf"[^{SPACE}]*\Z", gap)[0]
                before = [*[""] * 2, *gap[: len(gap) - len(ahead)].lower().split(None)][-2:]
                if re.search("[0-9A-Za-z]", ahead):
                    before = [before[1], ahead.lower()]
                follow = re.compile(form).search(text, m.end())
                rest = text[m.end() - m[0].endswith(" ") : follow.start() if follow else len(text)]
                tail = re.match(rf"[^{SPACE}]*", rest)[0]
                after = next(iter(rest[len(tail) :].split()), "").lower()

                def patterns(surface: str, first: bool, last: bool, before=before, after=after) -> list[str]:
                    shape = re.sub("[A-Z]+", "A", re.sub("[a-z]+", "a", re.sub("[0-9]+", "9", surface)))
                    return [f"2|{before[0]}|{before[1]}", f"L|{before[1]}|{shape}"] * (first and before[1] != "") + [f"R|{shape}|{after}"] * (last and after != "")

                own = [(k, a, b) for k, a, b in base if k in within[run] and at <= a and b <= m.end()]
                for k, a, b in own:
                    one = digits(text[a:b]) if k in ("card", "phone") else text[a:b].lower()
                    known |= {(p, one, k) for p in patterns(text[a:b], not re.search("[0-9A-Za-z]", text[at:a]), not re.search("[0-9A-Za-z]", text[b : m.end()]))}
                core = re.search(r"[0-9A-Za-z+(].*?(?=[^0-9A-Za-z)]*\Z)", m[0], re.S)
                if own or not core or re.search("[0-9A-Za-z]\\Z", ahead) or run != "mail" and re.match("[0-9A-Za-z@]", tail):
                    continue
                c, n = core[0], len(digits(core[0]))
                ip = bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){2,3}", c))
                could = {
                    "email": run == "mail" and re.fullmatch("[^@]+@[^@]+", c), "ip": ip, "card": re.fullmatch(r"[0-9]+([\x20-][0-9]+)*", c) and 12 <= n <= 19,
                    "phone": re.fullmatch(r"[+(]*[0-9][0-9().\x20-]*", c) and 7 <= n <= 15 and not re.match(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", c), "secret": run == "long" and re.search("[0-9]", c) and re.search("[A-Za-z]", c),
                }
                kinds = [k for k, yes in could.items() if yes]
                one = (c if ip else digits(c)) if run == "number" else c.lower() if run == "mail" else c
                around = patterns(c, True, True)
                edges |= {(p, one, k) for p in around for k in [*kinds, None]}
                span = (at + core.start(), at + core.end())
                if "secret" in kinds and re.search("(?i)token|secret|passw|api.?key|credential", " ".join([*gap[: len(gap) - len(ahead)].split()[-2:], ahead])):
                    known |= {(p, one, "secret") for p in around}
                loose += [(d, k, *span, one) for k in kinds]
    degree = Counter(p for p, _ in {(p, i) for p, i, _ in known | edges})
    joined: dict[tuple[str, str], float] = {}
    while True:
        trust = {e: 1.0 for e in known}
        for p, i, k in edges:
            if (i, k) in joined:
                trust[p, i, k] = max(trust.get((p, i, k), 0), joined[i, k])
        by = defaultdict(list)
        for (p, _, k), c in trust.items():
            by[p, k].append(c)
        score = {x: sum(c) / degree[x[0]] for x, c in by.items() if len(c) >= min_seeds}
        new: dict[tuple[str, str], float] = {}
        for p, i, k in edges:
            if k is not None and score.get((p, k), 0) >= threshold:
                new[i, k] = max(new.get((i, k), 0), score[p, k])
        if len(new) == len(joined):
            break
        joined = new
    for d, k, a, b, i in loose:
        if (i, k) in joined:
            found[d].append((k, a, b))
    return {d: sorted(set(found[d]), key=lambda x: (["email", "ip", "card", "phone", "secret"].index(x[0]), x[1])) for d, _ in docs}


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def shingles(text: str | None, size: int = 5) -> set[tuple]:
    w = words((text or "").translate(UPPER))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def near_duplicates(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        near = Counter(e for s in sets[d] for e in holders[s])
        for e, both in near.items():
            if 100 * both >= 75 * (len(sets[d]) + len(sets[e]) - both):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def token_digests(docs: list[tuple[int, str | None]], tokenizer) -> dict[int, tuple]:
    import numpy as np

    out, start = {}, 0
    for d, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out[d] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    return out


def quality_counts(text: str | None) -> tuple:
    w, seen, dup = words(text), set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = [False] * len(w)
    for i in range(len(w) - 2):
        if grams[tuple(w[i : i + 3])] > 1:
            hit[i : i + 3] = [True] * 3
    n = sum(hit)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, n, len(w) < 50 or 100 * n > 50 * len(w)


def robust_distances(groups: list[tuple[str, str]], x, floors: list[float], support: float, scale: float, prior: int, settled: float, grid: int = 64):
    """Squared distances of the rows of ``x`` to the mixed MCD estimate of their (lang, source), in numpy."""
    import numpy as np

    def quantile(values, p):
        bins = np.sort(np.floor(np.minimum(values, 1e6) * grid))
        return bins[next(i for i in range(len(bins)) if np.sum(bins <= bins[i]) >= len(bins) * p)] / grid

    def factor(s):
        low = np.zeros_like(s)
        for i in range(len(s)):
            for j in range(i + 1):
                v = s[i, j] - low[i, :j] @ low[j, :j]
                low[i, j] = max(v, floors[i] ** 2) ** 0.5 if i == j else v / low[j, j]
        return low

    def distance(rows, m, s):
        return (np.linalg.solve(factor(s), (rows - m).T) ** 2).sum(axis=0)

    def step(rows, place):
        near = rows[np.floor(np.minimum(place, 1e6) * grid) / grid <= quantile(place, support)]
        m = near.mean(axis=0)
        s = (near - m).T @ (near - m) / len(near) * scale
        return len(near), m, s, 2 * np.log(np.diag(factor(s))).sum()

    levels = {k: x[[i for i, g in enumerate(groups) if k in (g, (g[0],), ())]] for k in {*groups, *((a,) for a, _ in groups), ()}}
    state = {}
    for k, rows in levels.items():
        median = np.array([quantile(c, 0.5) for c in rows.T])
        mad = np.array([quantile(abs(c - m), 0.5) for c, m in zip(rows.T, median, strict=True)])
        z = ((rows - median) / np.maximum(mad * 1.4826, floors)) ** 2
        state[k] = [step(rows, np.log1p(z.sum(axis=1))), step(rows, np.log1p(z.max(axis=1)))]
    while True:  # all groups step together, until none falls
        after = {k: [step(levels[k], np.log1p(distance(levels[k], m, s))) for _, m, s, _ in both] for k, both in state.items()}
        fell = max(a[3] - b[3] for k in state for a, b in zip(state[k], after[k], strict=True))
        state = after
        if fell <= settled:
            break
    best = {k: min(both, key=lambda e: e[3]) for k, both in state.items()}

    def mixed(own, outer):
        (n, m, s, _), (mo, so) = own, outer
        w = n / (n + prior)
        return w * m + (1 - w) * mo, w * s + (1 - w) * so + w * (1 - w) * np.outer(m - mo, m - mo)

    out = np.empty(len(x))
    for k in set(groups):
        m, s = mixed(best[k], mixed(best[k[:1]], best[()][1:3]))
        at = [i for i, g in enumerate(groups) if g == k]
        out[at] = distance(x[at], m, s)
    return out


def share(budget: int, nodes: list[tuple[str, int, int]]) -> dict[str, int]:
    """Whole-number shares of (name, capacity, weight) nodes, by retiring short nodes until none is."""
    open_, out = [x for x in nodes if x[2] > 0], {n: 0 for n, _, _ in nodes}
    while open_:
        total = sum(w for _, _, w in open_)
        short = [(n, c) for n, c, w in open_ if c * total <= budget * w]
        if not short:
            for n, _, w in open_:
                out[n] = budget * w // total
            break
        # retire the shortest for its weight first: the others may then get more than they can take, too
        n, c = min(((n, c) for n, c in short), key=lambda x: (x[1] / next(w for m, _, w in open_ if m == x[0]), x[0]))
        out[n] = c
        budget -= c
        open_ = [x for x in open_ if x[0] != n]
    return out


def mixture(docs: list[tuple[int, tuple[str, ...], int]], weights: list[dict], budget: int, epochs: int, seed: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (leaf budget, copies) for (doc_id, path, tokens)."""
    tokens = Counter()
    for _, path, n in docs:
        tokens[path] += n
    budgets = {(): min(budget, epochs * sum(tokens.values()))}
    for depth in range(len(weights)):
        for parent in [p for p in list(budgets) if len(p) == depth]:
            children = sorted({p[depth] for p in tokens if p[:depth] == parent})
            nodes = [(c, epochs * sum(n for p, n in tokens.items() if p[: depth + 1] == (*parent, c)), weights[depth].get((c,), 1)) for c in children]
            for c, b in share(budgets[parent], nodes).items():
                budgets[*parent, c] = b
    out = {}
    for path, total in tokens.items():
        whole, rest = divmod(budgets[path], total) if total else (0, 0)
        upto = 0
        for d, _, n in sorted((x for x in docs if x[1] == path), key=lambda x: hashlib.md5(f"{seed}:{whole}:{x[0]}".encode()).hexdigest()):
            upto += n
            out[d] = (budgets[path], whole + (rest > 0 and upto <= rest))
    return out


def planted_periods(doc_id: int | None, text: str | None) -> list[str]:
    found = words(text)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(found)
    if h % 10 or not n:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]


def periodic_runs(found: list[str], times: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by trying every period at every word."""
    runs: dict[tuple[int, int], int] = {}
    for q in range(1, len(found) // times + 1):
        i = 0
        while i + q < len(found):
            j = i
            while j + q < len(found) and found[j] == found[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                runs.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in runs.items()), key=lambda r: (r[0], r[2]))


def run_digests(found: list[str]) -> tuple:
    runs = periodic_runs(found)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    return len(runs), *best, milli, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(found) if i not in gone))


def planted_words(docs: list[tuple[int, str | None]]) -> list[str]:
    out = []
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{low}".encode())
            out.append(low[: h % len(low)] + low[h % len(low) + 1 :] if h % 199 == 0 else low)
    return out


def spelling_variants(occurrences: list[str], min_length: int = 6, min_count: int = 5, ratio: int = 5) -> dict[str, tuple]:
    """word: (n, n_near, form, form_n, root), near words by what is left when a code point is taken out."""
    count = {w: n for w, n in Counter(occurrences).items() if len(w) >= min_length and n >= min_count}
    holes: dict[tuple, set] = defaultdict(set)
    for w in count:
        for k in range(len(w)):
            holes[w[:k], w[k + 1 :]].add(w)  # one code point replaced
    near: dict[str, set] = {w: set() for w in count}
    for some in holes.values():
        for w in some:
            near[w] |= some - {w}
    for w in count:
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1 :]
            if shorter in count:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= ratio * count[w] else None

    def root(w: str) -> str:
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], count[form[w]] if form[w] else None, root(w)) for w, n in count.items()}
