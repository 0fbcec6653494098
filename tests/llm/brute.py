"""Plain Python forms of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = "[^\x20\x09-\x0d]+"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near_groups(texts: dict) -> dict:
    """id -> (shingles, least id reachable)."""
    sets = {}
    for i, text in texts.items():
        w = re.findall(SPACE, (text or "").translate(UPPER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    owners = defaultdict(list)
    for i, s in sorted(sets.items()):
        shared = Counter(j for g in s for j in owners[g])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                label[b] = a
        for g in s:
            owners[g].append(i)
    return {i: (len(sets[i]), root(i)) for i in texts}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        luhn = sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and luhn % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    order = {"email": 0, "ip": 1, "card": 2, "phone": 3}
    return sorted(out, key=lambda s: (s[1], order[s[0]]))


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def measures(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = re.findall(SPACE, text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered.update((i, i + 1, i + 2))
    filled = [x for x in text.split("\n") if re.search(SPACE, x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(filled) - len(set(filled)), len(covered)


def tiles(item: list, text: list, least: int) -> int:
    """Words of ``item`` that greedy string tiling covers."""
    used, gone = [False] * len(item), [False] * len(text)
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (
                    i + n < len(item)
                    and j + n < len(text)
                    and item[i + n] == text[j + n]
                    and not used[i + n]
                    and not gone[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sum(used)
        for k in range(n):
            used[i + k] = gone[j + k] = True


def line_list(text: str) -> list[str]:
    return [x for x in re.split(r"(?<=\n)|(?<=[^\w\s] )|(?<=_ )", text) if x]


def repeats(texts: dict, least: int, extend: bool) -> dict:
    """id -> lines inside a run of at least ``least`` words that stands earlier too; with
    ``extend`` the run goes on as far as both agree."""
    bare = {i: [x.replace("\n", "").strip(" ") for x in line_list(t or "")] for i, t in texts.items()}
    out, seen = defaultdict(set), defaultdict(list)
    for i in sorted(texts):
        b = bare[i]
        for s in range(len(b)):
            total = 0
            for k in range(s, len(b)):
                total += b[k].count(" ") + 1
                if total < least:
                    continue
                gram = tuple(b[s : k + 1])
                for j, p in seen[gram]:
                    x, y, stop = s, p, k + 1
                    while extend and x and y and b[x - 1] == bare[j][y - 1]:
                        x, y = x - 1, y - 1
                    q = p + k + 1 - s
                    while extend and stop < len(b) and q < len(bare[j]) and b[stop] == bare[j][q]:
                        stop, q = stop + 1, q + 1
                    out[i].update(range(x, stop))
                seen[gram].append((i, s))
                break
    return out
