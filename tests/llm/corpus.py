"""A small corpus with every awkward case, and the plain rules that operators are held against."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary):x}{'é,' if rng.random() < 0.05 else ''}" for _ in range(n)]


def edited(rng: random.Random, words: list[str], changes: int) -> list[str]:
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return words


def lines(rng: random.Random, words: list[str]) -> str:
    out, at = [], 0
    while at < len(words):
        step = rng.randrange(3, 14)
        out.append(" ".join(words[at:at + step]))
        at += step
    return "\n".join(out)


def corpus(seed: int = 7, n: int = 120) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): copies exact and near, a chain of edits, shared passages and lines, blanks, NULLs in every
    column, repeated rows and a long text."""
    rng = random.Random(seed)
    passage, license_line = prose(rng, 70), "  All Rights\tReserved \r"
    base = prose(rng, 160)
    texts: list[str | None] = []
    for i in range(n):
        words = prose(rng, rng.randrange(1, 220))
        if i % 4 == 0:
            words[len(words) // 2:len(words) // 2] = passage
        if i % 6 == 0:
            words = edited(rng, base, rng.randrange(0, 6))
        if i % 13 == 0:
            base = edited(rng, base, 3)  # a chain: its ends are unlike, its links are not
        text = lines(rng, words)
        if i % 3 == 0:
            text = license_line + "\n" + text + "\n" + license_line.upper()
        texts.append(text)
    texts += [None, "", "   ", "\n\n", "one", "One", "two words", "A b C d", "a B c D", texts[5], texts[5], texts[0].upper()]
    texts += [" ".join(prose(rng, 9000, 5000)), "x" * 70000, "日本語 " * 300, "\x1c a\x0bb\x85c 　 d"]
    rows = [(i * 3 + 1, t, ("en", "de", None)[i % 3], ("s0", "s0", "s1", None, "Z", "s0")[i % 6], None if i % 17 == 0 else len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[7], None, None, None), (None, None, None, "s1", None), (None, texts[7], "en", "s0", 3)]
    return rows


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def shingles(text: str | None) -> frozenset:
    words = words_of((text or "").translate(UPPER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def smallest_reachable(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_groups(texts: dict[int, str | None], percent: int = 85) -> dict[int, int]:
    """doc_id -> smallest doc_id that links reach; all pairs are compared."""
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for x, a in enumerate(ids) for b in ids[:x] if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return smallest_reachable(sets, links)


def line_key(line: str) -> str:
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def without_repeated_lines(rows: list[tuple], least: int) -> list[tuple]:
    """(doc_id, lines, dropped, text) of each (doc_id, text)."""
    found: dict[str, set] = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            found.setdefault(line_key(line), set()).add(("id", i) if i is not None else ("text", text or ""))
    out = []
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if not line_key(x) or len(found[line_key(x)]) < least]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out
