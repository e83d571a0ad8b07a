"""Plain versions of the operators, one document at a time, for small tables."""

from __future__ import annotations

import re

from waveband.llm import quality_rules

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def components(texts: dict, words: int = 3, percent: int = 90) -> dict:
    """(set size, smallest linked id) of each id."""
    sets = {}
    for i, text in texts.items():
        w = BLANK.findall(lower(text))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and root(i) != root(j):
                label[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(sets[i]), root(i)) for i in ids}


def hits(text: str | None, items: list[str | None], size: int = 10) -> tuple[list[tuple[int, int]], set[int]]:
    """Spans (start and end characters) of the hit words, one for each word, and the items with a window in the text."""
    places = [(m.start(), m.end()) for m in ALNUM.finditer(lower(text))]
    words = ALNUM.findall(lower(text))
    hit, found = set(), set()
    for k, item in enumerate(items):
        of = ALNUM.findall(lower(item))
        n = min(size, len(of))
        for window in {tuple(of[i : i + n]) for i in range(len(of) - n + 1)} if n else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) == window:
                    hit.update(range(i, i + n))
                    found.add(k)
    return [(i, *places[i]) for i in sorted(hit)], found


def without_hits(text: str | None, items: list[str | None]) -> str | None:
    spans, _ = hits(text, items)
    if not spans:
        return text
    runs = [[spans[0]]]
    for s in spans[1:]:
        if s[0] == runs[-1][-1][0] + 1:
            runs[-1].append(s)
        else:
            runs.append([s])
    for run in reversed(runs):
        text = text[: run[0][1]] + text[run[-1][2] :]
    return text


def cleaned(text: str | None, rules: quality_rules.Rules = quality_rules.Rules()) -> str | None:
    """The text that is left of a document that the quality rules keep, else None."""
    text = text or ""
    words = BLANK.findall(text)
    windows: dict = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    again = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    if len(words) < rules.min_words or 100 * len(again) > rules.repeat_percent * len(words):
        return None
    left, seen = [], set()
    lines = text.split("\n")
    menu: set[int] = set()
    run: list[int] = []
    for k, line in [*enumerate(lines), (-1, "A sentence ends the last run.")]:
        if not BLANK.findall(line):
            continue
        last = BLANK.findall(line)[-1][-1]
        if len(BLANK.findall(line)) <= rules.menu_words and (ord(last) > 127 or last.isalnum()):
            run.append(k)
            continue
        if len(run) >= rules.menu_lines:
            menu.update(run)
        run = []
    for k, line in enumerate(lines):
        w = BLANK.findall(line)
        marks = sum(c in "#*$%&|<>!" for c in line)
        fails = bool(w) and (
            (marks >= rules.min_marks and 100 * marks >= rules.marks_percent * len(w))
            or sum(x in quality_rules.BARS for x in w) >= rules.min_bars
            or k in menu
            or line in seen
            or (len(w) <= rules.max_phrase_words and any(p in lower(line) for p in quality_rules.BOILERPLATE))
        )
        seen.add(line)
        if not fails:
            left.append(line)
    kept = "\n".join(left)
    chars = lambda t: sum(map(len, BLANK.findall(t)))
    return kept if 100 * chars(kept) >= rules.keep_percent * chars(text) else None


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    """Spans of the contract's kinds, (start, rank, kind, end), by the contract's own patterns."""
    text, found = text or "", []
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v, d: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v, d: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v, d: 12 <= len(d) <= 19 and _luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v, d: 9 <= len(d) <= 15),
    )
    for rank, (kind, pattern, holds) in enumerate(kinds):
        for m in re.finditer(pattern, text, re.ASCII):
            if holds(m[0], re.sub("[^0-9]", "", m[0])):
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def masked(text: str | None, spans: list[tuple[int, int, str, int]]) -> str | None:
    out, at = "", 0
    for start, _, kind, end in spans:
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:] if spans else text
