"""Plain-Python answers that the operators are held against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def secrets_base(text: str | None) -> tuple[int, int, int, str]:
    text = text or ""
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            spans.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            spans.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    said = ",".join(x[2] for x in sorted(spans))
    return (*[sum(x[1] == k for x in spans) for k in range(3)], hashlib.sha256(said.encode()).hexdigest())


def rules_base(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def shingles(text: str | None, k: int) -> set:
    words = (text or "").encode().lower().decode()
    words = WORD.findall(words)
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}


def components(rows: list[tuple[int, str | None]], k: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    """doc_id -> (size of its set, smallest doc_id reachable), by all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def crc_of(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def rules_failed(text: str, n_words: int, word_chars: int, n_symbols: int, n_dup_lines: int) -> set[str]:
    """Names of the cascade's rules that reject."""
    import regex

    said = {
        "symbols_per_word": 5 * n_symbols > n_words,
        "long_words": word_chars > 30 * n_words,
        "short_words": word_chars < 2 * n_words,
        "duplicate_lines": n_dup_lines >= 3 and 2 * n_dup_lines > len(text.split("\n")),
        "capitals": 2 * len(re.findall("[A-Z]", text)) > word_chars,
        "letters": 2 * len(regex.findall(r"\p{L}", text)) < word_chars,
    }
    return {k for k, v in said.items() if v}


def article_text(page: str | None) -> str:
    """Blocks of the page's article, by the standard library's parser."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self) -> None:
            super().__init__()
            self.depth, self.blocks = 0, [[]]

        def handle_starttag(self, tag, attrs):
            self.depth += tag == "article"
            if tag in ("p", "h1", "h2", "div", "li", "ul", "article"):
                self.blocks.append([])
            elif tag == "br":
                self.blocks[-1].append(" ")

        def handle_endtag(self, tag):
            self.depth -= tag == "article"
            if tag in ("p", "h1", "h2", "div", "li", "ul", "article"):
                self.blocks.append([])

        def handle_data(self, data):
            if self.depth:
                self.blocks[-1].append(data)

    reader = Reader()
    reader.feed(page or "")
    reader.close()
    return "\n\n".join(x for x in (" ".join("".join(b).split()) for b in reader.blocks) if x)


def logistic(text: str, weights: np.ndarray, bits: int = 18) -> float:
    """Score of a text: its words, pairs of neighbours and words that return after one other, one by one."""
    import math

    import xxhash

    words = re.findall(r"[^\W\d_]+|\d+|[^\w\s]+|_+", text)
    h, top = [xxhash.xxh3_64_intdigest(w) for w in words], (1 << 64) - 1
    grams = list(h)
    for a, b in zip(h, h[1:], strict=False):
        two = 0x5851F42D4C957F2D if a == b else (a * 0x9E3779B97F4A7C15 & top) ^ b >> 7
        grams.append(two * 0xD6E8FEB86659FD93 & top)
    grams += [0x14057B7EF767814F for a, b in zip(h, h[2:], strict=False) if a == b]
    counts = Counter(g >> 64 - bits for g in grams)
    total = float(weights[-1]) + sum(float(weights[g]) * math.sqrt(n / len(grams)) for g, n in counts.items())
    return 1 / (1 + math.exp(-total))
