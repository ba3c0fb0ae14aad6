"""Plain versions of the operators for small tables: direct readings of their contracts, without any of their methods."""

from __future__ import annotations

import collections
import hashlib
import re

import public_tokenizers
import tiktoken

from corpusgate.llm.bpe import Tokenizer

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeats(docs: list[tuple[int, str | None]], length: int = 50) -> dict:
    """``{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}``."""
    seen, out = {}, {}
    for d, text in sorted(docs):
        t = (text or "").encode()
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen.setdefault(t[i : i + length], d) < d:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, c in enumerate(gone) if c and not (i and gone[i - 1]))
        out[d] = (len(t), sum(gone), spans, sha(bytes(b for b, c in zip(t, gone, strict=True) if not c)))
    return out


def shingles(text: str | None) -> frozenset:
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(docs: list[tuple[int, str | None]]) -> dict:
    """``{doc_id: (n_shingles, component_id)}`` by counting common shingles of all pairs that have one."""
    sets = {d: shingles(t) for d, t in docs}
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    common = collections.Counter((a, b) for v in holders.values() for b in v for a in v if a < b)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def item_windows(items: list[tuple[int, str | None]], size: int = 10) -> dict:
    out = collections.defaultdict(set)
    for i, text in items:
        w = TERMS.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            out[tuple(w[k : k + size])].add(str(i))
    return out


def leaks(text: str | None, windows: dict) -> tuple[int, int, list[str]]:
    """``n_words, n_hit, items``."""
    w = TERMS.findall((text or "").translate(LOWER))
    hit, items = set(), set()
    for n in {len(g) for g in windows}:
        for i in range(len(w) - n + 1):
            if (found := windows.get(tuple(w[i : i + n]))) is not None:
                hit.update(range(i, i + n))
                items |= found
    return len(w), len(hit), sorted(items)


def tokenizer() -> tuple[Tokenizer, tiktoken.Encoding]:
    own = Tokenizer.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return own, tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(t: str) -> list[tuple[int, int, str]]:
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def luhn(d):
        return sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(d[::-1])) % 10 == 0

    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(t) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]
    return [(a, b, k) for a, _, b, k in sorted(out)]


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    t = text or ""
    w = SPACED.findall(t)
    places = collections.defaultdict(list)
    for i in range(len(w) - 4):
        places[tuple(w[i : i + 5])].append(i)
    covered = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(5)}
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)
