"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds what they miss.

The base finds e-mail, IP, card and phone spans by fixed patterns.  The semi-CRF scores whole candidate segments of a cluster
(a run of tokens that holds digits or an at sign) with features of the span as a whole: digits, groups, separators,
checksum, the word before it.  Dynamic programming over segments of at most ``LONGEST`` atoms chooses boundaries and types
together; what lies outside every entity scores zero, so clusters can be solved one by one.  Its weights are trained here,
by gradient ascent on the exact likelihood of sentences that ``training_clusters`` makes from rules.

Base spans always stay; a model span that touches one is dropped.  Offsets are code points, end exclusive.  A null text
is empty.  Rows are independent and nothing is shuffled: repeated rows, null keys and empty tables need no special care.
Every scan is linear in the text.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import fresh, map_texts, quoted, slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

# ---- base patterns ------------------------------------------------------------------------------------------------

#: Fixed values of the contract.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def octets(text: str) -> bool:
    """Whether all parts are at most 255, however many leading zeros they have."""
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts)


def emails(text: str):
    """Leftmost matches, driven by the at signs so that no run of characters is scanned twice."""
    done = 0
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        n = len(before) - len(before.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if n else None
        if found:
            yield at - n, found.end(), "email"
        done = found.end() if found else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind."""
    out = list(emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if octets(m[0])]
        for m in CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


_DIGIT, _NOT_DIGIT = re.compile("[0-9]"), re.compile("[^0-9]+")

# ---- candidate segments ---------------------------------------------------------------------------------------------

LONGEST = 14  # atoms
ATOM = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|[^\s]")
#: Tokens with a digit or an at sign; one that starts like a number continues the one before it.
TOKEN = re.compile(r"\S+")
GROUP = re.compile(r"[0-9]+")
#: Words that announce each kind, in the languages of the corpus.
CUES = {
    "email": ("mail", "email", "e-mail", "correo", "courriel", "contact"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "tarjeta", "carte", "karte", "kreditkarte"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell", "telefon", "telefono", "teléfono", "téléphone", "handy"),
}
CUE_OF = {w: k for k, words in CUES.items() for w in words}


def clusters(text: str):
    """``(start, end, cue)`` of each run of tokens that can hold an entity; cue is the kind the word before announces."""
    if not ("@" in text or _DIGIT.search(text)):
        return
    start = end = -1
    word, cue = "", None
    for m in TOKEN.finditer(text):
        token = m[0]
        if _DIGIT.search(token) or "@" in token:
            if start >= 0 and m.start() == end + 1 and text[end] == " " and token[0] in "0123456789(":
                end = m.end()
                continue
            if start >= 0:
                yield start, end, cue
            start, end, cue = m.start(), m.end(), CUE_OF.get(word.strip(".:;,()").lower())
        elif start >= 0:
            yield start, end, cue
            start = -1
        word = token
    if start >= 0:
        yield start, end, cue


@dataclass(frozen=True)
class Candidate:
    first: int  # atoms
    last: int  # exclusive
    start: int  # characters
    end: int


def candidates(text: str) -> tuple[int, list[Candidate]]:
    """Number of atoms of a cluster and its candidate segments: whole words, with an at sign or at least seven digits."""
    atoms = [(m.start(), m.end()) for m in ATOM.finditer(text)]
    free = [i == 0 or not (text[s].isalnum() and text[s - 1].isalnum()) for i, (s, _) in enumerate(atoms)] + [True]
    out = []
    for i, (s, _) in enumerate(atoms):
        if not free[i]:
            continue
        digits, at = 0, False
        for j in range(i, min(len(atoms), i + LONGEST)):
            a, b = atoms[j]
            digits += b - a if text[a].isdecimal() else 0
            at = at or text[a] == "@"
            if digits > 40:
                break
            if free[j + 1] and (at or digits >= 7):
                out.append(Candidate(i, j + 1, s, b))
    return len(atoms), out


@functools.lru_cache(maxsize=20_000)
def features(segment: str, cue: str | None, joined: bool) -> tuple[int, ...]:
    """Indices of the features that a whole segment has; joined: the text goes on beside it without a break."""
    groups = GROUP.findall(segment)
    digits = "".join(groups)
    bare = re.sub(r"[0-9().\x20+/-]", "", segment)
    n = len(digits)
    local, _, domain = segment.partition("@")
    tests = {
        "any": True, "at": "@" in segment, "address": bool(local) and not local.strip(LOCAL) and bool(DOMAIN.fullmatch(domain)),
        "one_at": segment.count("@") == 1, "space": " " in segment, "foreign": bool(bare) and "@" not in segment,
        "plus": segment.startswith("+"), "zero": segment.startswith(("0", "(0")), "open": segment.startswith("("),
        "balanced": segment.count("(") == segment.count(")"), "edge": not (segment[0].isalnum() or segment[0] in "+(") or not segment[-1].isalnum(),
        "dots": segment.count(".") == 3 and len(groups) == 4, "octets": len(groups) == 4 and octets(".".join(groups)),
        "luhn": 12 <= n <= 19 and luhn(digits), "dashes": "-" in segment, "slash": "/" in segment,
        "fours": len(groups) >= 3 and all(len(g) == 4 for g in groups[:-1]), "year": bool(re.fullmatch(r"(?:19|20)\d\d", groups[0] if groups else "")),
        "n<7": n < 7, "n7-8": 7 <= n <= 8, "n9-11": 9 <= n <= 11, "n12-15": 12 <= n <= 15, "n16-19": 16 <= n <= 19, "n>19": n > 19,
        "g1": len(groups) == 1, "g2": len(groups) == 2, "g3": len(groups) == 3, "g4": len(groups) == 4, "g5": len(groups) > 4,
        **{f"cue_{k}": cue == k for k in KINDS}, "no_cue": cue is None, "joined": joined,
    }
    return tuple(i for i, held in enumerate(tests.values()) if held)


N_FEATURES = 36


_GOES_ON = re.compile(r"[.@-]\w")


def _held(text: str, c: Candidate, cue: str | None) -> list[int]:
    joined = bool(_GOES_ON.match(text, c.end)) or c.start > 1 and text[c.start - 1] in ".@-" and text[c.start - 2].isalnum()
    return list(features(text[c.start : c.end], cue, joined))


# ---- the model ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class SpanModel:
    """A weight for each kind and feature."""

    weights: np.ndarray

    def scores(self, text: str, cue: str | None, found: list[Candidate]) -> list[np.ndarray]:
        return [self.weights[:, _held(text, c, cue)].sum(axis=1) for c in found]

    def decode(self, text: str, cue: str | None) -> list[Span]:
        """The best segmentation of a cluster."""
        n, found = candidates(text)
        if not found:
            return []
        best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        ending: dict[int, list] = {}
        for c, s in zip(found, self.scores(text, cue, found), strict=True):
            ending.setdefault(c.last, []).append((c, s))
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for c, s in ending.get(j, ()):
                kind = int(s.argmax())
                if best[c.first] + s[kind] > best[j]:
                    best[j], back[j] = best[c.first] + float(s[kind]), (c, kind)
        out, j = [], n
        while j:
            if back[j] is None:
                j -= 1
            else:
                c, kind = back[j]
                out.append((c.start, c.end, KINDS[kind]))
                j = c.first
        return out[::-1]


def gradient(model: SpanModel, text: str, cue: str | None, gold: list[Span]) -> np.ndarray:
    """Of the log-likelihood of one cluster: features of the gold segments less those expected, by forward and backward sums."""
    n, found = candidates(text)
    out = np.zeros_like(model.weights)
    if not found:
        return out
    scores = model.scores(text, cue, found)
    ending, starting = {}, {}
    for c, s in zip(found, scores, strict=True):
        total = float(np.logaddexp.reduce(s))
        ending.setdefault(c.last, []).append((c.first, total))
        starting.setdefault(c.first, []).append((c.last, total))
    ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + t for i, t in ending.get(j, ()))])
    for i in range(n - 1, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[j] + t for j, t in starting.get(i, ()))])
    truth = {(a, b): KINDS.index(k) for a, b, k in gold}
    for c, s in zip(found, scores, strict=True):
        push = -np.exp(ahead[c.first] + s + behind[c.last] - ahead[n])
        if (c.start, c.end) in truth:
            push[truth[c.start, c.end]] += 1
        out[:, _held(text, c, cue)] += push[:, None]
    return out


def training_clusters(n: int = 600, seed: int = 11) -> list[tuple[str, str | None, list[Span]]]:
    """Clusters with their entities, made by rules: entities as people write them, and numbers that are none."""
    rng = np.random.default_rng(seed)

    def digits(k):
        return "".join(map(str, rng.integers(0, 10, k)))

    def pick(*options):
        return options[rng.integers(len(options))]

    def card():
        body = pick("4", "5", "3") + digits(14)
        full = next(body + d for d in "0123456789" if luhn(body + d))
        sep = pick("", " ", "-")
        return sep.join(full[i : i + 4] for i in range(0, 16, 4))

    def phone():
        area, mid, end = pick("2", "4", "7") + digits(2), digits(3), digits(4)
        return pick(f"+{pick('1', '34', '49')} ({area}) {mid}-{end}", f"+{pick('1', '33')} {area} {mid} {end}", f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"0{area} {mid}{end}")

    def email():
        return f"{pick('ana', 'jo.doe', 'k_l', 'x-y')}{pick('', '.7', '42')}@{pick('mail', 'post4', 'web')}.{pick('example.com', 'org', 'net')}"

    def ip():
        return ".".join(str(x) for x in rng.integers(1, 256, 4))

    def other():
        return pick(
            digits(pick(7, 8, 9, 10, 12, 16)), f"20{digits(2)}-{pick('01', '11')}-{pick('05', '27')}", f"v{digits(1)}.{digits(1)}.{digits(2)}",
            f"{digits(3)},{digits(3)},{digits(3)}", "".join(pick(*"0123456789abcdef") for _ in range(24)), f"#{digits(8)}", f"@{pick('user', 'all')}{digits(2)}",
            f"{digits(2)}.{digits(2)}.20{digits(2)}", f"id={digits(9)}", f"{digits(4)}/{digits(4)}", f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}",
            f"a@{digits(2)}", f"{digits(3)}.{digits(3)}.{digits(2)}.{digits(2)}.{digits(2)}", f"{digits(3)} {digits(3)} {digits(3)}",
        )

    out = []
    for _ in range(n):
        kind = pick(*KINDS, None, None, None)
        if kind is None:
            out.append((other() + pick("", ".", ","), pick(None, None, None, *KINDS), []))
            continue
        entity = {"email": email, "ip": ip, "card": card, "phone": phone}[kind]()
        before, after = pick("", "", "(", "<"), pick("", "", ".", ",", ")", ";")
        cue = pick(None, kind)
        if kind == "phone" and not entity.startswith(("+", "(")):
            cue = kind  # a bare number is a phone only where a word says so
        out.append((before + entity + after, cue, [(len(before), len(before) + len(entity), kind)]))
    return out


@functools.cache
def trained_model(rounds: int = 20, rate: float = 0.5, ridge: float = 2e-3) -> SpanModel:
    """Fitted once per process on the made clusters, whose number is fixed."""
    rows = training_clusters()
    weights = np.zeros((len(KINDS), N_FEATURES))
    weights[:, 0] = -1.0
    squares = np.full_like(weights, 1e-8)
    for _ in range(rounds):
        model = SpanModel(weights)
        g = sum(gradient(model, *row) for row in rows) / len(rows) * 20 - ridge * weights
        squares = squares + g * g
        weights = weights + rate * g / np.sqrt(squares)
    return SpanModel(weights)


def find_spans(text: str, model: SpanModel) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those that the model adds; both by start, then kind."""
    base = base_spans(text)
    added = []
    for start, end, cue in clusters(text):
        for a, b, kind in model.decode(text[start:end], cue):
            a, b = a + start, b + start
            if not any(s < b and a < e for s, e, _ in base if e > start and s < end):
                added.append((a, b, kind))
    if not added:
        return base, base
    return base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2])))


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one, named after the first."""
    out, done = [], 0
    merged: list[list] = []
    for a, b, k in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, k])
    for a, b, k in merged:
        out += [text[done:a], f"[{k.upper()}]"]
        done = b
    return "".join([*out, text[done:]])


def _mapped(docs: DataFrame, keep: list[str], text: str, fields: list[tuple[str, str, pa.DataType]], row) -> DataFrame:
    def run(batches):
        for b in slices(batches, 8 << 20, "_text"):
            made = zip(*map(row, b.column("_text").to_pylist()), strict=True)
            yield b, [pa.array(v, t) for v, (_, _, t) in zip(made, fields, strict=True)]

    return map_texts(docs, keep, F.col(text).cast("string"), [(n, t) for n, t, _ in fields], run)


def personal_data(docs: DataFrame, keep: list[str], *, text: str = "text", model: SpanModel | None = None) -> DataFrame:
    """``keep``, the number of base spans of each kind, ``base`` and ``spans`` as ``kind:start:end`` joined by commas."""
    model = model or trained_model()

    def row(t):
        base, spans = find_spans(t or "", model)
        return (*(sum(k == kind for _, _, k in base) for kind in KINDS), spelled(base), spelled(spans))

    fields = [*((f"n_{k}", "long", pa.int64()) for k in KINDS), ("base", "string", pa.string()), ("spans", "string", pa.string())]
    return _mapped(docs, keep, text, fields, row)


def redact(docs: DataFrame, *, text: str = "text", model: SpanModel | None = None) -> DataFrame:
    """The same rows and columns, personal data in ``text`` replaced by its kind; a null text stays null."""
    model = model or trained_model()

    def row(t):
        if not t:
            return (t,)
        spans = find_spans(t, model)[1]
        return (redacted(t, spans) if spans else t,)

    name = fresh(docs, "redacted")
    others = [c for c in docs.columns if c != text]
    done = _mapped(docs, others, text, [(name, "string", pa.string())], row)
    return done.select(*(F.col(name).alias(text) if c == text else q for c, q in zip(docs.columns, quoted(docs.columns), strict=True)))
