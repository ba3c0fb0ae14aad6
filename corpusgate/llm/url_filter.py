"""URL filter: allow and block rules first, then logistic regression on hashed character n-grams of host and path.

``judge_urls`` adds a verdict to every row.  It is one narrow pass: no shuffle, so no host can become a hot task.
A null url, or one without ``://``, has an empty host and path; no rule fits it and the model sees only its end marks.
Other columns of the input are ignored.  Repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import ASCII_LOWER, ASCII_UPPER

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, for the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The small labelled URL table: well-known kinds of hosts that are allowed, and hosts made of a blocked kind and a common partner.
ALLOWED_HOSTS = tuple("""
theguardian.com lemonde.fr spiegel.de elpais.com washingtonpost.com cnn.com npr.org apnews.com zeit.de lefigaro.fr economist.com ft.com
wikipedia.org wiktionary.org britannica.com archive.org gutenberg.org openlibrary.org wikidata.org commons.wikimedia.org
mit.edu harvard.edu berkeley.edu ox.ac.uk cam.ac.uk ethz.ch tum.de sorbonne-universite.fr uni-heidelberg.de caltech.edu
nasa.gov noaa.gov nih.gov loc.gov europa.eu who.int un.org service-public.fr bund.de nationalarchives.gov.uk parliament.uk
science.org arxiv.org plos.org cell.com springer.com jstor.org doi.org pubmed.ncbi.nlm.nih.gov openstreetmap.org ietf.org w3.org
python.org apache.org kernel.org mozilla.org debian.org gnu.org rust-lang.org postgresql.org github.com gitlab.com stackoverflow.com
readthedocs.io sqlite.org numpy.org docs.oracle.com developer.android.com learn.microsoft.com
louvre.fr metmuseum.org moma.org britishmuseum.org rijksmuseum.nl smithsonianmag.com nationalgeographic.com
allrecipes.com seriouseats.com bonappetit.com chefkoch.de marmiton.org gardeningknowhow.com houseplants.net weather.com wetter.de meteofrance.com
lonelyplanet.com tripadvisor.com bahn.de sncf.com michelin.com booking.com airbnb.com goodreads.com imdb.com rottentomatoes.com
spotify.com bandcamp.com soundcloud.com khanacademy.org coursera.org duolingo.com ted.com quora.com reddit.com medium.com wordpress.com
ikea.com etsy.com target.com toyota.com bosch.de siemens.com philips.com lego.com nintendo.com uefa.com fifa.com olympics.com espn.com
city-council.org public-library.org history-journal.net village-school.org music-teacher.net hiking-diary.com bird-watch.org river-photos.net
open-data.net local-news.org family-letters.net old-maps.org tea-garden.com winter-sports.net street-theatre.org home-weather.net
""".split())
BLOCKED_KINDS = tuple("""
casino poker slots roulette bets betting jackpot lottery viagra cialis pills pharma porn xxx sex adult cams escort nude torrent warez
crack keygen serials replica payday loans spam seo ads click popup track prize giveaway
""".split())
PLAIN_KINDS = "garden chess school book bike tennis theatre bakery yoga weather travel kitchen science history orchestra".split()
PARTNERS = tuple("online best royal hot cheap fast deals bonus 24 365 club king hub zone shop farm chat top live videos now star".split())
SUBDOMAINS = ("", "www.", "m.", "blog.")
DOMAINS = ("com", "net", "org", "tv", "info", "example.com", "example.org", "example.net")
BLOCKED_PATHS = ("/", "/en/12", "/win/bonus", "/buy-cheap/pills", "/xxx/1.html", "/fr/8", "")
ALLOWED_PATHS = ("/", "/en/734", "/de/12/", "/fr/5.html", "/es/901", "/about/team", "/articles/2021/spring.html", "/wiki/River", "")


def _with_partners(kinds) -> list[str]:
    """Each kind with seven partners, before or behind it, joined or not."""
    forms = ("{k}-{p}.{d}", "{p}-{k}.{d}", "{k}{p}.{d}", "{p}{k}.{d}", "{p}-{k}.{d}", "{k}{p}.{d}", "{p}{k}.{d}")
    return [
        forms[j].format(k=kind, p=PARTNERS[(5 * i + 7 * j) % len(PARTNERS)], d=DOMAINS[(i + 3 * j) % len(DOMAINS)])
        for i, kind in enumerate(kinds) for j in range(len(forms))
    ]


def blocked_hosts() -> list[str]:
    return _with_partners(BLOCKED_KINDS)


def allowed_hosts() -> list[str]:
    """The listed hosts, their names below the domains in turn, and plain kinds with the same partners as the blocked ones: neither a
    domain nor a partner tells much by itself."""
    named = [f"{max(host.split('.')[:-1], key=len)}.{DOMAINS[(n + 3 * k) % len(DOMAINS)]}" for n, host in enumerate(ALLOWED_HOSTS) for k in range(2)]
    return [*ALLOWED_HOSTS, *(h for h in named if h not in ALLOWED_HOSTS), *_with_partners(PLAIN_KINDS)]


def labelled_urls(keep=lambda host: True) -> list[tuple[str, int]]:
    """``(url, 1 for block)``: each listed host that ``keep`` accepts below some subdomains, with the paths dealt in turn."""
    rows = [("", 0)]  # no host tells nothing against a page
    for label, hosts, paths in ((1, blocked_hosts(), BLOCKED_PATHS), (0, allowed_hosts(), ALLOWED_PATHS)):
        for n, host in enumerate(hosts):
            for k, sub in enumerate(SUBDOMAINS):
                if keep(host):
                    rows.append((f"http://{sub}{host}{paths[(n + 2 * k) % len(paths)]}", label))
    return rows


@dataclass(frozen=True)
class UrlModel:
    """Weights by n-gram bucket.  Its size is fixed by ``bits``, not by any data."""

    weights: np.ndarray
    bias: float
    orders: tuple[int, ...]
    bits: int

    def scores(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """Probability of block for each URL."""
        owner, bucket = ngrams(hosts, paths, self.orders, self.bits)
        count = np.maximum(np.bincount(owner, minlength=len(hosts)), 1)
        total = np.bincount(owner, weights=self.weights[bucket], minlength=len(hosts))
        return 1 / (1 + np.exp(-(total / np.sqrt(count) + self.bias)))


def ngrams(hosts: Sequence[str], paths: Sequence[str], orders: Iterable[int], bits: int):
    """The row and bucket of every byte n-gram of ``^host^path$``; grams never cross rows."""
    parts = [f"^{h}^{p}$".encode() for h, p in zip(hosts, paths, strict=True)]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    owners, buckets = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in orders:
        if len(data) < n:
            continue
        h = np.full(len(data) - n + 1, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + data[j : len(data) - n + 1 + j]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        inside = row[: len(h)] == row[n - 1 :]
        owners.append(row[: len(h)][inside])
        buckets.append((h >> np.uint64(64 - bits)).astype(np.int64)[inside])
    return np.concatenate(owners), np.concatenate(buckets)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path by the same rules as ``host_column`` and ``path_column``, for the labelled table."""
    rest = (url or "").partition("://")[2]
    end = min([len(rest), *(i for c in "/?#" if (i := rest.find(c)) >= 0)])
    path = rest[end:].split("?")[0].split("#")[0]
    return rest[:end].translate(str.maketrans(ASCII_UPPER, ASCII_LOWER)), path


def train(
    labelled: Sequence[tuple[str, int]], *, orders: tuple[int, ...] = (3, 4, 5), bits: int = 16, epochs: int = 400,
    rate: float = 0.5, ridge: float = 1e-4,
) -> UrlModel:
    """Full-batch gradient descent on the labelled table, which is small by definition and fits in memory."""
    hosts, paths = zip(*(split_url(u) for u, _ in labelled), strict=True)
    truth = np.array([y for _, y in labelled], float)
    owner, bucket = ngrams(hosts, paths, orders, bits)
    value = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=len(truth)), 1))[owner]
    weights, bias = np.zeros(1 << bits), 0.0
    for _ in range(epochs):
        z = np.bincount(owner, weights=weights[bucket] * value, minlength=len(truth)) + bias
        error = 1 / (1 + np.exp(-z)) - truth
        weights -= rate * (np.bincount(bucket, weights=error[owner] * value, minlength=1 << bits) / len(truth) * 50 + ridge * weights)
        bias -= rate * error.mean()
    return UrlModel(weights, bias, orders, bits)


def host_column(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(?:(?!://).)*+://([^/?#]*)", 1)
    return F.translate(found, ASCII_UPPER, ASCII_LOWER)


def path_column(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(?:(?!://).)*+://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (then the one with the longer host; then block), else null."""
    name = verdict = None
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != BLOCK))
    for r in order:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def judge_urls(
    pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = (), *, key: str = "page_id", url: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """``key, host, path, rule, score, verdict`` of every row; a rule that fits overrides the model."""

    def score(batches):
        for b in batches:
            p = model.scores(b.column("host").to_pylist(), b.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], [*b.schema.names, "score"])

    u = F.col(url).cast("string")
    split = pages.select(F.col(key).alias("_key"), host_column(u).alias("host"), path_column(u).alias("path"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    key_type = split.schema["_key"].dataType.simpleString()
    scored = split.mapInArrow(score, f"_key {key_type}, host string, path string, score double")
    judged = F.coalesce(verdict, F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW))
    return scored.select(F.col("_key").alias(key), "host", "path", name.alias("rule"), "score", judged.alias("verdict"))
