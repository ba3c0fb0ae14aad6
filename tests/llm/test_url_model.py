"""The URL model on hosts it has not seen, and feature by feature."""

import math
import zlib

import numpy as np

from corpusgate.llm import url_filter

SF = "/root/testdata/sf0.01"


def name_of(host: str) -> str:
    return max(host.split(".")[:-1], key=len)


def test_held_out_hosts_both_ways():
    """Four folds by the host's name, so no name is in both parts under any domain."""
    right = {True: [], False: []}
    for fold in range(4):
        def unseen(host, fold=fold):
            return zlib.crc32(name_of(host).encode()) % 4 == fold

        model = url_filter.train(url_filter.labelled_urls(lambda h: not unseen(h)))
        for block, hosts in ((True, url_filter.blocked_hosts()), (False, url_filter.allowed_hosts())):
            mine = [h for h in hosts if unseen(h)]
            right[block] += ((model.scores(mine, ["/"] * len(mine)) >= 0.5) == block).tolist()
    assert len(right[True]) > 200 and len(right[False]) > 300
    assert np.mean(right[True]) >= 0.9 and np.mean(right[False]) >= 0.9


def test_ordinary_hosts_are_not_blocked(spark):
    model = url_filter.train(url_filter.labelled_urls())
    plain = "nytimes.com gov.uk stanford.edu reuters.com nature.com github.io bbc.co.uk www.yale.edu".split()
    listed = {name_of(h) for h in [*url_filter.allowed_hosts(), *url_filter.blocked_hosts()]}
    assert not listed & {name_of(h) for h in plain if h != "github.io"}  # its namesake in another domain is listed
    assert (model.scores(plain, ["/"] * len(plain)) < 0.5).all()
    bad = ["sex-chat.tv", "casino-hall.example.org", "win-poker-bonus.net", "cheap-viagra.example.com"]
    assert (model.scores(bad, ["/"] * len(bad)) >= 0.5).all()
    given = {url_filter.split_url(r.url)[0] for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect()}
    assert not {h.split(".")[-3] for h in given if h.count(".") > 1} & listed


def test_scores_gram_by_gram():
    model = url_filter.train(url_filter.labelled_urls()[:300], epochs=20)
    hosts, paths = ["example.org", "", "hé.net", "a", "casino" * 40], ["/", "", "/x?y", "/1", "/"]
    for host, path, score in zip(hosts, paths, model.scores(hosts, paths), strict=True):
        data, total, count = f"^{host}^{path}$".encode(), 0.0, 0
        for n in model.orders:
            for i in range(len(data) - n + 1):
                h = n
                for c in data[i : i + n]:
                    h = (h * 0x100000001B3 + c) % (1 << 64)
                h = (h ^ (h >> 29)) * 0x9E3779B97F4A7C15 % (1 << 64)
                total += model.weights[h >> (64 - model.bits)]
                count += 1
        assert math.isclose(score, 1 / (1 + math.exp(-(total / math.sqrt(max(count, 1)) + model.bias))), rel_tol=1e-9)
