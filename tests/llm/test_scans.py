import random
import re

import pytest

from tests.llm.conftest import ODD, frame, prose
from tollgate.llm import contamination as op9
from tollgate.llm import license_scan as op8
from tollgate.llm import url_filter as op10
from tests.llm.test_dedup import shingle_set


# --------------------------------------------------------------- license ---

def scan_brute(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in op8.BASE:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_license_scan_equals_brute_force(spark):
    r = random.Random(4)
    vocabulary = "cc by all rights reserved general public license x é".split()
    rows = ODD + [(500 + i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 60)))) for i in range(60)]
    rows += [(700, "CC BY"), (701, "cc-by cc\nby!"), (702, "general public"), (703, "All rights, reserved. all RIGHTS reserved")]
    got = op8.license_scan(frame(spark, rows)).collect()
    key = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(key, key=repr) == sorted(((i, *scan_brute(t)) for i, t in rows), key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not r.base_labels for r in got)


def test_license_templates_are_verified(spark):
    rows = [(1, "x Licensed under the Apache License, Version 2.0 y"), (2, "permission is hereby granted, free of any charge, to "
             "any person obtaining a copy of this software"), (3, "licensed under the apache"), (4, "license version 2 0 apache the under")]
    got = {r.doc_id: r for r in op8.license_scan(frame(spark, rows)).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4)] == ["apache-2.0", "mit", "", ""]
    assert got[1].score == 1.0 and 0.75 <= got[2].score < 1 and got[3].score == 0


def template_brute(text):
    """Labels and best share: of all stretches of diagonals, by distinct template positions."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    labels, best = set(), 0.0
    for phrase, label in op8.TEMPLATES:
        p = phrase.split()
        for d in range(-len(p), len(words)):
            held = {t for t in range(len(p) - 1) for e in range(op8.MERGE_WITHIN + 1)
                    if 0 <= d + e + t < len(words) - 1 and words[d + e + t:d + e + t + 2] == p[t:t + 2]}
            if len(held) / (len(p) - 1) >= op8.VERIFY_SHARE:
                labels.add(label)
                best = max(best, len(held) / (len(p) - 1))
    return labels, best


def test_license_templates_equal_brute_force(spark):
    r, rows = random.Random(8), []
    for i in range(120):
        words = r.choice(op8.TEMPLATES)[0].split() * r.choice([1, 1, 2])
        for _ in range(r.randrange(0, 5)):
            at = r.randrange(len(words))
            words[at:at + r.randrange(0, 3)] = [r.choice(["x", "the", "license", "public license"])] * r.randrange(0, 3)
        rows.append((i, " ".join(prose(i, r.randrange(0, 9)) + words)))
    rows += [(200, "mit license mit license mit license"), (201, "general public license " + "public license " * 4),
             (202, "released under the mit license " * 30), (203, "released under the the mit mit license license")]
    got = {r.doc_id: r for r in op8.license_scan(frame(spark, rows)).collect()}
    for i, text in rows:
        labels, best = template_brute(text)
        base = set(filter(None, got[i].base_labels.split(",")))
        assert set(filter(None, got[i].labels.split(","))) == labels | base, text
        assert got[i].score == pytest.approx(1.0 if base else best)
    assert got[200].labels == "" and got[201].labels == "gpl" and got[202].labels == "mit"


def test_license_spans_are_bounded_and_apart(spark):
    spans = op8.license_spans(frame(spark, [(1, "released under the mit license " * 3 + "x " * 9 + "all rights reserved")])).collect()
    assert sorted((s.label, s.first_word, s.end_word) for s in spans) == [
        ("mit", 0, 5), ("mit", 5, 10), ("mit", 10, 15), ("reserved", 24, 27)]


def test_license_scan_empty(empty):
    assert op8.license_scan(empty).count() == 0


# --------------------------------------------------------- contamination ---

def bench_frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("lookup_limit", [op9.LOOKUP, 0])  # 0: no lookup, everything is shuffled
def test_contamination_equals_brute_force(spark, lookup_limit):
    r = random.Random(6)
    items = [(i, " ".join(prose(900 + i, n))) for i, n in enumerate([1, 3, 4, 5, 6, 8, 12, 15, 20, 40, 60, 120])]
    items += [(50, None), (51, ""), (11, items[-1][1]), (None, items[8][1])]
    docs = list(ODD)
    for i, (_, text) in enumerate(items[:12]):
        for share in (0, 0.02, 0.05, 0.2):
            inside = [w if r.random() > share else "edit" for w in text.split()]
            docs.append((300 + len(docs), " ".join([*prose(i, 2000, 5000), *inside, *prose(i + 50, 1500, 5000)])))
        docs.append((300 + len(docs), text.upper()))
    want = []
    sets = [(d, shingle_set(t)) for d, t in docs]
    for i, t in items:
        s = shingle_set(t)
        want += [(d, i, len(s), len(s & x)) for d, x in sets if s and 100 * len(s & x) >= 75 * len(s)]
    got = op9.contamination(frame(spark, docs), bench_frame(spark, items), lookup_limit=lookup_limit).collect()
    assert sorted(((x.doc_id, x.item_id, x.n_item, x.n_common) for x in got), key=repr) == sorted(want, key=repr)


def test_decontaminate_keeps_clean_rows_and_columns(spark, odd, empty):
    bench = bench_frame(spark, [(1, "the same text here for all")])
    kept = op9.decontaminate(odd, bench)
    assert kept.columns == odd.columns
    assert kept.count() == len(ODD) - 2
    assert op9.contamination(empty, bench).count() == 0
    assert op9.contamination(odd, bench_frame(spark, [])).count() == 0


def test_needed_matches_bound_the_miss():
    assert op9.needed(12) >= 1 and op9.needed(40) > op9.needed(12) and op9.needed(2) == 0


# ------------------------------------------------------------------ urls ---

def url_brute(url, rules, default="allow"):
    m = re.match(r"(?s)\A.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[1] if best else None, best[2] if best else default


URLS = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://Example.NET/en/x", "https://a.b.example.net/en/?q#f",
        "http://example.net?x/en/", "http://xexample.net/en/", "http://example.com/de/1", "http://m.example.com/fr/", "http://org/fr/",
        "http://x.org/fr/a#b", "http://x.org/en", "ftp://x..net/", "http://.net/a", "http://net./a", "a://b://example.com/de/",
        "http://exämple.org/fr/é", "http://user@example.com:80/de/", "http://\x01.net/", "http://example.com\n/de/"]


def test_url_filter_equals_brute_force(spark):
    r = random.Random(8)
    hosts = ["net", "example.net", "m.example.net", "example.com", "org", "z.org", "other"]
    urls = URLS + [f"http://{r.choice(['', 'a.', 'b.c.'])}{r.choice(hosts)}/{r.choice(['en/', 'de/', 'fr/', ''])}{i}" for i in range(300)]
    rows = [(i if i % 9 else None, u, "clash", "clash") for i, u in enumerate(urls * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, key string")
    for rules in (op10.RULES, [*op10.RULES, ("block", "m.example.net", "/en/"), ("allow", "m.example.net", "/en/1"),
                               ("block", "b.c.example.com", "/"), ("allow", "", "/")]):
        table = spark.createDataFrame(list(rules), "action string, host string, path string")
        got = op10.url_filter(pages, table).collect()
        named = [x for x in rules if x[1]]
        want = [(i, *url_brute(u, named)) for i, u, _, _ in rows]
        assert sorted(((x.page_id, x.host, x.path, x.rule, x.verdict) for x in got), key=repr) == sorted(want, key=repr)


def test_url_filter_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert op10.url_filter(pages, op10.fixed_rules(spark)).count() == 0
    none = spark.createDataFrame([], "action string, host string, path string")
    one = op10.url_filter(spark.createDataFrame([(1, "http://a/b")], "page_id long, url string"), none, default="block").first()
    assert (one.host, one.path, one.rule, one.verdict) == ("a", "/b", None, "block")
