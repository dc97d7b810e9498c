"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tessera.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, id long, word string, n long"


def brute(rows, longest=3, least=10, cover=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in found.items():
        inside = any(l2 == lang and len(q) > len(p) and 100 * b >= cover * a
                     and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l2, q), b in found.items())
        if not inside:
            score, _, l, r = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                 for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, k, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items()
                  for k, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1))


def corpus():
    rng = random.Random(2)
    words = ["a", "b", "The", "new", "york", "times", "é", "ß", "x y", "of"]
    rows = [(None, "en"), ("", "en"), (" .,;", None), ("one", "xx"), ("new york times " * 4000, "en"), ("a. a! a? " * 30, None)]
    for _ in range(150):
        t = " ".join(rng.choice(words) if rng.random() < 0.6 else rng.choice(["new york times", "New\tYork", "of the,", "a b\x0ba"])
                     for _ in range(rng.randint(0, 60)))
        rows.append((t, rng.choice(["en", "en", "de", None, "und"])))
    return rows + rows[20:40]


def frame(spark, rows):
    return spark.createDataFrame([(None if k % 5 else 7, t, l, 1, "x", 2) for k, (t, l) in enumerate(rows)], SCHEMA)


def listed(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def test_brute_force(spark):
    rows = corpus()
    assert listed(C.collocations(frame(spark, rows))) == brute(rows)


def test_longer_phrases_and_top(spark):
    rows = corpus()
    got = listed(C.collocations(frame(spark, rows), longest=4, least=6, cover=80, top=9))
    assert got == brute(rows, 4, 6, 80, 9)


def test_empty(spark):
    df = frame(spark, [("a b", "en")])
    assert C.collocations(df.limit(0)).count() == 0 and C.collocations(df).count() == 0


def test_full_filter_drops_nothing(spark, monkeypatch):
    """A filter so small that it lets everything pass changes no result."""
    rows = corpus()
    monkeypatch.setattr(C, "frequent_filter", lambda frequent, size: frequent.sparkSession.sparkContext.broadcast(
        np.full(C.FILTER >> 6, 2 ** 64 - 1, np.uint64)))
    assert listed(C.collocations(frame(spark, rows))) == brute(rows)


def test_other_seed_same_counts():
    """Ids by the second hash tell the same words apart."""
    block = pa.table({"text": ["a b a, c", "b"], "lang": ["en", "de"]})
    for seed in (0, 1, 2):
        words, ids, piece = C.identified(block, seed)
        assert len(words) == 5 and ids[0] == ids[2] and len(set(ids.tolist())) == 4
        assert piece[0] == piece[1] == piece[2] != piece[3] != piece[4]


def test_stripes_pack_and_open():
    rng = np.random.default_rng(0)
    columns, n = C._sums([rng.integers(0, 9, 500).astype(np.uint64) for _ in range(3)], np.ones(500, np.int64))
    back, m = C._opened(C._packed(columns, n), 3)
    assert n.sum() == 500 and all((x == y).all() for x, y in zip(columns, back, strict=True)) and (m == n).all()
