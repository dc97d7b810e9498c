"""SimHash near-dedup against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from tessera.llm.simhash import fingerprints, linked, simhash_duplicates

SCHEMA = "doc_id long, text string, component_id string, fp string"


def fingerprint(text):
    if text is None:
        return 0
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def brute(rows):
    """component of each row: union of rows within two bits, named by the smallest id."""
    fp = [fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            comp[i] = comp[comp[i]]
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 2:
                comp[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((d, format(f, "016x"), least.get(root(i))) for i, ((d, _), f) in enumerate(zip(rows, fp, strict=True))), key=repr)


def test_fingerprints():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "One", "one two", "One\x0btwo\x0cTHREE", "a b c d", "Ünïcode ÄÖ x ß",
             "same three words " * 4000, " ".join(rng.choice("abcdefgh") * rng.randint(1, 40) for _ in range(3000))]
    got = fingerprints([None if t is None else t.encode() for t in texts])
    assert [int(x) for x in got] == [fingerprint(t) for t in texts]
    assert len(fingerprints([])) == 0


@pytest.mark.parametrize("errors", [1, 2])
def test_walk_meets_all_pairs(spark, errors):
    rng = random.Random(errors)
    values = {rng.getrandbits(64) for _ in range(200)} | {0, 1, 3, 2 ** 64 - 1}
    for v in list(values)[:40]:  # near ones in every third
        for _ in range(6):
            w = v
            for _ in range(rng.randint(1, 3)):
                w ^= 1 << rng.randrange(64)
            values.add(w)
    dense = rng.getrandbits(64)  # a family that differs in the same few bits
    for _ in range(150):
        values.add(dense ^ sum(1 << b for b in rng.sample([0, 3, 20, 21, 22, 42, 43, 44, 60, 63], rng.randint(0, 4))))
    v = np.array(sorted(values), np.uint64)
    want = {tuple(sorted((signed(int(v[i])), signed(int(v[j])))))
            for i in range(len(v)) for j in range(i) if int(v[i] ^ v[j]).bit_count() <= errors}
    got = [tuple(r) for r in linked(spark.createDataFrame([(signed(int(x)),) for x in v], "fp long"), errors).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_walk_of_nothing_and_bad_budget(spark):
    assert linked(spark.createDataFrame([], "fp long")).count() == 0
    with pytest.raises(ValueError):
        linked(spark.createDataFrame([], "fp long"), 3)


def test_components(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " "), (4, "one"), (5, "One"), (None, "one"), (None, None), (7, "x y"), (7, "a b c"), (6, "a b c")]
    for k in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([40, 300, 900]))]
        for _ in range(rng.randint(1, 7)):  # near copies: some link in a chain, some do not
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((rng.choice([100 + len(rows), 100 + len(rows), 20, None]), " ".join(copy)))
            base = copy if rng.random() < 0.5 else base
    df = spark.createDataFrame([(d, t, "extra", "extra") for d, t in rows], SCHEMA)
    got = simhash_duplicates(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert simhash_duplicates(df.limit(0)).count() == 0
