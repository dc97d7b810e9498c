"""Token alignment against a plain two-pointer walk with the tokenizers' own libraries."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import alignment as A

SCHEMA = "doc_id long, text string, a string, row long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(os.path.join(A.FOLDER, A.A_FILE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=os.path.join(A.FOLDER, A.B_FILE))


def spelled(libraries, text):
    """(ids, bytes of each token) of A and of B."""
    a, b = libraries
    byte = A.byte_of_char()
    ia = a.encode(" " + text, add_special_tokens=False).ids
    ta = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
    ib = b.encode(text)
    tb = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
          for p in map(b.id_to_piece, ib)]
    return (ia, ta), (ib, tb)


def brute(libraries, rows):
    per, count = [], Counter()
    for doc, text in rows:
        (ia, ta), (ib, tb) = spelled(libraries, text) if text else (([], []), ([], []))
        if text and not b"".join(ta) == b"".join(tb) == (" " + text).encode():
            ia, ta, ib, tb = [], [], [], []
        ea, eb = np.cumsum([len(t) for t in ta]).tolist(), np.cumsum([len(t) for t in tb]).tolist()
        links = [(x, y) for x, (p, q) in enumerate(zip([0, *ea], ea, strict=False))
                 for y, (r, s) in enumerate(zip([0, *eb], eb, strict=False)) if p < s and r < q] if len(ea) < 400 else walked(ea, eb)
        groups, i, j = [], 0, 0
        for end in sorted(set(ea) & set(eb)):
            x, y = ea.index(end) + 1, eb.index(end) + 1
            groups.append(",".join(map(str, ia[i:x])) + "|" + ",".join(map(str, ib[j:y])))
            i, j = x, y
        pairs = [(ia[x], ib[y]) for x, y in links]
        count.update(pairs)
        per.append((doc, len(ia), len(ib), len(groups), pairs, ";".join(groups)))
    top = {}
    for (_, y), n in count.items():
        top[y] = max(n, top.get(y, 0))
    return sorted(((doc, a, b, g, len(p), sum(count[q] == top[q[1]] for q in p), sum(count[q] for q in p),
                    hashlib.sha256(s.encode()).hexdigest() if s else "") for doc, a, b, g, p, s in per), key=repr)


def walked(ea, eb):
    out, i, j = [], 0, 0
    while i < len(ea):
        out.append((i, j))
        i, j = i + (ea[i] <= eb[j]), j + (eb[j] <= ea[i])
    return out


def texts():
    return [(1, None), (2, ""), (3, " "), (None, "Hello, world!"), (None, "Hello, world!"), (4, "Hello, world!"),
            (5, "<|endoftext|> and <s> or <unk>"), (6, "a▁b"), (7, "ünïcödé 日本語 \U0001f600\U0001f468‍\U0001f469 \u0000\u0001"),
            (8, "  two  spaces \n\n\t tabs  "), (9, "word " * 900), (10, "xq" * 1500), (11, "1234567890" * 50), (12, "é ﬁ   　")]


@pytest.mark.parametrize("hot", [A.HOT, 20, 0])
def test_brute_force(spark, libraries, hot):
    rows = texts()
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], SCHEMA)
    got = A.alignments(df, hot=hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(libraries, rows)


def test_documents(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 2500")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, A.alignments(docs).collect()), key=repr) == brute(libraries, rows)


def test_empty(spark):
    assert A.alignments(spark.createDataFrame([], SCHEMA)).count() == 0


def test_fast_encoder_equals_the_library(libraries):
    tok = A.tokenizers(A.FOLDER)
    for text in [t for _, t in texts() if t] + ["\n" * 3000, " " * 5000 + "x", "it's we'll I'D 'tis", "a" * 3000]:
        got = tok.encode(text)
        (ia, ta), (ib, _) = spelled(libraries, text)
        if got is not None:
            assert got[0].tolist() == ia and got[1].tolist() == ib


def test_walk_of_lanes_equals_plain_walk():
    rng = np.random.default_rng(4)
    for lane in (1, 7, 256):
        ends = [np.unique(np.append(rng.integers(1, 3000, n), 3000)) for n in (900, 700)]
        one = np.array([0])
        first = A.lanes(*ends, np.append(one, len(ends[0])), np.append(one, len(ends[1])), lane)
        a, b, cut = A.walk(*ends, *first)
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == walked(*(e.tolist() for e in ends))
        assert cut.sum() == len(np.intersect1d(*ends))
        assert lane > 7 or len(first[0]) > 60


def test_pack():
    for ids in ([], [0, 1, 65535], [70000, 3]):
        assert A._unpack(A._pack(np.array(ids, np.int64))).tolist() == ids
