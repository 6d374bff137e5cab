"""op13: tokens of two vocabularies, aligned and counted, against a plain version."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from presslens.llm import alignment, queries
from tests.conftest import SF

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NOTHING = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def plainly():
    """Figures of each text by whole-text encoding and dictionaries."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = {chr(x): x for x in (*range(33, 127), *range(161, 173), *range(174, 256))}
    shown |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown.values())}

    def said(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a, bytes_b = [bytes(shown[c] for c in a.id_to_token(i)) for i in ids_a], [said(i) for i in ids_b]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return None
        return ids_a, ids_b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()

    def figures(texts):
        found = [tokens(t) for t in texts]
        links = [[] if f is None else [(x, y) for x, end in zip(f[0], f[2], strict=True) for y in [y for y, e in zip(f[1], f[3], strict=True) if e == end]] for f in map(_indexed, found)]
        count = Counter(p for some in links for p in some)
        best = {}
        for (_, y), n in count.items():
            best[y] = max(best.get(y, 0), n)
        out = []
        for f, some in zip(found, links, strict=True):
            if f is None:
                out.append(NOTHING)
                continue
            cuts = sorted(set(f[2]) & set(f[3]))
            groups, i, j = [], 0, 0
            for cut in cuts:
                x, y = f[2].index(cut, i) + 1, f[3].index(cut, j) + 1
                groups.append(",".join(map(str, f[0][i:x])) + "|" + ",".join(map(str, f[1][j:y])))
                i, j = x, y
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((len(f[0]), len(f[1]), len(cuts), len(some), sum(count[p] == best[p[1]] for p in some), sum(count[p] for p in some), digest))
        return out

    return figures


def _indexed(f):
    """Only ends that both sides have, so the plain search of links stays short."""
    if f is None:
        return None
    both = set(f[2]) & set(f[3])
    a, b = [(x, e) for x, e in zip(f[0], f[2], strict=True) if e in both], [(x, e) for x, e in zip(f[1], f[3], strict=True) if e in both]
    return [x for x, _ in a], [x for x, _ in b], [e for _, e in a], [e for _, e in b]


def rows_of(frame):
    return [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in frame.collect()]


ODD = [None, "", " ", "  a", "a ", "a  b", "\n", "a\n", "a\nb", "\na", "a\n\nb", "a\n\n\nb", "a\n\n", "a\tb", "a\r\nb", "▁x", "a▁b", "x y", "éé", "<|endoftext|> <s> </s> <unk> <0x0A>", "日本語 текст", "\U0001f600‍\U0001f4a9", "don't we'll 12345.67", "a\x00b", "﻿x", "x y z", "x\u0085y"]


def test_chunks_equal_whole_texts(plainly):
    draw = random.Random(1)
    letters = "ab Zz9.,'\n\té́ß中д‍▁ '-"
    texts = ODD + ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 30))) for _ in range(3000)]
    known = alignment.Aligner(A, B)
    got = [(n_a, n_b, n_groups, digest) for n_a, n_b, n_groups, digest, _, _ in known.align(texts)]
    assert got == [(w[0], w[1], w[2], w[6]) for w in plainly(texts)]


def test_query_equals_plain_version(spark, plainly):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(zip(docs, plainly(list(docs.values())), strict=True))
    got = queries.op13_alignment(spark, SF)
    assert {r["doc_id"]: rows for r, rows in zip(got.collect(), rows_of(got), strict=True)} == want


@pytest.mark.parametrize("merged", [alignment.MERGED, 50, 1])
def test_slices_equal_whole_radices(spark, plainly, merged):
    """Small runs and blocks, sliced or not; repeated rows, odd texts, null ids and clashing names."""
    texts = [*ODD, *["the same words again and again , the same"] * 20, "word " * 3000 + "end", *[f"some other words {k}, and the rest of it" for k in range(40)]]
    frame = spark.createDataFrame([(k % 7 or None, t, 1, "x") for k, t in enumerate(texts)], "doc_id long, text string, row int, radix string").repartition(3)
    assert sorted(rows_of(alignment.align(frame, A, B, merged=merged, run=40, block=7))) == sorted(plainly(texts))


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_merge_keeps_order_and_every_record():
    draw = np.random.default_rng(2)
    runs = []
    for _ in range(9):
        keys = np.sort(draw.integers(0, 50, draw.integers(0, 300)))
        runs.append([(keys[k : k + 13], np.arange(len(keys))[k : k + 13], np.ones(len(keys), np.int64)[k : k + 13]) for k in range(0, len(keys), 13)])
    got = list(alignment.merge([iter(r) for r in runs]))
    keys = np.concatenate([g[0] for g in got])
    assert (np.diff(keys) >= 0).all()
    assert Counter(zip(keys.tolist(), np.concatenate([g[1] for g in got]).tolist(), np.concatenate([g[2] for g in got]).tolist(), strict=True)) == Counter((k, run, d) for run, blocks in enumerate(runs) for b in blocks for k, d in zip(b[0].tolist(), b[1].tolist(), strict=True))
    for batch in alignment.by_side(alignment.merge([iter(r) for r in runs]), 0):
        keys = keys[len(batch[0]) :]
        assert not len(keys) or keys[0] != batch[0][-1]
