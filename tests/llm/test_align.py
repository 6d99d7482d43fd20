import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from clinicgen.llm import align as L

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(docs, libraries):
    """Whole texts by the libraries; groups and links by plain loops."""
    tok, sp = libraries
    byte = {}
    fresh = 256
    for c in range(256):
        if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174:
            byte[chr(c)] = c
        else:
            byte[chr(fresh)] = c
            fresh += 1
    parts = []
    for doc_id, text in docs:
        raw = (" " + (text or "")).encode()
        ids_a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = sp.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in tok.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            parts.append((doc_id, None))
            continue
        ends_a, ends_b = set(), set()
        for ends, tokens in ((ends_a, bytes_a), (ends_b, bytes_b)):
            at = 0
            for t in tokens:
                at += len(t)
                ends.add(at)
        groups, i, j, a, b = [([], [])], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            while i < len(ids_a):
                groups[-1][0].append(ids_a[i])
                a += len(bytes_a[i])
                i += 1
                if a in ends_b:
                    break
            while j < len(ids_b):
                groups[-1][1].append(ids_b[j])
                b += len(bytes_b[j])
                j += 1
                if b in ends_a:
                    break
            groups.append(([], []))
        parts.append((doc_id, (len(ids_a), len(ids_b), groups[:-1])))
    links = [Counter((x, y) for a, b in p[2] for x in a for y in b) if p else Counter() for _, p in parts]
    count = Counter(pair for c in links for pair in c)
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (doc_id, p), c in zip(parts, links, strict=True):
        if not p:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        name = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in p[2])
        out.append((doc_id, p[0], p[1], len(p[2]), sum(c.values()), sum(n for k, n in c.items() if count[k] == top[k[0]]),
                    sum(n * count[k] for k, n in c.items()), hashlib.sha256(name.encode()).hexdigest()))
    return out


def test_products_equal_dense_ones(monkeypatch):
    rng = np.random.default_rng(3)
    for limit in (1, 7, 1 << 20):
        monkeypatch.setattr(L, "_SLICE", limit)
        for rows, mid, cols, n in ((5, 4, 6, 20), (1, 1, 1, 3), (9, 30, 2, 0), (40, 8, 40, 300)):
            a, b = (L.Csr.from_pairs(rng.integers(0, r, n), rng.integers(0, c, n), r, c) for r, c in ((rows, mid), (mid, cols)))
            da, db = np.zeros((rows, mid), int), np.zeros((mid, cols), int)
            for m, d in ((a, da), (b, db)):
                np.add.at(d, (np.repeat(np.arange(len(m.start) - 1), np.diff(m.start)), m.col), m.val)
            got = np.zeros((rows, cols), int)
            for r, c, v in L.gustavson(a, b):
                assert (got[r, c] == 0).all()
                got[r, c] = v
            assert (got == da @ db).all()
            t = b.transpose()
            assert (np.repeat(np.arange(cols), np.diff(t.start)) == np.sort(b.col)).all() and t.width == mid
    overlap = {(int(r), int(c)): int(v) for part in L.gustavson(L.Csr.of_spans(np.array([3, 2, 1])), L.Csr.of_spans(np.array([1, 4, 1])).transpose()) for r, c, v in zip(*part, strict=True)}
    assert overlap == {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 1}


ODD = [None, "", " ", "  ", " , ", "so, it is", ", ", " ,", ".", "U.S. a.b.", "wait... what?! no;", "a", " a", "a ", "a  b", "a   b   c", "word.\nNext line\n\n x", "\tx y\t z \n", "▁x plain", "plain ▁ x", "<|endoftext|> and <s> </s> <unk> [0x0A] <0x41>",
       "\x00 \x1c\x1d a\x1cb \x85 c\xa0 d　e  f", "é ﬁ 日本語テキスト 🙂👍🏽 ñandú", "it's we'll 'tis 12345 1,234.5 !!!??? $$$", "0" * 5000, "xyzzy" * 700 + " " + "ab " * 900, "ʼn ǆ Å Å İ"]


def test_texts_against_the_libraries(lspark, make_docs, libraries):
    rng = random.Random(5)
    alphabet = ["a", "e", "the", "ing", "é", "ß", "字", "🙂", "\n", "\t", "1", "00", "'s", ".", ",", "-", "\xa0", "\x1c"]
    texts = ODD + ["".join(rng.choice(alphabet) + rng.choice(["", "", " ", "  " if rng.random() < 0.1 else " "]) for _ in range(rng.randint(1, 120))) for _ in range(150)]
    docs = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(3, "the thing"), (3, "the thing"), (1 << 60, "the thing")]
    want = sorted(brute(docs, libraries), key=str)
    for block in (1 << 20, 300):  # one block a task, and many
        got = [tuple(r[c] for c in COLUMNS) for r in L.alignments(make_docs(docs), A, B, block_pieces=block).collect()]
        assert sorted(got, key=str) == want
    assert sum(r[-1] == "" for r in want) < 20  # most texts are given back


def test_pieces_of_the_test_texts_are_the_whole(lspark, libraries):
    docs = [(r.doc_id, r.text) for r in lspark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(120).collect()]
    from clinicgen.llm.common import read

    got = {r.doc_id: r for r in L.alignments(read(lspark, "/root/testdata/sf0.001", "documents").where(f"doc_id in ({','.join(str(d) for d, _ in docs)})"), A, B).collect()}
    for row in brute(docs, libraries):
        assert tuple(got[row[0]][c] for c in COLUMNS) == row
        assert got[row[0]].n_overlaps <= got[row[0]].n_links


def test_empty(lspark, make_docs):
    assert L.alignments(make_docs([]), A, B).count() == 0
    rows = L.alignments(make_docs([(1, None), (2, "")]), A, B).collect()
    assert {tuple(r[c] for c in COLUMNS) for r in rows} == {(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")}
