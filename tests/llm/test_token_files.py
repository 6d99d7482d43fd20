import random
import zlib

import numpy as np
import pytest

from clinicgen.llm import token_files as T

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tok():
    return public_tokenizers.path("byte_bpe_50k.json")


TEXTS = ["", None, "a", " a", "a ", "  a", "a  b", "a\n b", "a \nb", "thing, and thing. it's don't 's 'a' x's y", "tab\t x\u00a0y \u3000z", "end <|endoftext|> of", "é ü 日本 語 12 3,4 5. 1.000",
         "a,b, c.. d., (e) [f]; ! ?", "\x1c \x1d x", "emoji 😀 😀! ok", "_under_ score_ _x", "x" * 3000, "Ab " * 4000]


def test_encoder_equals_the_library(tok):
    from tokenizers import Tokenizer

    lib, enc = Tokenizer.from_file(tok), T.Encoder(tok)
    rng = random.Random(0)
    random_texts = ["".join(rng.choice("ab ,.'!\n\té1_ s\u00a0") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    for batch in (TEXTS, random_texts, TEXTS):
        got = enc.encode(batch)
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [lib.encode(t or "", add_special_tokens=False).ids for t in batch]


@pytest.mark.parametrize("seq_len,batch_rows", [(8, 3), (1024, 64)])
def test_round_trip(lspark, make_docs, tmp_path, tok, seq_len, batch_rows):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tok)
    rows = [(100 - i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (50, "same id"), (50, "same id")]
    manifest = T.write_token_files(make_docs(rows).repartition(5), f"file:{tmp_path}/t", tok, seq_len, batch_rows)
    got = T.read_token_files(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    crc = lambda t: zlib.crc32(np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
    assert sorted((r.doc_id, r.ids_crc32) for r in got if r.doc_id) == sorted((d, crc(t)) for d, t in rows if d)
    for m in manifest.collect():
        n = -(-m.n_ids // seq_len)
        seqs = [T.sequence(m.ids_file, i) for i in range(n)]
        assert all(len(a) == len(b) == seq_len for a, b in seqs) and sum(int(b.sum()) for _, b in seqs) == m.n_ids


def test_empty(lspark, make_docs, tmp_path, tok):
    manifest = T.write_token_files(make_docs([]), f"{tmp_path}/e", tok)
    assert manifest.count() == 0 and T.read_token_files(manifest).count() == 0
