import hashlib

from clinicgen.llm import chat as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, i int, body string"


def conv(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


ROWS = [(1, 0, "system", "be \\s \\l <turn x>"), (1, 1, "user", "hi </turn>"), (1, 2, "assistant", "a<b>c\\"), (1, 3, "user", "é😀"), (1, 4, "assistant", ""),
        (1, 5, "assistant", "\\\\l"), (1, 6, "user", "left over"), (2, 0, "user", None), (3, 0, "assistant", "first"), (None, 0, "user", "no id"), (None, 1, "assistant", "x"),
        (4, 1, None, "null role"), (4, None, "user", "null turn"), (5, 0, "user", "twice"), (5, 0, "user", "twice"), (5, 0, "assistant", "tie"), (6, 0, "user", "z" * 200_000),
        *[(7, k, "assistant" if k % 2 else "user", f"t{k} <{k}>") for k in range(300)]]


def brute(rows):
    esc = lambda s: s.replace("\\", "\\s").replace("<", "\\l").replace(">", "\\g")
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        at, chars, last = 0, 0, 0
        for _, _, r, x in turns:
            at += len(f"<turn {esc(r)}>{esc(x)}</turn>")
            if r == "assistant":
                chars, last = chars + at, at
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss), chars + at - last))
    return sorted(out, key=str)


def test_digest_against_brute_force(lspark, tmp_path):
    got = C.digest(C.format_conversations(conv(lspark, ROWS).repartition(4), f"file:{tmp_path}/c"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS)


def test_examples_hold_context_and_one_trainable_reply(lspark):
    stored = C.transcripts(conv(lspark, ROWS))
    ex = C.examples(stored).where("conv_id = 1").orderBy("target_turn").collect()
    assert [e.target_turn for e in ex] == [2, 4, 5]
    assert ex[0].text == "<turn system>be \\ss \\sl \\lturn x\\g</turn><turn user>hi \\l/turn\\g</turn><turn assistant>a\\lb\\gc\\s</turn>"
    assert [e.text[e.loss_start:e.loss_start + e.loss_chars] for e in ex] == ["a\\lb\\gc\\s", "", "\\s\\sl"]
    assert all(b.text.startswith(a.text) for a, b in zip(ex, ex[1:], strict=False))
    back = C.examples(stored).select("conv_id", C.read_turns(C.F.col("text")).alias("t")).where("conv_id = 7").collect()
    assert sorted(len(r.t) for r in back) == list(range(2, 301, 2))
    assert max(back, key=lambda r: len(r.t)).t[3] == ("assistant", "t3 <3>")


def test_empty(lspark):
    assert C.digest(C.transcripts(conv(lspark, []))).count() == 0
