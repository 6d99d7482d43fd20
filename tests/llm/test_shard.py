import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from clinicgen.llm import shard as S


def check_exact(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    n = len(rows)
    assert sorted(len(by.get(s, [])) for s in range(shards)) == sorted(n // shards + (s < n % shards) for s in range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_draws_follow_the_law(lspark):
    n, k, t = 6, 5, 14
    u = (F.col("id") + 0.5) / 20000.0
    got = Counter(r.x for r in lspark.range(20000).select(S.hypergeometric(F.lit(n), F.lit(k), F.lit(t), u).alias("x")).collect())
    for x in range(0, 6):
        p = math.comb(k, x) * math.comb(t - k, n - x) / math.comb(t, n)
        assert abs(got[x] / 20000 - p) < 2e-4
    edge = lspark.range(1).select(*[S.hypergeometric(F.lit(a), F.lit(b), F.lit(c), F.lit(0.7)) for a, b, c in ((0, 0, 0), (0, 5, 9), (9, 5, 9), (4, 9, 9), (3, 0, 9), (10 ** 9, 10 ** 9, 2 * 10 ** 9))]).first()
    assert list(edge)[:5] == [0, 0, 5, 4, 0] and abs(edge[5] - 5e8) < 1e6


def test_matrix_margins(lspark):
    counts = lspark.createDataFrame([(0, 70), (1, 3), (3, 900), (6, 27)], "block bigint, n bigint")
    rows = {r.block: r.quota for r in S.communication_matrix(counts, 3, [250] * 4, 5).collect()}
    assert [sum(rows[b]) for b in range(8)] == [70, 3, 0, 900, 0, 0, 27, 0]
    assert [sum(rows[b][s] for b in rows) for s in range(4)] == [250] * 4


def test_exact_sizes_and_uniformity(lspark):
    df = lspark.range(4003, numPartitions=7)
    out = S.hypergeometric_shards(df, 8, seed=1, rows_per_block=100).collect()
    check_exact(out, 8)
    assert sorted(r.id for r in out) == list(range(4003))
    same = sum(a.shard == b.shard for a, b in zip(sorted(out, key=lambda r: r.id), sorted(out, key=lambda r: r.id)[1:], strict=False))
    assert abs(same / 4002 - 1 / 8) < 0.03
    low = [r.slot for r in out if r.shard == 0 and r.id < 2000]
    assert abs(sum(low) / len(low) - 250) < 30  # the order inside a shard does not follow the input


def test_documents_and_cases(lspark, make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (2, None), (None, ""), (3, "ü" * 5000)] + [(9, "same")] * 40)
    out = S.shard_documents(docs).collect()
    check_exact(out, 16)
    size = {r.doc_id: (r["size"], r.text_crc32) for r in out}
    assert size[3] == (10001, zlib.crc32(("ü" * 5000).encode())) and size[2] == (1, 0) and size[None] == (1, 0)
    assert S.shard_documents(make_docs([])).count() == 0
    both = S.hypergeometric_shards(docs, 3)
    assert both.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "score", "copies", "shard", "slot"]
    check_exact(both.collect(), 3)
    assert [tuple(r) for r in S.hypergeometric_shards(docs, 3).select("shard", "slot", "doc_id").collect()] == [(r.shard, r.slot, r.doc_id) for r in both.collect()]
