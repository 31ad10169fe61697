import zlib
from collections import Counter, defaultdict
from fractions import Fraction

from pricewright.llm.sharding import interleave, shard_digests, write_shards


def check(rows, sources, shards):
    """Counts, slots and the mixture of every shard, from the definition."""
    total = len(rows)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    counts = [len(by_shard[s]) for s in range(shards)]
    assert sum(counts) == total and max(counts) - min(counts) <= 1
    for s, members in by_shard.items():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    for source, n in sources.items():
        for s in range(shards):
            share = sum(r.source == source for r in by_shard[s])
            assert abs(share - Fraction(n * len(by_shard[s]), total)) <= len(sources) + 1


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = shard_digests(docs).collect()
    given = {r.doc_id: r for r in docs.collect()}
    check(rows, Counter(r.source for r in given.values()), 8)
    for r in rows:
        data = given[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_buckets_do_not_change_the_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source")
    one = {r.doc_id: (r.shard, r.slot) for r in interleave(docs, "source", 3, bucket_rows=10**9).collect()}
    assert len(one) == docs.count()
    narrow = interleave(docs, "source", 3, bucket_rows=7).collect()
    check(narrow, Counter(r.source for r in docs.collect()), 3)
    again = {r.doc_id: (r.shard, r.slot) for r in interleave(docs.repartition(5), "source", 3, bucket_rows=7).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in narrow}


def test_order_is_by_fractional_rank(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(40)], "doc_id long, source string")
    rows = sorted(interleave(df, "source", 4, bucket_rows=6).collect(), key=lambda r: (r.shard, r.slot))
    seen = Counter()
    of = Counter(r.source for r in rows)
    fractions = []
    for r in rows:
        seen[r.source] += 1
        fractions.append(Fraction(2 * seen[r.source] - 1, 2 * of[r.source]))
    assert fractions == sorted(fractions)


def test_rows_of_any_kind(spark, tmp_path):
    rows = [(1, "x", "s", 3), (1, "x", "s", 3), (1, "x", "s", 3), (2, None, None, 4), (None, "é", "", 5), (3, "", "t", 6), (4, "w " * 90_000, "t", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard long")
    got = shard_digests(docs, 3).collect()
    check(got, Counter(r[2] for r in rows), 3)
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows}
    assert shard_digests(docs.limit(0)).collect() == []
    placed = interleave(docs, "source", 3)
    assert placed.columns == ["doc_id", "text", "source", "shard", "slot"]
    write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.select(*placed.columns).collect())) == sorted(map(repr, placed.collect()))


def test_long_tail_of_small_sources(spark):
    """One-row and two-row sources lie evenly over shards, and so do the large ones."""
    sources = ["big"] * 4000 + ["mid"] * 2000 + [f"one{i}" for i in range(3000)] + [f"two{i // 2}" for i in range(1000)]
    df = spark.createDataFrame(list(enumerate(sources)), "doc_id long, source string")
    rows = interleave(df, "source", 8, bucket_rows=500).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(sources)))
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for kind, n in (("big", 4000), ("mid", 2000), ("one", 3000), ("two", 1000)):
        for shard in range(8):
            share = sum(r.source.startswith(kind) for r in rows if r.shard == shard)
            assert abs(share - n / 8) <= 0.25 * n / 8, (kind, shard, share)
    half = sorted((r.slot, r.source) for r in rows if r.shard == 3)
    first = sum(s.startswith("one") for _, s in half[: len(half) // 2])
    assert 0.35 <= first / sum(s.startswith("one") for _, s in half) <= 0.65
