"""Large numbers, long texts without spaces, long documents, empty stages."""

import random
import time

import numpy as np
import pytest
from samples import SCHEMA, prose
from pyspark.sql import functions as F


def test_scores_of_any_size_are_exact():
    from clickweave.llm.topk import Lists
    r = random.Random(1)
    for scale in (1 << 20, 1 << 33, 1 << 45):
        rows = [[r.randrange(-scale, scale) for _ in range(3)] for _ in range(200)]
        lists = Lists(np.array(rows, np.int64), [[i] for i in range(200)])
        q = [r.randrange(-scale, scale) for _ in range(3)]
        found, _ = lists.search(np.array(q, np.int64), -1, 5, -(1 << 200))
        want = sorted(((sum(a * b for a, b in zip(q, v)), -i) for i, v in enumerate(rows)), reverse=True)[:5]
        assert found == [(s, -i) for s, i in want]


def test_scores_beyond_64_bits_are_an_error(spark):
    from clickweave.llm import topk
    def run(x):
        table = spark.createDataFrame([(i, [x, float(i)]) for i in range(60)], "vec_id long, embedding array<double>")
        return topk.search(table, table.where("vec_id % 50 = 0"), 3).collect()
    assert len(run(1e6)) == 6
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in run(4e6)}  # past 2^53, exact
    assert got[0, 1] == (1, (256 * 4 * 10**6) ** 2) and got[50, 1] == (59, (256 * 4 * 10**6) ** 2 + 256 * 59 * 256 * 50)
    for x in (1e10, 1e18, 1e300):
        with pytest.raises(Exception, match="fit"):
            run(x)


def test_joints_without_spaces_are_repaired_in_linear_time():
    import public_tokenizers
    from clickweave.llm import bpe_chunks
    from clickweave.llm.tokens import library
    path = public_tokenizers.path("byte_bpe_50k.json")
    c = bpe_chunks.codec(path)
    r = random.Random(5)
    for space in (0.0, 0.02):
        text = "".join(" " if r.random() < space else r.choice("abcdefghij,.é") for _ in range(400_000))
        at = sorted(r.sample(range(1, len(text)), 300))
        parts = [text[a:b].encode() for a, b in zip([0, *at], [*at, len(text)])]
        t = time.perf_counter()
        whole = np.array(library(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        once = time.perf_counter() - t
        ids = [c.encode(p.decode()) for p in parts]
        t = time.perf_counter()
        assert bpe_chunks.repair(path, parts, ids) == whole
        assert time.perf_counter() - t < 3 * once + 1


def test_long_documents_are_decoded_by_checkpoint(spark, monkeypatch):
    import public_tokenizers
    import zlib
    from clickweave.llm import rans
    from clickweave.llm.tokens import library
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [(1, "a b"), (2, None), (3, prose(3, 150_000)), (4, "tail"), (None, prose(5, 50)), (9, prose(9, 40_000)), (10, "")]
    table = spark.createDataFrame(texts, "doc_id long, text string").withColumn("ids", F.lit(0)).withColumn("file", F.lit("x"))
    want, start = [], 0
    for d, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = library(path).encode(t or "", add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    for whole in (rans.WHOLE, 1000):
        monkeypatch.setattr(rans, "WHOLE", whole)
        got = rans.round_trip(table, path, 1).select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_toxicity_scores_equal_a_plain_loop(spark):
    """The scorer against n-gram by n-gram sums in plain Python."""
    import pyarrow as pa
    from clickweave.llm import toxicity as T
    rng = np.random.default_rng(2)
    margin, bias = rng.normal(0, 1, T.BUCKETS).astype(np.float32), 0.3
    texts = ["Stupid, STUPID day (no \"joke\")", "", None, "  ", "ÀÉ é ß x", "a" * 40, " ".join(f"w{k % 7}x{k}" for k in range(90)), "one"]
    words = T.Words(*T.utf8(pa.array(texts, pa.string())))
    buckets = {n: (b, f) for n, (b, f) in zip(T.GRAMS, words.grams())}
    hashes = words.hashes()
    got = T.scores(pa.array(texts, pa.string()), margin, bias)
    for r in range(len(texts)):
        x = []
        for w in range(words.first[r], words.first[r + 1]):
            at, size = words.at[w], words.size[w]
            picked = [margin[int(hashes[w] % np.uint64(T.BUCKETS))]]
            for n in T.GRAMS:
                picked += [margin[buckets[n][0][at + i]] for i in range(max(0, size - n + 1))]
            x.append(sum(map(float, picked)) / len(picked))
        top = max((sum(x[i:i + T.WINDOW]) / T.WINDOW for i in range(len(x) - T.WINDOW + 1)), default=sum(x) / len(x) if x else 0.0) if len(x) > T.WINDOW else (sum(x) / len(x) if x else 0.0)
        assert got[r] == pytest.approx(1 / (1 + np.exp(-(top + bias))), abs=1e-4)


def test_toxicity_training_takes_little_of_the_driver():
    """A sample of many distinct words: memory follows pieces and the n-grams kept."""
    import tracemalloc
    from clickweave.llm import toxicity as T
    r = random.Random(3)
    parts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(300)]
    texts = [" ".join(r.choice(parts) + r.choice(parts) + ("" if k % 3 else "zap") for _ in range(300)) for k in range(600)]
    tracemalloc.start()
    model = T.train(texts, [int(k % 3 == 0) for k in range(600)], rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model is not None and peak < 60 * sum(map(len, texts))


def test_toxicity_training_is_the_same_in_any_pieces(monkeypatch):
    from clickweave.llm import toxicity as T
    r = random.Random(4)
    texts = [None, "", "  "] + [" ".join(r.choice(["bad", "ugly"] if k % 2 and r.random() < 0.3 else ["fine", "day", f"Word{r.randrange(400)}"]) for _ in range(80)) for k in range(120)]
    labels = [0] * 3 + [k % 2 for k in range(120)]
    whole = T.train(texts, labels)
    monkeypatch.setattr(T, "SAMPLE_PIECE", 300)
    monkeypatch.setattr(T, "SAMPLE_WORDS", 7)
    cut = T.train(texts, labels)
    assert whole[1] == cut[1] and (whole[0] == cut[0]).all() and whole[0].any()
    assert T.train([None, "", " . "], [0, 1, 1]) is None and T.train(["a b", "c"], [1, 1]) is None and T.train([], []) is None


def test_stages_on_empty_and_repeated_tables(spark, tmp_path):
    """Every stage on an empty table, nulls, repeated ids and clashing columns."""
    import corpus_pipeline
    sf = str(tmp_path)
    spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    rows = [(1, prose(1, 70), "en", "a", 5), (1, prose(2, 70), "en", "a", 5), (2, prose(1, 70), "en", None, None), (2, prose(1, 70), "en", None, None),
            (None, None, None, None, None), (3, "", "de", "b", 0), (4, prose(3, 60) + " " + prose(1, 70), "en", "b", 1), (None, prose(6, 20), "en", "a", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    clash = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(("_j_id", "_s_doc", "copies", "label", "n", "first", "ids"))])
    for table in (docs, clash, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, sf)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == table.columns, name
            assert out.count() <= 3 * table.count(), name
