"""Operators 2, 3 and 10 against the tokenizers library, and their parts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from samples import prose

P = pytest.importorskip("public_tokenizers")
WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


def library_ids(path, text):
    from tokenizers import Tokenizer
    tok = library_ids.known.setdefault(path, Tokenizer.from_file(path))
    return tok.encode(text or "", add_special_tokens=False).ids


library_ids.known = {}


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_codec_is_the_library(path):
    from clickweave.llm.tokens import Codec
    r = random.Random(5)
    alphabet = list("abcXYZ 012'\n\t.,!?-_<|>") + ["é", "É", "ß", " ", " ", " ", "\x1d", "中", "😀", "é", "İ", "ſ", "'ll", "'S", "<|endoftext|>"]
    c = Codec(path, memo=50)
    for _ in range(600):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        assert np.frombuffer(c.encode(text), "<u4").tolist() == library_ids(path, text), repr(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_codec_holds_a_word_once(path):
    from clickweave.llm.tokens import Codec
    r = random.Random(6)
    words = sorted({"".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(300)})
    c = Codec(path, memo=1000)
    text = "\n".join(" " + w for w in words)
    for _ in range(2):
        assert np.frombuffer(c.encode(text), "<u4").tolist() == library_ids(path, text)
    spaced = "".join(" " + w for w in words)
    c = Codec(path, memo=1000)
    assert np.frombuffer(c.encode(spaced), "<u4").tolist() == library_ids(path, spaced)
    assert sum(len(x) + len(x.old) for x in vars(c).values() if hasattr(x, "old")) == len(words)


def test_token_counts(docs, empty, clashing):
    from clickweave.llm import token_counts
    for table in (docs, clashing):
        got = sorted(map(tuple, token_counts.count(table.select("doc_id", "text"), WORD, limit=100, frequent=50).collect()), key=str)
        want = []
        for r in docs.collect():
            n = len(library_ids(WORD, r.text))
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 100))
        assert got == sorted(want, key=str)
    assert token_counts.count(empty, WORD).count() == 0


def test_rans_round_trip(docs, empty):
    from clickweave.llm import rans
    got = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in rans.round_trip(docs, WORD, 1).collect()]
    texts = sorted(((r.doc_id, library_ids(WORD, r.text) + [1]) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [g[0] for g in sorted(got, key=lambda g: g[1])] == [t[0] for t in texts]
    start = 0
    for g in sorted(got, key=lambda g: g[1]):
        assert g[1] == start
        start += g[2]
    want = sorted((t[0] or -1, len(t[1]), zlib.crc32(np.array(t[1], "<u4").tobytes())) for t in texts)
    assert sorted((g[0] or -1, g[2], g[3]) for g in got) == want
    assert rans.round_trip(empty, WORD, 1).count() == 0


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 5000, 200_000])
def test_rans_blocks(n):
    from clickweave.llm import rans
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.uint32)
    freq = rans.scaled(np.bincount(ids, minlength=49_408).astype(np.int64))
    assert freq.sum() == 1 << rans.SCALE and (freq[np.unique(ids)] > 0).all()
    block = rans.encode_block(ids, rans.Table(freq))
    assert (rans.decode_block(block, rans.Table(freq)) == ids).all()
    marks = rans._HEAD.unpack_from(block)[4]
    parts = [rans.decode_block(block, rans.Table(freq), k) for k in range(marks)]
    assert (np.concatenate(parts) == ids).all()
    if n > 100:
        spoilt = bytearray(block)
        spoilt[len(block) // 2] ^= 1
        with pytest.raises(ValueError):
            rans.decode_block(bytes(spoilt), rans.Table(freq))


def test_bpe_chunks(docs, empty, clashing, spark, monkeypatch):
    from clickweave.llm import bpe_chunks
    for table in (docs, clashing):
        got = bpe_chunks.encode(table, BYTE, ["doc_id"], lambda ids, text: bpe_chunks.digests(ids, BYTE),
                                "n_tokens long, ids_sha256 string, decoded_sha256 string")
        want = []
        for r in docs.collect():
            ids = library_ids(BYTE, r.text)
            want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert bpe_chunks.encode(empty, BYTE, ["doc_id"]).count() == 0


def test_chunks_follow_the_content():
    from clickweave.llm.bpe_chunks import cuts
    shared = prose(1, 3000)
    one, two = (np.frombuffer((prose(k, 50 + k) + " " + shared).encode(), np.uint8) for k in (2, 3))
    def parts(raw):
        ends = cuts(raw)
        return {raw[a:b].tobytes() for a, b in zip([0, *ends], ends)}
    a, b = parts(one), parts(two)
    assert len(a & b) > 0.6 * len(a)
    assert b"".join(sorted(parts(one), key=lambda p: one.tobytes().index(p))) == one.tobytes()


def test_unsafe_joints_are_repaired():
    from clickweave.llm import bpe_chunks
    from clickweave.llm.tokens import codec
    r = random.Random(2)
    for _ in range(150):
        text = "".join(r.choice(["ab", "the", "é", "中", "1", ".", " ", "  ", "\n", "<|endoftext|>", "'ll"]) for _ in range(r.randint(2, 120)))
        chars = sorted(r.sample(range(1, len(text)), min(len(text) - 1, r.randint(1, 6))))
        parts = [p.encode() for p in (text[a:b] for a, b in zip([0, *chars], [*chars, len(text)]))]
        ids = [codec(BYTE).encode(p.decode()) for p in parts]
        assert np.frombuffer(bpe_chunks.repair(BYTE, parts, ids), "<u4").tolist() == library_ids(BYTE, text), repr(text)
