import hashlib
import random
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from veritrail.llm.bpe import FastBpe, bpe_round_trip, load  # noqa: E402
from veritrail.llm.packing import binary_lengths, pack, pieces  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CASES = [
    "", " ", "\n", "a", "  a", "a  b", "a \n b", "\n\n\na b\n", "it's we'LL they'd 've", "x\x1cy \x1f z\x00\x00 q", "\x85\xa0  end　　x", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b <|endof",
    "éèê ñandú ÄÖÜß 12345 ٣٤ ²½ Ⅷ", "日本語 テキスト 😀😀 👩‍👩‍👧", "a" * 3000, "ab" * 700 + "###" * 50, "tab\tsep\r\nline", "The quick brown fox. " * 30, "\0", " \0a", "a \0 b", "\U0003d000's", "\u0558's \ua7ce1", "\U00012550 2\U00011de0",
]


def ids(b):
    return np.frombuffer(b, dtype="<u4").tolist()


@pytest.mark.parametrize("kind", ["own", "fast"])
def test_ids_equal_the_librarys(kind):
    bpe = load(PATH) if kind == "own" else load(PATH, FastBpe)
    for text in CASES:
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        assert ids(bpe.encode(text)) == want, text
        assert ids(bpe.encode(text)) == want, text  # from the memo
        assert bpe.decode(bpe.encode(text)) == LIBRARY.decode(want, skip_special_tokens=False) == text


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "\n", "  ", "'s", "1", "é", "<|endoftext|>", "\t", "the", " ", "\x1d"]), st.text(max_size=8)), max_size=12).map("".join))
def test_any_text(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids(load(PATH).encode(text)) == want
    assert ids(load(PATH, FastBpe).encode(text)) == want


def test_each_token_encodes_to_itself_and_pairs_agree():
    bpe, rng = load(PATH), random.Random(5)
    assert len(bpe.bytes_of) > 50_000
    for token, b in bpe.bytes_of.items():
        assert bpe.piece(b) == [token]
    for code in rng.sample(range(sys.maxunicode), 4000):
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b {chr(code)}1"
            assert ids(bpe.encode(text)) == LIBRARY.encode(text, add_special_tokens=False).ids, hex(code)


def test_decode_of_any_ids():
    rng, bpe = random.Random(6), load(PATH)
    for _ in range(200):
        some = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert bpe.decode(np.array(some, dtype="<u4").tobytes()) == LIBRARY.decode(some, skip_special_tokens=False)


def test_round_trip_frame(spark):
    rows = [(i, t, "x") for i, t in enumerate(CASES)] + [(None, None, "x"), (0, "", None), (0, "", None)]
    got = bpe_round_trip(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH).collect()
    assert len(got) == len(rows)
    want = sorted(((i is not None, i or 0), hashlib.sha256((t or "").encode()).hexdigest(), LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), hashlib.sha256(r.decoded.encode()).hexdigest(), ids(r.ids)) for r in got) == want
    assert bpe_round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_binary_lengths():
    assert binary_lengths(5000, 2048) == [2048, 2048, 512, 256, 128, 8]
    for n in range(1, 300):
        assert sum(binary_lengths(n, 64)) == n


def test_pack_holds_every_id_once(spark):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(None, None), (3, "a"), (3, "a")]
    got = pack(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int"), PATH, max_tokens=64).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and all(r.offset == 0 and r.length & (r.length - 1) == 0 for r in got)
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    total = 0
    for i, t in rows:
        want = LIBRARY.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted({(r.start, r.length, r.ids) for r in by_doc[i, len(want)]})
        assert [x for _, _, b in own for x in ids(b)] == want and own[0][0] == 0
        total += len(want)
    assert sum(r.length for r in got) == total
    buckets = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert buckets == sorted(buckets)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pieces(empty, PATH).count() == 0 == pack(empty, PATH).count()
    with pytest.raises(ValueError):
        pack(empty.withColumnRenamed("doc_id", "start"), PATH, id_col="start")
