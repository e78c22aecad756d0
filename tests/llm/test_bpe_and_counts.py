import base64

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from cases import docs, empty, odd_rows, random_texts
from stockflow.llm import bpe, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows():
    return odd_rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(random_texts(60))]


def test_encode_equals_library_and_round_trips(spark, library):
    df = docs(spark, rows()).withColumnRenamed("source", "IDS")  # clashes with the added column
    coded = bpe.encode(df, RANKS, P.PATTERN)
    assert coded.columns == ["doc_id", "text", "lang", "n_chars", "ids"]
    back = bpe.decode(coded, RANKS, P.PATTERN).collect()
    assert len(back) == df.count()
    for r in back:
        assert list(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_matrix_and_heap_agree_on_every_character(library):
    own = bpe.ByteBpe.from_file(open(RANKS, "rb").read(), P.PATTERN)
    chars = [chr(i) for i in range(0x3000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f" x{c}x 1{c}1 .{c}. {c}" for c in chars[k: k + 48]) for k in range(0, len(chars), 48)]
    flat, off = own.encode(texts)
    for i, t in enumerate(texts):
        assert flat[off[i]: off[i + 1]].tolist() == library.encode_ordinary(t)
    for part in (b"ab" * 40, b"xxxxx", b"hello", bytes(range(256))):
        known = own.ranks.get(part)
        flat, _ = own.merge([part])
        assert flat.tolist() == ([known] if known is not None else own._heap(part).tolist())


def test_counts_equal_library(spark):
    tk = Tokenizer.from_file(JSON)
    df = docs(spark, rows()).withColumnRenamed("source", "N_tokens")
    got = token_counts.count_tokens(df, JSON, P.PATTERN).collect()
    assert len(got) == len(rows())
    for r in got:
        assert r.n_tokens == len(tk.encode(r.text or "", add_special_tokens=False).ids), r.text


def test_overlapping_pairs_and_unordered_merges():
    own = token_counts.RankMerger(open(JSON, "rb").read(), P.PATTERN)
    parts = [b"a" * n for n in range(1, 40)] + [b"." * n for n in range(1, 70)] + [b"-=" * 9, b""]
    assert own.ordered
    fast = own.survivors(parts).tolist()
    own.ordered = False
    assert own.survivors(parts).tolist() == fast
    tk = Tokenizer.from_file(JSON)
    assert fast == [len(tk.encode(p.decode(), add_special_tokens=False).ids) for p in parts]


def test_empty_tables(spark):
    assert bpe.decode(bpe.encode(empty(spark), RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0
    assert token_counts.count_tokens(empty(spark), JSON, P.PATTERN).count() == 0
