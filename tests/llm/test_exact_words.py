"""Different words that any polynomial hash modulo 2 ** 64 takes for one, and texts over 1 MiB."""

import base64
import hashlib

import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from cases import docs, random_texts
from stockflow.llm import bpe, lm_scoring, near_dedup, packing, quality_rules, token_counts
from stockflow.llm.arrays import Spans, span_codes, span_digests, text_bytes, words
from stockflow.llm.pieces import SpaceCache
from stockflow.llm.shingles import shingle_sets

RANKS, RANKS50, JSON, MODEL = (P.path(x) for x in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def thue_morse(n, flip, letters="ab"):
    return "".join(letters[(i.bit_count() & 1) ^ flip] for i in range(n))


TWINS = [(thue_morse(n, 0), thue_morse(n, 1)) for n in (1024, 2048, 4096, 8192)]
TEXTS = [" ".join(pair) for pair in TWINS] + [f"{b} {a} {b}" for a, b in TWINS] + ["\n".join([a, b, a]) for a, b in TWINS]
LONG = " ".join(random_texts(2400, seed=21, words=(100, 130))) + " " + "y" * 70_000


@pytest.fixture(scope="module")
def texts():
    assert len(LONG) > 1 << 20
    return [*TEXTS, LONG]


def test_the_words_do_collide():
    col = pa.array([a + " " + b for a, b in TWINS])
    data, off = text_bytes(col)
    s, e, _ = words(data, off)
    h = Spans(data).hash(s, e)
    assert (h[::2] == h[1::2]).any()
    code, names = span_codes(data, s, e)
    assert len(names) == len(set(code.tolist())) == len(set(span_digests(data, s, e).tolist())) == 8


def test_byte_bpe(spark, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = docs(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]).coalesce(1)
    got = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    for r in got:
        assert bytes(r.decoded) == r.text.encode()
        assert list(r.ids) == library.encode_ordinary(r.text)


def test_counts_and_pieces(spark, texts):
    tk = Tokenizer.from_file(JSON)
    want = [tk.encode(t, add_special_tokens=False).ids for t in texts]
    df = docs(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]).coalesce(1)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, JSON, P.PATTERN).collect()}
    assert got == {i: len(w) for i, w in enumerate(want)}
    own = {}
    for r in packing.pieces(df, JSON, P.PATTERN, 2048, carry=["doc_id"]).collect():
        own.setdefault(r.doc_id, []).append((r.piece, bytes(r.ids)))
    for i, w in enumerate(want):
        ids = b"".join(x.to_bytes(4, "little") for x in [*w, 0])
        assert hashlib.sha256(b"".join(b for _, b in sorted(own[i]))).digest() == hashlib.sha256(ids).digest()


def test_sentencepiece(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    flat, off = SpaceCache(library).ids(pa.array(texts))
    for i, t in enumerate(texts):
        assert flat[off[i]: off[i + 1]].tolist() == library.encode(t)


def test_sets_and_links(spark):
    a, b = TWINS[1]
    rest = " one two three four five six seven eight nine"
    rows = [(1, a + rest, None, None, None), (2, b + rest, None, None, None), (3, a, None, None, None), (4, b, None, None, None), (5, a + rest, None, None, None)]
    flat, off = shingle_sets(pa.array([r[1] for r in rows]))
    sets = [frozenset(flat[x:y].tolist()) for x, y in zip(off, off[1:])]
    assert len(sets[0] ^ sets[1]) == 2 and not sets[2] & sets[3] and sets[0] == sets[4]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_lines_and_windows():
    a, b = TWINS[2]
    data, off = text_bytes(pa.array(["\n".join([a, b, a, b]), f"{a} x y {b} x y", f"{a} x y {a} x y"]))
    got = quality_rules.base_counts(data, off)
    assert got["n_dup_lines"].tolist() == [2, 0, 0] and got["n_repeat_words"].tolist() == [0, 0, 6]


def test_word_counts(spark, texts):
    import math
    from collections import Counter
    df = docs(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    m = lm_scoring.fit(df.where("doc_id < 6"), RANKS50, P.PATTERN)
    c = Counter(w for t in texts[:6] for w in [*t.split(), "<end>"])
    total, v = sum(c.values()), len(c)
    for r in lm_scoring.score(df, m, RANKS50, P.PATTERN).collect():
        own = [*r.text.lower().split(), "<end>"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), total)
        want = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (v + 1))) for w in own)
        assert abs(r.base_score - want) < 1e-6 * abs(want)


def test_scores_are_the_same_when_run_again(spark, tmp_path):
    docs(spark, [(i, t, "en", "s", 1) for i, t in enumerate(random_texts(300, seed=5))]).repartition(3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def once():
        m = lm_scoring.fit(df.where("doc_id % 5 <> 1"), RANKS50, P.PATTERN)
        return sorted((r.doc_id, r.score) for r in lm_scoring.score(df, m, RANKS50, P.PATTERN).collect())

    assert once() == once()
