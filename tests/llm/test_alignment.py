import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cases import docs, empty, odd_rows, random_texts
from stockflow.llm import alignment, queries
from stockflow.llm.token_counts import byte_alphabet

JSON, MODEL = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
MORE = ["say ▁ mark", "tail ", " lead", "  two", "a▁b", "nul\x00byte", "end\n", "\n", "<s> </s> <unk> <0x41>", "ﬁ ligature ½ Å",
        "<|endoftext|>", "the the the the", "naïve café 漢字かな交じり", "é combining", "tab\tand　wide"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    of = {c: bytes([i]) for i, c in enumerate(byte_alphabet())}
    names = {i: b"".join(of.get(c, c.encode()) for c in t) for t, i in a.get_vocab().items()}
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, names, piece


def brute(texts, libraries):
    """The contract, token by token."""
    a, b, name_a, name_b = libraries
    rows, links = [], Counter()
    for t in texts:
        ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        x, y = [name_a[i] for i in ids_a], [name_b(i) for i in ids_b]
        if not t or b"".join(x) != (" " + t).encode() or b"".join(y) != (" " + t).encode():
            rows.append(([], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(i) for i in x]).tolist(), np.cumsum([len(i) for i in y]).tolist()
        own, groups, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
            i, j = p, q
        own = [(ids_a[p], ids_b[q]) for p, e in enumerate(ends_a) for q, f in enumerate(ends_b) if e == f]
        links.update(own)
        rows.append((ids_a, ids_b, groups, own))
    top = {}
    for (_, q), n in links.items():
        top[q] = max(top.get(q, 0), n)
    return [(len(a), len(b), len(g), len(own), sum(links[x] == top[x[1]] for x in own), sum(links[x] for x in own),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for a, b, g, own in rows]


def rows():
    texts = MORE + random_texts(80)
    return odd_rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(texts + texts[:20])]


def test_query_against_brute_force(spark, libraries, tmp_path):
    docs(spark, rows()).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_token_alignment(spark, str(tmp_path)).collect()
    want = [(r[0], *x) for r, x in zip(rows(), brute([r[1] for r in rows()], libraries))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    none = [r for r in got if not r.n_a]
    assert 4 < len(none) < len(got) / 2 and all(r.groups_sha256 == "" and not r.count_sum for r in none)
    assert any(0 < r.n_best < r.n_links for r in got)


def test_operator_over_many_blocks(spark, libraries, monkeypatch):
    monkeypatch.setattr("stockflow.llm.arrays.CHUNK_BYTES", 200)
    df = docs(spark, rows()).withColumnRenamed("source", "PAIR").withColumnRenamed("lang", "block").withColumnRenamed("n_chars", "groups")
    got = alignment.alignment(df.repartition(5), JSON, MODEL, P.PATTERN).collect()
    want = Counter((r[0], *x[:6]) for r, x in zip(rows(), brute([r[1] for r in rows()], libraries)))
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) for r in got) == want
    some = next(r for r in got if r.text == "the the the the")
    assert some.groups.count(";") == some.n_groups - 1 and some.block == "en"


def test_shared_ends_of_unlike_cuts():
    a, b = alignment.shared_ends(np.array([2, 3, 7, 9]), np.array([1, 3, 4, 5, 9]))
    assert a.tolist() == [1, 3] and b.tolist() == [1, 4]
    assert alignment.shared_ends(np.zeros(0, np.int64), np.array([4]))[0].tolist() == []


def test_text_over_a_chunk(spark, libraries):
    text = " ".join(random_texts(2200, seed=4, words=(100, 120))) + "z" * 3000
    assert len(text) > 1 << 20
    [got] = alignment.alignment(docs(spark, [(1, text, None, None, None)]), JSON, MODEL, P.PATTERN).collect()
    a, b, _, _ = libraries
    assert got.n_a == len(a.encode(" " + text, add_special_tokens=False).ids) and got.n_b == len(b.encode(text))
    assert got.n_links == got.n_groups == got.groups.count("|") and got.count_sum >= got.n_links


def test_empty_table(spark):
    assert alignment.alignment(empty(spark), JSON, MODEL, P.PATTERN).count() == 0
