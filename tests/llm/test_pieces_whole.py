import numpy as np
import public_tokenizers as P
import pyarrow as pa
import sentencepiece

from cases import ODD, random_texts
from stockflow.llm import quality_rules as qr
from stockflow.llm.pieces import SpaceCache
from conftest import SF0001

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def texts():
    import pyarrow.parquet as pq

    lines = "\n".join("one two three four five six seven eight nine" for _ in range(30))
    more = [lines, lines + "\n", "\n" + lines, "a\n\n\nb", "a \nb", "a\n b", "a  b   c    d", "x\ty", "say \u201chello\u201d \u2013 \u304b\u306a", "a\u2581b \u2581 c",
            "\u2581", "tail \n ", "\n", " \n", "a\x00b", "\n\u304b\n \u304b"]
    return ODD + more + random_texts(200, 7) + pq.read_table(f"{SF0001}/documents.parquet")["text"].to_pylist()


def test_cached_pieces_equal_the_library_on_whole_texts():
    cache, rows = SpaceCache(LIBRARY), texts()
    assert cache.separable
    for _ in range(2):  # the second time from the cache
        flat, off = cache.ids(pa.array(rows, pa.string()))
        for i, t in enumerate(rows):
            assert flat[off[i]: off[i + 1]].tolist() == LIBRARY.encode((t or "").strip(" ")), repr(t)


def test_newlines_count_whatever_the_last_character(spark):
    rows = ["\n".join("one two three four five six seven eight nine" for _ in range(30)) + end for end in ("", "\n")]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in qr.measure(df, P.path("piece_bpe_32k.model"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()}
    for i, t in enumerate(rows):
        ids = LIBRARY.encode(t)
        assert abs(got[i].fallback_share - np.mean([LIBRARY.is_byte(k) for k in ids])) < 1e-9
        assert abs(got[i].chars_per_piece - len(t) / len(ids)) < 1e-9
