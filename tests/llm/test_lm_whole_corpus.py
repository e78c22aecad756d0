from collections import Counter

import numpy as np
import public_tokenizers as P

from cases import docs, empty
from stockflow.llm import attention as at
from stockflow.llm import lm_scoring as lm
from stockflow.llm.arrays import broadcast_file
from stockflow.llm.bpe import model

PATH = P.path("byte_bpe_50k.tiktoken")
TEXTS = ["The cat sat.\nThe cat ran.", "Paris is in France\n\nParis", "", None, "the end", "Paris"]


def test_counts_come_from_the_texts_as_they_stand(spark):
    shared = broadcast_file(spark, PATH)
    own = model(shared, P.PATTERN)
    encoded = lm._encoded(docs(spark, [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)]), "doc_id", "text", shared, P.PATTERN)
    c, counts = lm._classes(encoded, len(TEXTS), shared, P.PATTERN)
    flat, off = own.encode([t or "" for t in TEXTS])
    assert off[-1] > 10 and encoded.count() == len(TEXTS)
    end = len(own.token_off) - 1
    want = Counter(flat.tolist()) + Counter({end: len(TEXTS)})
    assert {i: n for i, n in enumerate(counts.tolist()) if n} == want
    pairs = Counter()
    for a, b in zip(off, off[1:]):
        last = at.INPUTS
        for i in [*flat[a:b].tolist(), end]:
            pairs[last, i] += 1
            last = int(c.inputs[i])
    keys = np.array(list(pairs))
    plain = at.classes(counts, [own.token_bytes[a:b].tobytes() for a, b in zip(own.token_off, own.token_off[1:])] + [b""])
    again = at.given_last(plain, keys[:, 0], keys[:, 1], np.array(list(pairs.values())))
    assert np.allclose(c.log_share, again.log_share)


def test_every_training_text_trains_once(spark):
    df = docs(spark, [(i if i % 4 else None, f"text {i} of the corpus", "en", "s", 1) for i in range(40)])
    shared = broadcast_file(spark, PATH)
    encoded = lm._encoded(df, "doc_id", "text", shared, P.PATTERN)
    c, counts = lm._classes(encoded, 40, shared, P.PATTERN)
    start = at.pack(at.initial(c, counts))
    # with one text at a time, the weights move: none is left out by the share or between the rounds
    for i in (1, 2, 3, 5, 6, 7):
        one = lm._encoded(df.where(f"doc_id = {i}"), "doc_id", "text", shared, P.PATTERN)
        assert not np.array_equal(at.pack(lm._train(one, c, counts, lm.Settings())), start)
    none = lm._encoded(empty(spark), "doc_id", "text", shared, P.PATTERN)
    assert np.array_equal(at.pack(lm._train(none, c, counts, lm.Settings())), start)
