from cases import docs
from stockflow.llm import near_dedup
from test_near_dedup import family, shingles


def least_ids(texts, percent):
    """The least row of each component, by every pair of rows."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {find(i) for i in range(len(sets))}


def test_other_thresholds_against_all_pairs(spark):
    texts = family(11, 120, 30, 4) + family(12, 200, 25, 8) + family(13, 60, 30, 2)
    assert least_ids(texts, 80) < least_ids(texts, 85)
    df = docs(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    for percent in (80, 85):
        assert {r.doc_id for r in near_dedup.representatives(df, percent=percent).collect()} == least_ids(texts, percent)
