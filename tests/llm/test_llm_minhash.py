import random
import re

import numpy as np
import pytest
from llm_fixtures import cancelling_pair, prose, rows, table

from tripfold.llm import components, minhash_dedup
from tripfold.llm import shingles as sh


def word_set(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(data):
    sets = [word_set(t) for _, t, *_ in data]
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, row in enumerate(data):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(data)), key=str)


@pytest.mark.parametrize("rounds, rows_a_task", [(0, 500), (2, 500), (0, 3), (2, 3)])
def test_components(spark, monkeypatch, rounds, rows_a_task):
    """Without leader rounds, the pairwise pass alone must find every link; also where bands are split over tasks."""
    monkeypatch.setattr(minhash_dedup, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(minhash_dedup, "BAND_ROWS", rows_a_task)
    rng = random.Random(4)
    chain = prose(5, 200).split(" ")
    drift = []
    for i in range(40):  # each near the one before, the ends far apart
        chain = list(chain)
        for _ in range(3):
            chain[rng.randrange(len(chain))] = f"drift{i}"
        drift.append((1000 + i, " ".join(chain), None, None, 0, "", "", 0))
    data = rows() + drift + [(5000 + i, "Of the same Five words here", None, None, 0, "", "", 0) for i in range(50)]
    found = minhash_dedup.near_duplicates(table(spark, data)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(data)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.parametrize("letters", [1024, 4096])
def test_words_whose_hashes_are_built_to_agree(spark, letters):
    texts = [f"{word} of the same kind here" for word in cancelling_pair(letters)]
    found = minhash_dedup.near_duplicates(table(spark, [(i, t, "en", "a", 0, "", "", 0) for i, t in enumerate(texts)]))
    assert sorted(r.component_id for r in found.collect()) == [0, 1]


def test_keep_one_keeps_columns_and_one_row(spark):
    data = rows()
    docs = table(spark, data)
    kept = minhash_dedup.keep_one(docs)
    assert kept.schema == docs.schema
    expected = {i for i, _, least in brute(data) if i == least}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i in expected if i is not None)
    assert minhash_dedup.keep_one(docs.limit(0)).count() == 0


def test_keep_one_keeps_one_row_of_a_component_whatever_the_ids(spark):
    def copies(seed, ids):  # one word more at the end each: near copies with different texts
        text = prose(seed, 300)
        return [(i, text + " more" * n, "en", "a", 5, "n", "k", 9) for n, i in enumerate(ids)]

    empty = [(i, t, "en", "b", 5, "n", "k", 9) for i in (None, 7) for t in (None, "", "", " \n\t")]
    data = copies(31, [None] * 4) + copies(32, [50] * 4) + copies(33, [None, 61, 60, 60]) + copies(34, [70]) * 3 + empty
    found = minhash_dedup.keep_one(table(spark, data)).collect()
    assert sorted(str(r.doc_id) for r in found if r.source == "a") == ["50", "60", "70", "None"]
    assert sorted(str((r.doc_id, r.text)) for r in found if r.source == "b") == sorted(str(r[:2]) for r in empty)
    starts = {r.text[:40] for r in found if r.source == "a"}
    assert starts == {prose(seed, 300)[:40] for seed in (31, 32, 33, 34)}


def test_word_hashes_of_a_long_text_and_a_group_agree():
    text = prose(3, 400_000).encode()
    assert len(text) > 2 * sh.GROUP_BYTES
    (whole,) = sh.word_hashes([text])
    head = next(iter(sh.word_hashes([text[: 1 << 18], b"", b" \n"])))
    assert len(whole) == len(text.split()) and (whole[: len(head) - 1] == head[:-1]).all()


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for similarity in (0.75, 0.9, 0.97):
        n = 2000
        both = round(2 * n * similarity / (1 + similarity))
        errors = []
        for _ in range(20):
            pool = rng.integers(0, 2**63, 2 * n - both).astype(np.uint64)
            a, b = (sh.odd_sketch(sh.samples(x)) for x in (pool[:n], pool[n - both :]))
            bits = sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))
            assert bits <= minhash_dedup.MOST_UNLIKE
            errors.append(sh.estimated_similarity(bits) - similarity)
        assert abs(np.mean(errors)) < 0.03


def test_connected_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    pairs += [(500, 1000 + i) for i in range(300)] + [(2000 + i, 2001 + i) for i in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    found = components.connect(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {x: find(x) for x in parent if find(x) != x}
    assert components.connect(spark.createDataFrame([], "a long, b long")).count() == 0
