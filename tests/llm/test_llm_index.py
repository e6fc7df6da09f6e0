import hashlib
import random
import re

import pytest
from llm_fixtures import ODD_TEXTS, prose, rows, table

from tripfold.llm import position_index as pi

ITEM_SCHEMA = "item_id long, text string, phrase string, doc_key long, n int"


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window):
    out = []
    wanted = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    sizes = {len(k) for k in wanted}
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def items_of(data):
    """Passages of the documents in other letters, short items, one under two ids and one twice, and odd ones."""
    rng = random.Random(6)
    items = [(None, " ".join(words(data[40][1])[:12])), (7, "one"), (7, "two words"), (8, "Two, WORDS"), (9, "never written anywhere"), (10, "x" * 9000)]
    for i, (_, text, *_) in enumerate(data):
        w = words(text)
        if len(w) > 30 and i % 3 == 0:
            at = rng.randrange(len(w) - 20)
            items.append((100 + i, " - ".join(w[at : at + 20]).upper() if i % 2 else "odd lead " + " ".join(w[at : at + 15])))
    items += [items[-1], (5, items[-1][1])]
    return items + [(2000 + i, t) for i, t in enumerate(ODD_TEXTS)]


@pytest.mark.parametrize("segment, piece", [(1 << 20, 1 << 20), (100, 64), (7, 32)])
def test_contamination_equals_brute_force(spark, monkeypatch, segment, piece):
    """Also with documents that go on over many segments, read in many pieces."""
    monkeypatch.setattr(pi, "SEGMENT_WORDS", segment)
    monkeypatch.setattr(pi, "PIECE_BYTES", piece)
    data = [r for r in rows() if segment > 7 or len(words(r[1])) < 1000]
    items = items_of(data)
    bench = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in items], ITEM_SCHEMA).repartition(3)
    found = pi.contamination(table(spark, data), bench)
    assert sorted(map(tuple, found.collect()), key=str) == brute([r[:2] for r in data], items, 10)


def test_many_blocks_of_phrases(spark, monkeypatch):
    monkeypatch.setattr(pi, "BLOCK_PHRASES", 5)
    data = rows()[:60]
    items = items_of(data)
    bench = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in items], ITEM_SCHEMA)
    found = pi.contamination(table(spark, data), bench, window=6)
    assert sorted(map(tuple, found.collect()), key=str) == brute([r[:2] for r in data], items, 6)


def test_empty_tables(spark):
    docs = table(spark)
    bench = spark.createDataFrame([(1, "of and to"), (2, None)], "item_id long, text string")
    assert pi.contamination(docs.limit(0), bench).count() == 0
    clean = pi.contamination(docs, bench.limit(0)).collect()
    assert len(clean) == len(rows()) and not any(r.contaminated or r.n_items for r in clean)


def test_phrase_and_proximity_matches(spark, monkeypatch):
    monkeypatch.setattr(pi, "SEGMENT_WORDS", 50)
    data = [(i, prose(i, 120), "en", "a", 0, "", "", 0) for i in range(30)]
    index = pi.build_index(table(spark, data), longest=12)
    by_key = {r.doc_key: r.doc_id for r in index.documents(spark).collect()}
    texts = {r[0]: words(r[1]) for r in data}
    phrases = [(1, "of the"), (2, "the the"), (3, "stone under walks"), (4, "nowhere"), (5, ""), (6, "of the"), (7, "to")]
    asked = spark.createDataFrame(phrases, "phrase_id long, phrase string")

    def brute_phrase(w, p):
        return [(i, len(p)) for i in range(len(w) - len(p) + 1) if p and w[i : i + len(p)] == p]

    def brute_near(w, p, width):
        spans = set()
        for i in range(len(w)):
            for j in range(i, min(len(w), i + width)):
                if p and set(p) <= set(w[i : j + 1]):
                    spans.add((i, j))
                    break
        return [(i, j - i + 1) for i, j in spans if not any(i < a and b <= j for a, b in spans)]

    for found, expected in (
        (pi.phrase_matches(index, asked), lambda w, p: brute_phrase(w, p)),
        (pi.near_matches(index, asked, 9), lambda w, p: brute_near(w, p, 9)),
    ):
        got = sorted((by_key[r.doc_key], r.phrase_id, r.start, r.length) for r in found.collect())
        assert got == sorted((d, n, *m) for d, w in texts.items() for n, p in phrases for m in expected(w, p.split()))
        assert len(got) > 50
    with pytest.raises(ValueError):
        pi.phrase_matches(index, spark.createDataFrame([(1, "w " * 12 + "w")], "phrase_id long, phrase string"))
    with pytest.raises(ValueError):
        pi.near_matches(index, asked, 13)


def test_building_moves_no_text(spark):
    docs = table(spark)
    plan = docs.select("doc_id", "text").mapInArrow(pi._indexer(10), pi.INDEX_SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == docs._jdf.queryExecution().executedPlan().toString().count("Exchange")
