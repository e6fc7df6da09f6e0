import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import prose, rows, table

from tripfold.llm import packing
from tripfold.llm.wordcodec import load_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("block", [packing.BLOCK_TOKENS, 40_000])
def test_every_id_lies_in_one_piece(spark, monkeypatch, block):
    monkeypatch.setattr(packing, "HELD_WINDOWS", 4)
    data = [(i, t) for i, (_, t, *_) in enumerate(rows())]
    data.append((len(data), " ".join(f"word{i}" for i in range(40_000))))  # no sentence ends
    docs = spark.createDataFrame(data, "doc_id long, text string")
    if block != packing.BLOCK_TOKENS:  # small blocks, in one process
        monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
        packer, found = packing.Packer(2048, packing.sentence_ends(PATH)), []
        for key, text in data:
            ids = [*load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids, 1]
            found += packer.add(key, np.array(ids, "<u2"))
        found += packer.flush()
    else:
        found = [tuple(r) for r in packing.pack_documents(docs, PATH, 2048, 1).collect()]
    pieces, windows = {}, {}
    for key, start, length, code, total, window, offset in found:
        pieces.setdefault(key, []).append((start, length, code, total))
        windows.setdefault(window, []).append((offset, length, key, start))
    for key, text in data:
        ids = [*load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for start, length, code, total in sorted(pieces[key]):
            assert start == at and length > 0 and total == len(ids) and code == crc(ids[start : start + length])
            at += length
        assert at == len(ids)
    assert sorted(windows) == list(range(len(windows)))
    order = []
    for window in sorted(windows):
        at = 0
        for offset, length, key, start in sorted(windows[window]):
            assert offset == at
            at += length
            order.append((key, start))
        assert at <= 2048
    assert order == sorted(order)  # documents keep their order
    total = sum(p[1] for ps in pieces.values() for p in ps)
    assert total / (2048 * len(windows)) > 0.95


def test_cuts_are_the_cheapest():
    rng = random.Random(3)
    for _ in range(200):
        places = sorted({0, *(rng.randrange(1, 60) for _ in range(14)), 60})
        places = [p for i, p in enumerate(places)]
        if any(b - a > 20 for a, b in zip(places, places[1:])):
            continue
        costs = [rng.choice([0, 3, 9]) for _ in places]

        def best(j):
            return 0 if j == 0 else min(best(i) + 20 - places[j] + places[i] + costs[j] for i in range(j) if places[j] - places[i] <= 20)

        cuts = packing.choose_cuts(places, costs, 20)
        assert sum(20 - places[b] + places[a] + costs[b] for a, b in zip(cuts, cuts[1:])) == best(len(places) - 1)


def test_awkward_tables(spark):
    assert packing.pack_documents(table(spark).limit(0), PATH, 2048, 1).count() == 0
    found = packing.pack_documents(table(spark), PATH, 2048, 1).collect()  # repeated ids, and none
    assert sum(r.length for r in found) == sum(len(load_tokenizer(PATH).encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in rows())
    with pytest.raises(ValueError):
        packing.pack_documents(table(spark), PATH, 100, 1)


def test_sentences_are_not_cut_without_need():
    text = prose(6, 3000)
    ids = np.array(load_tokenizer(PATH).encode(text, add_special_tokens=False).ids, "<u2")
    ends = packing.sentence_ends(PATH)
    packer = packing.Packer(2048, ends)
    found = [*packer.add(1, ids), *packer.flush()]
    assert all(ends[ids[start + length - 1]] for _, start, length, *_ in found[:-1])
