import hashlib
import math
import re
from collections import Counter

import pytest
import xxhash
from llm_fixtures import rows, table

from tripfold.llm import mixing


def key(seed, copy, doc_id):
    return int(hashlib.md5(f"{seed}|{copy}|{'' if doc_id is None else doc_id}".encode()).hexdigest()[:15], 16)


def tie(text):
    return xxhash.xxh64_intdigest((text or "").encode(), seed=42) >> 4


def brute(data, mix):
    n = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in data]
    tokens = Counter()
    for r, x in zip(data, n, strict=True):
        tokens[r[3]] += x
    total = sum(tokens.values())
    shares = sorted(x / total for x in tokens.values() if x)
    grid = 1 << mixing.STEPS

    def weights(k):
        w = [p ** (k / grid) for p in shares]
        return [x / sum(w) for x in w]

    def good(k):
        w = weights(k)
        return -sum(x * math.log(x) for x in w) >= mix.entropy * math.log(len(w))

    def often(k):
        return mix.budget * weights(k)[0] / shares[0] > mix.max_repeats

    def last(test):
        low, high = 0, grid + 1
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if test(mid) else (low, mid)
        return low

    k = max(last(good), min(last(often) + 1, grid) if often(0) else 0)
    norm = sum(p ** (k / grid) for p in shares)
    out = Counter()
    for source, have in tokens.items():
        if not have:
            continue
        quota = math.floor(math.floor(total * mix.budget) * ((have / total) ** (k / grid) / norm))
        passes, rest = divmod(quota, have)
        mine = [(key(mix.seed, passes, r[0]), tie(r[1]), r[0], x) for r, x in zip(data, n, strict=True) if r[3] == source]
        running = 0
        for _, _, doc_id, x in sorted(mine, key=lambda m: m[:2]):  # row by row, whatever their ids
            running += x
            out[doc_id, source] += passes + (running <= rest)
    return +out, k


MIXES = [mixing.Mix(), mixing.Mix(entropy=0.999, max_repeats=50), mixing.Mix(entropy=0.9, max_repeats=1.2), mixing.Mix(entropy=0.95, budget=0.4), mixing.Mix(entropy=0.5, budget=2.6, max_repeats=4)]


@pytest.mark.parametrize("mix", MIXES)
@pytest.mark.parametrize("block_rows", [3, 4096])
def test_copies(spark, monkeypatch, mix, block_rows):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block_rows)
    data = rows()
    found = mixing.mixture(table(spark, data), mix).collect()
    expected, _ = brute(data, mix)
    assert Counter((r.doc_id, r.source) for r in found) == expected
    assert all(r.mix_key == key(mix.seed, r.copy, r.doc_id) and r.mix_block >= 0 for r in found)


def test_weights_meet_the_target(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'five words make this text' as text", "case when id % 3 = 0 then 'hot' else 's' || id % 12 end as source")
    mix = mixing.Mix(entropy=0.98, max_repeats=8)
    counts = Counter(r.source for r in mixing.mixture(docs, mix).collect())
    total = sum(counts.values())
    entropy = -sum(c / total * math.log(c / total) for c in counts.values()) / math.log(len(counts))
    assert abs(total - 3000) <= len(counts) and 0.979 < entropy < 0.982
    capped = mixing.Mix(entropy=1.0, max_repeats=1.1)
    copies = Counter(r.source for r in mixing.mixture(docs, capped).collect())
    assert max(copies[s] / 250 for s in copies if s != "hot") <= 1.1


def test_any_run_of_blocks_holds_the_mix(spark):
    docs = spark.range(8000).selectExpr("id as doc_id", "'a text of five words' as text", "if(id % 4 = 0, 'a', 'b') as source")
    found = mixing.mixture(docs, mixing.Mix(entropy=0.97, block_tokens=10_000)).collect()
    by_block = Counter((r.mix_block, r.source) for r in found)
    blocks = {b for b, _ in by_block}
    assert len(blocks) == 4
    share = sum(r.source == "a" for r in found) / len(found)
    for b in blocks:
        assert abs(by_block[b, "a"] / (by_block[b, "a"] + by_block[b, "b"]) - share) < 0.05


def test_documents_keep_their_columns(spark):
    docs = table(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.schema == docs.schema
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == brute(rows(), mixing.Mix())[0]
    assert mixing.mixture(docs.limit(0)).count() == 0
    assert mixing.mixture(docs.where("text is null or trim(text) = ''")).count() == 0


@pytest.mark.parametrize(("texts", "block_rows"), [(1, 4096), (7, 3), (2000, 4096)])
def test_rows_of_one_id_are_cut_row_by_row(spark, monkeypatch, texts, block_rows):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block_rows)
    source = "case when id < 2000 then 'null ids' when id < 4000 then 'one id' else 's' || id % 8 end as source"
    doc_id = "case when id >= 4000 then id when id >= 2000 then 5 end as doc_id"
    docs = spark.range(6000).selectExpr(doc_id, f"concat('four words and ', id % {texts}) as text", source).repartition(7)
    mix = mixing.Mix(block_tokens=3000)
    found = mixing.mixture(docs, mix).collect()
    plan, *_ = mixing.quotas(docs, mix)
    quota = {r.mix_source[1:]: r.quota for r in plan.collect()}
    copies = Counter(r.source for r in found)
    assert all(0 <= quota[s] - 4 * copies[s] < 4 for s in quota) and quota["null ids"] < 8000
    assert Counter(r.source for r in mixing.mixed_documents(docs, mix).collect()) == copies
    by_block = Counter((r.mix_block, r.source) for r in found)
    blocks = max(b for b, _ in by_block) + 1
    assert blocks == 8 and all(abs(by_block[b, s] * blocks / copies[s] - 1) < 0.35 for b in range(blocks) for s in ("null ids", "one id"))


def test_no_python_in_the_plan(spark):
    plan = mixing.mixture(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
