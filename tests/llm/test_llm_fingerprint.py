import hashlib

import pytest
from llm_fixtures import prose, rows, table

from tripfold.llm import lz_fingerprint as lz


def phrases(text):
    known, out, phrase = set(), [], ""
    for c in text:
        phrase += c
        if phrase not in known:
            known.add(phrase)
            out.append(phrase)
            phrase = ""
    return out


def test_phrases_and_shared_parse():
    for text in [t or "" for _, t, *_ in rows()][:60]:
        parsed = lz.Phrases().read(text)
        cuts = [0, *parsed.ends]
        assert [text[a:b] for a, b in zip(cuts, cuts[1:])] == phrases(text)
        other = lz.edited(text, prose(1, 50))
        own, changed = lz.fingerprint_pair(text, other)
        assert (own == lz.fingerprint(text)).all() and (changed == lz.fingerprint(other)).all()


def test_hash_tells_phrases_apart():
    text = prose(2, 5000)
    parsed = lz.Phrases().read(text)
    assert len(set(lz.phrase_hashes(text, parsed.ends).tolist())) == len(parsed.ends) == len(set(phrases(text)))


def brute_signature(text):
    """Phrase by phrase and permutation by permutation, in whole numbers of any size."""
    powers, factors, shifts = (x.tolist() for x in lz._constants())
    cut = 1 << 64
    hashes = set()
    for phrase in phrases(text):
        h = sum((ord(c) + 1) * powers[i] for i, c in enumerate(phrase)) % cut
        h = ((h ^ (h >> 32)) * 0xD6E8FEB86659FD93) % cut
        hashes.add(h ^ (h >> 32))
    if not hashes:
        return [(1 << lz.PLACE_BITS) - 1] * lz.SIGNATURE
    least = [min((h * f + s) % cut for h in hashes) for f, s in zip(factors, shifts, strict=True)]
    return [(x * 0x9E3779B97F4A7C15 % cut) >> (64 - lz.PLACE_BITS) for x in least]


def test_signatures_equal_brute_force():
    for text in [t or "" for _, t, *_ in rows()][:45]:
        assert lz.fingerprint(text).tolist() == brute_signature(text)


def test_likeness_estimates_shared_phrases():
    """The share of equal places against the Jaccard similarity of the phrase sets."""
    texts = [prose(i, 400) for i in range(8)]
    for a, b in zip(texts, texts[1:]):
        for other in (b, lz.edited(a, b), a + b):
            one, two = set(phrases(a)), set(phrases(other))
            exact = len(one & two) / len(one | two)
            assert abs(lz.likeness(lz.fingerprint(a), lz.fingerprint(other)) - exact) < 5 * (exact * (1 - exact) / lz.SIGNATURE) ** 0.5 + 0.02


@pytest.mark.parametrize("partitions", [1, 7])
def test_documents(spark, partitions):
    data = [r for r in rows() if r[0] is not None]
    data = list({r[0]: r for r in data}.values())
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = {r.doc_id: r for r in lz.fingerprint_documents(table(spark, data)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    order = sorted(data, key=lambda r: -r[0])
    assert len(found) == len(order)
    for row, after in zip(order, [*order[1:], order[0]], strict=True):
        text, following = row[1] or "", after[1] or ""
        changed = lz.edited(text, following)
        got = found[row[0]]
        assert got.n_chars == len(text) and got.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got.fingerprint == lz.as_text(lz.fingerprint(text)) and got.edited_fingerprint == lz.as_text(lz.fingerprint(changed))
        assert got.near_edited == lz.likeness(lz.fingerprint(text), lz.fingerprint(changed))
        assert got.near_next == lz.likeness(lz.fingerprint(text), lz.fingerprint(following))


def test_awkward_tables(spark):
    assert lz.fingerprint_documents(table(spark).limit(0)).count() == 0
    (one,) = lz.fingerprint_documents(table(spark, rows()[25:26])).collect()
    assert one.near_next == 1.0
    found = lz.fingerprint_documents(table(spark)).collect()  # repeated ids, and none
    assert len(found) == len(rows())
    by_text = {}
    for r in found:
        assert by_text.setdefault((r.doc_id, r.n_chars), r.fingerprint) == r.fingerprint


def test_edits_stay_near():
    texts = [prose(i, 300) for i in range(30)]
    for a, b in zip(texts, texts[1:]):
        own, changed = lz.fingerprint_pair(a, lz.edited(a, b))
        assert lz.likeness(own, changed) > lz.likeness(own, lz.fingerprint(b))
