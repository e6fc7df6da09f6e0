import re
import time
from collections import Counter

from llm_fixtures import prose, rows, table

from tripfold.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


REPEATS = ["a b c a b c d " * 12, "x " * 60, "p q r s " * 3 + prose(8, 70), "same line here\n" * 30, "one two one two one two three " * 9]


def test_counts(spark):
    data = rows() + [(900 + i, t, None, None, 0, "", "", 0) for i, t in enumerate(REPEATS)]
    found = q.judge(table(spark, data)).collect()
    got = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found], key=str)
    assert got == sorted([(r[0], *brute(r[1])) for r in data], key=str)
    assert not any(r.kept and r.base_failed for r in found)
    assert q.judge(table(spark).limit(0)).count() == 0


def test_rules_and_filter(spark):
    good = "".join(f"the river{i} of stone{i} is in a valley{i} and to the hill{i} was with tree{i}.\n" for i in range(8))
    texts = {1: good, 2: good.replace(" ", "### "), 3: good.upper().replace(" ", "!! "), 4: good.replace(" ", " | ")}
    docs = table(spark, [(i, t, "en", None, 0, "", "", 0) for i, t in texts.items()])
    assert {r.doc_id: r.kept for r in q.judge(docs).collect()} == {1: True, 2: False, 3: False, 4: False}
    kept = q.keep_good(docs)
    assert kept.schema == docs.schema and [r.text for r in kept.collect()] == [good]
    only = (q.Rule("words", "n_words", None, 60),)
    assert q.keep_good(docs, only).count() == 0


def test_filter_on_the_verdict_of_a_very_long_text(spark):
    """The words are not split anew for every window when a filter is put on the result."""
    docs = table(spark, [(1, prose(3, 30_000), "en", None, 0, "", "", 0), (2, "short", "en", None, 0, "", "", 0)])
    q.judge(docs).where("kept").collect()  # compiled before the clock starts
    start = time.monotonic()
    assert q.judge(docs).where("not kept").count() == 2 - q.judge(docs).where("kept").count()
    assert time.monotonic() - start < 15


def test_one_pass(spark):
    """No shuffle, no Python, and the words are split once, whether judged or filtered."""
    docs = table(spark).drop("x")
    for df in (q.judge(docs), q.keep_good(docs)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") <= 3 and "Python" not in plan and "Arrow" not in plan
