"""Small tables with the awkward cases every operator must bear."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, bucket int, node string, key string, size int"

WORDS = "the of and to river stone light under walks slowly because every morning Häuser été niño ñandú 2024 £5 don't e-mail".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(words):
        out.append(rng.choice(WORDS) + str(rng.randrange(300)) * (rng.random() < 0.5))
        out.append("." if rng.random() < 0.08 else "")
        out.append("\n" if rng.random() < 0.02 else " ")
    return "".join(out).strip()


def cancelling_pair(letters: int) -> tuple[str, str]:
    """Two words, one the complement of the other, that powers of an odd base cannot tell apart modulo 2 ** 64."""
    bits = [bin(i).count("1") & 1 for i in range(letters)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "\t \r\n",
    "one",
    "two words",
    "a  b   c",
    " lead and trail ",
    "tab\tand nbsp em　wide",
    "x<|endoftext|>y <|startoftext|> z <s> </s> <unk> <0x0A>",
    "é combining é ΑΣ ΣΑΣ İI ß",
    "日本語 テキスト 🙂 👩‍👩‍👧",
    "▁mark ▁▁b",
    "\x00nul\x1cfs\x85nel",
    "### $$$ %%% &&& *** ||| <<< >>>",
    "- a\n- a\n- a\n...\nb…",
    "I'll don't we've 've\n'tis\n",
    "ÅÅ " * 40,
    "x" * 9000,
]


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Odd texts, prose, exact copies, near copies, a repeated row, and a row without an id."""
    rng = random.Random(seed)
    texts = [*ODD_TEXTS, *(prose(seed * 1000 + i, rng.choice([3, 30, 80, 400])) for i in range(n))]
    texts += texts[25:35]
    base = prose(seed + 7, 300).split(" ")
    for i in range(12):
        copy = list(base)
        for _ in range(i):
            copy[rng.randrange(len(copy))] = "changed"
        texts.append(" ".join(copy))
    texts.append(prose(seed + 99, 30_000))  # very long
    ids = list(range(3, 3 + 7 * len(texts), 7))
    rng.shuffle(ids)
    out = [(i, t, "en", rng.choice(["a", "a", "a", "b", "c", None]), 5, "n", "k", 9) for i, t in zip(ids, texts, strict=True)]
    return [*out, out[30], out[30], (None, "no id here, " * 20, "en", "a", 5, "n", "k", 9)]


def table(spark, data: list[tuple] | None = None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
