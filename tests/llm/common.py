"""Small corpora, and plain versions of the operators to hold them against."""

import random
import re

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cls long, key string, n int, score double"


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def corpus(seed=0, n=60):
    """Texts with exact and near copies, shared passages, nulls, blanks, one long text, odd white space and clashing columns."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "Lo", "mi", "éx", "zu") for b in ("ra", "ten", "vol", "qui", "S")]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [None, "", " \t\n", "one", "one two three", "Ab,cd!", "ǅ\u2028x\x1cy"]
    for _ in range(n):
        texts.append(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 220))))
    for i in range(12):
        base = texts[8 + i % 5].split()
        for _ in range(rng.randrange(0, 4)):
            base[rng.randrange(len(base))] = rng.choice(words)
        texts.append("  ".join(base) if i % 2 else "\n".join(base))
    texts += [texts[10]] * 4 + [f"{texts[9]} {passage} tail", f"head {passage}", passage]
    texts.append(" ".join(rng.choice(words) for _ in range(9000)))
    return [(i, t, rng.choice(["en", "de", None]), "s", len(t or ""), 7, "k", 1, 0.5) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
