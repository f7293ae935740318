"""Small documents for the operators' tests."""

import random
import re

CLASHING = ("n", "sid", "key", "label", "score", "bucket", "text_key", "parts", "found", "region", "copies", "size", "shard", "group")


def doc_frame(spark, rows, clash=True):
    """``rows`` of (doc_id, text) with the other columns of documents and some named like the operators' own."""
    extra = ", ".join(f"{c} string" for c in CLASHING) if clash else ""
    full = [(i, t, "en", "src0", None if t is None else len(t), *(["x"] * len(CLASHING) if clash else [])) for i, t in rows]
    return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint" + (", " + extra if extra else ""))


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def prose(rng: random.Random, n: int, vocabulary: int = 5000) -> str:
    """n invented words in sentences."""
    out = []
    for i in range(n):
        w = f"w{rng.randrange(vocabulary)}"
        out.append(w + ("." if rng.random() < 0.12 or i == n - 1 else ""))
    return " ".join(out)


def edited(rng: random.Random, text: str, share: float) -> str:
    ws = text.split(" ")
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in ws)


EDGES = [(None, None), (None, "no id here"), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (5, "one"), (6, "é" * 300), (7, "x" * 200_000)]
