"""Lines repeated a different number of times, against a brute force on repeated word windows."""

import random

import numpy as np
import pytest

from tagweave.llm.chunk_dedup import AROUND, MIN_WORDS, cut, dedup_report
from tagweave.llm.hashing import Chunk


def letters(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def covered(texts):
    """Per document the number of words in windows of MIN_WORDS words that begin earlier too."""
    seen, out = set(), {}
    for d in sorted(texts):
        w = texts[d].split()
        hit = set()
        for i in range(len(w) - MIN_WORDS + 1):
            window = tuple(w[i : i + MIN_WORDS])
            if window in seen:
                hit.update(range(i, i + MIN_WORDS))
            seen.add(window)
        out[d] = len(hit)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_lines_go_whatever_their_words(spark, docs_dir, seed):
    rng = random.Random(seed)
    texts, width = {}, {}
    for period in range(1, 17):
        for _ in range(4):
            line = " ".join(letters(rng, period)) + "\n"
            for _ in range(3):
                d = len(texts)
                body = line * (rng.randint(100, 160) // period + 1)
                texts[d] = " ".join(letters(rng, 30)) + "\n" + body + " ".join(letters(rng, 30))
                width[d] = period
    docs = spark.read.parquet(docs_dir([(d, t, "x") for d, t in texts.items()]) + "/documents.parquet")
    left = {r["doc_id"]: len(texts[r["doc_id"]].split()) - len(r["text"].split()) for r in dedup_report(docs).collect()}
    want = covered(texts)
    # At either end up to a window of words, a period and the words that the gear hash covers may stay.
    assert {d: (left[d], want[d]) for d in texts if not want[d] - 2 * (AROUND + width[d] + 8) <= left[d] <= want[d] + MIN_WORDS} == {}


def test_phrases_from_different_places_stay(spark, docs_dir):
    rng = random.Random(3)
    texts = {d: " ".join(letters(rng, 60)) for d in range(60)}
    parts = []
    for d in texts:
        data = np.frombuffer(texts[d].encode(), dtype=np.uint8)
        start, end, _, _ = cut(Chunk(np.arange(1), data, np.array([0, len(data)])))
        # Pieces longer than the gear window end with the same cut wherever they stand.
        inner = [data[a:b].tobytes().decode() for a, b in zip(start[1:-1], end[1:-1], strict=True) if 20 <= b - a < 60]
        parts += inner[:1]
    assert len(parts) > 40
    texts[100] = "".join(parts)
    texts[101] = " ".join(letters(rng, 10)) + " " + texts[7] + " " + " ".join(letters(rng, 10))
    docs = spark.read.parquet(docs_dir([(d, t, "x") for d, t in texts.items()]) + "/documents.parquet")
    gone = {r["doc_id"]: r["n_removed"] for r in dedup_report(docs).collect()}
    assert gone.pop(101) > 150 and set(gone.values()) == {0}


def test_passages_of_scripts_without_spaces_go(spark, docs_dir):
    rng = random.Random(4)
    letter = {"zh": (0x4E00, 0x9FA5), "ja": (0x3041, 0x3096), "th": (0x0E01, 0x0E2E), "far": (0x20000, 0x2A6D0)}
    some = lambda lang, n: "".join(chr(rng.randint(*letter[lang])) for _ in range(n))
    texts, passage = {}, {lang: some(lang, 300) for lang in letter}
    for lang, text in passage.items():
        for _ in range(3):
            texts[len(texts)] = some(lang, 50) + text + some(lang, 50)
        texts[len(texts)] = some(lang, 400)
    docs = spark.read.parquet(docs_dir([(d, t, "x") for d, t in texts.items()]) + "/documents.parquet")
    left = {r["doc_id"]: len(texts[r["doc_id"]]) - len(r["text"]) for r in dedup_report(docs).collect()}
    assert all(220 <= n <= 300 if d % 4 in (1, 2) else n == 0 for d, n in left.items()), left
