"""Chunk dedup against a plain loop; planted passages; shifts."""

import random

import numpy as np

from tagweave.llm.chunk_dedup import _GEAR, AROUND, CODE_POINTS, MEAN_WORDS, MIN_WORDS, UNSPACED, WINDOW, dedup_report, remove_repeats
from tagweave.llm.queries import op9_chunk_dedup

from .conftest import SF, texts_of


def pieces(text):
    """(bytes, weight) of every chunk, place by place."""
    data, space = text.encode(), b" \t\n\x0b\x0c\r"
    weights, i = {}, 0  # of the places where a word or a code point of an unspaced script starts
    for c in text:
        if any(lo <= ord(c) <= hi for lo, hi in UNSPACED):
            weights[i] = 1
        elif data[i] not in space and (i == 0 or data[i - 1] in space):
            weights[i] = CODE_POINTS
        i += len(c.encode())
    hashes = {}
    for place in weights:
        if place >= WINDOW:
            h = 0
            for x in data[place - WINDOW : place]:
                h = ((h << 1) + int(_GEAR[x])) & 0xFFFFFFFF
            hashes[place] = h
    places = list(hashes)
    cuts = [0]
    for k, place in enumerate(places):
        around = [hashes[p] for p in places[max(0, k - AROUND) : k + AROUND + 1]]
        if hashes[place] < (1 << 32) // (MEAN_WORDS * CODE_POINTS) * weights[place] or hashes[place] == min(around):
            cuts.append(place)
    ends = [*cuts[1:], len(data)]
    return [(data[a:b], sum(w for p, w in weights.items() if a <= p < b)) for a, b in zip(cuts, ends, strict=True)] if data else []


def brute(texts):
    seen, out = set(), {}
    for d in sorted(texts):
        parts = pieces(texts[d] or "")
        runs = []
        for i in range(len(parts)):
            links = [(i + 1, parts[i][0] + parts[i + 1][0])] if i + 1 < len(parts) else []
            links += [(i, parts[i][0])] if parts[i][1] >= MIN_WORDS * CODE_POINTS else []
            for last, link in links:
                if link in seen and runs and i <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], last)
                elif link in seen:
                    runs.append([i, last])
            seen.update(link for _, link in links)
        runs = [(a, b) for a, b in runs if sum(w for _, w in parts[a : b + 1]) >= MIN_WORDS * CODE_POINTS]
        gone = {i for a, b in runs for i in range(a, b + 1)}
        kept = b"".join(p for i, (p, _) in enumerate(parts) if i not in gone)
        n = len((texts[d] or "").encode())
        out[d] = (n, n - len(kept), len(runs), kept.decode())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["text"]) for r in df.collect()}


def test_whole_table(spark):
    assert result(op9_chunk_dedup(spark, SF)) == brute(texts_of(spark, SF))


def test_planted_passages_go_and_clean_texts_stay(spark, docs_dir):
    rng = random.Random(9)
    word = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passages = [word(60) for _ in range(20)]
    rows = [(0, None, "x"), (1, "", "x"), (2, " ", "x"), (3, "é\n\nü " * 3, "x")]
    for d in range(4, 200):
        mid = [passages[rng.randrange(20)]] if d % 2 else []
        rows.append((d, "  ".join([word(rng.randint(1, 40)), *mid, word(rng.randint(1, 40))]), "x"))
    rows.append((500, "same line here\n" * 300, "x"))
    unspaced = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(90))
    rows += [(501, unspaced + "。ab " + word(30), "x"), (502, word(5) + unspaced + word(5), "x")]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    texts = {d: t for d, t, _ in rows}
    got = result(dedup_report(docs))
    assert got == brute(texts)
    assert all(got[d][1] == 0 for d in range(4, 200) if d % 2 == 0)
    again = [d for d in range(5, 200, 2) if any(p in texts[e] for p in passages if p in texts[d] for e in range(5, d, 2))]
    assert len(again) > 60 and np.mean([got[d][1] > 150 for d in again]) > 0.95
    assert got[500][1] > 0.9 * got[500][0]
    out = remove_repeats(docs)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() == len(rows)
    assert remove_repeats(docs.where("false")).collect() == []
