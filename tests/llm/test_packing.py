"""Packing: ids against the tokenizer itself, placement invariants, dominance and quality."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tagweave.llm import packing
from tagweave.llm.packing import best_fit, pack, pack_documents, reduce_instance
from tagweave.llm.queries import op1_best_fit_pack

from .conftest import SF_BIG, texts_of

FILE = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, capacity=2048):
    tokenizer, by_doc, by_sequence = Tokenizer.from_file(FILE), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_doc.keys() == texts.keys()
    for d, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for k, r in enumerate(sorted(by_doc[d], key=lambda r: r["piece"])):
            part = ids[k * capacity : (k + 1) * capacity]
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (k, k * capacity, len(part), zlib.crc32(part.tobytes()))
        assert len(by_doc[d]) == -(-len(ids) // capacity)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_whole_table(spark):
    rows = op1_best_fit_pack(spark, SF_BIG).collect()
    n = check(rows, texts_of(spark, SF_BIG))
    assert n <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_nulls_spaces_and_special_strings(spark, docs_dir):
    odd = [None, "", " \n\t ", "<|endoftext|> a<|startoftext|>b", "it's I'LL  don't x y", "é ́a ǅ İ Σς ΑΣ", "汉字 😀😀 1234", "x " * 9000]
    odd += ["a\x1cb\x85c d", "same", "same", "‍​", "'s 't 'sx a'  s"]
    rows = [(i, t, "x") for i, t in enumerate(odd)]
    docs = spark.read.parquet(docs_dir(rows) + "/documents.parquet")
    got = pack_documents(docs, FILE, with_ids=True).collect()
    check(got, dict(enumerate(odd)))
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    assert pack_documents(docs.where("false"), FILE).collect() == []


def used(patterns):
    c = Counter()
    for lengths, n in patterns:
        for x in lengths:
            c[x] += n
    return c


def smallest(items, capacity):
    """Fewest sequences by exhaustive search."""
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= items[i]}:
            rest = list(rooms)
            rest.remove(r)
            go(i + 1, sorted(rest + [r - items[i]]))
        go(i + 1, sorted(rooms + [capacity - items[i]]))

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum_and_packing_is_complete():
    rng = random.Random(3)
    for _ in range(300):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = Counter(items)
        fixed, rest = reduce_instance(counts, 20)
        assert used(fixed) + Counter(rest) == counts
        left = sorted(Counter(rest).elements(), reverse=True)
        assert sum(n for _, n in fixed) + (smallest(left, 20) if left else 0) == smallest(items, 20)
        packed = pack(counts, 20)
        assert used(packed) == counts and all(sum(x) <= 20 for x, _ in packed)


def test_large_instances():
    rng = np.random.default_rng(0)
    for counts in (Counter(rng.integers(1, 2049, 200_000).tolist()), Counter({700: 10**9, 400: 10**9, 3: 5})):
        packed = pack(counts)
        assert used(packed) == counts
    assert used(best_fit({5: 7, 3: 9}, 10)) == {5: 7, 3: 9} and pack({}) == []
    n = sum(k for _, k in pack(Counter(rng.integers(1, 700, 100_000).tolist())))
    assert n > 0


def test_words_encoded_together_are_words_encoded_alone():
    encoder = packing.Encoder(FILE)
    assert len(encoder.marks) == 2
    words = ["", "a", "don't", "x7", "9", "79", "7", "\u00a0", "\r", "é", "\U0001f600", "<|endoftext|>", "W\x00w", "e\u0301", "\u200d", "７"]
    words += [f"w{i}" for i in range(300)]
    encoder._learn(words)
    alone = encoder.tokenizer.encode_batch(words, add_special_tokens=False)
    assert {w: np.frombuffer(encoder.known[w], "<u4").tolist() for w in words} == {w: e.ids for w, e in zip(words, alone, strict=True)}


def test_a_tokenizer_that_minds_white_space_is_refused():
    with pytest.raises(ValueError, match="white space"):
        packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
