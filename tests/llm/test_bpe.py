"""Ids against the library and a plain merge loop; exact round trip; long texts and edges."""

import base64
import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken

from tagweave.llm import bpe
from tagweave.llm.queries import op13_byte_bpe

from .conftest import SF_BIG, texts_of

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def plain(text):
    """Each match of the pattern by repeated lowest-rank merges."""
    out = []
    for m in regex.findall(public_tokenizers.PATTERN, text):
        parts = [bytes([b]) for b in m.encode()]
        while len(parts) > 1:
            rank, i = min((RANKS.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out += [RANKS[p] for p in parts]
    return out


def expected(ids, text):
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def got(rows):
    return {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows}


def test_whole_table(spark):
    texts = texts_of(spark, SF_BIG)
    rows = op13_byte_bpe(spark, SF_BIG).collect()
    assert len(rows) == len(texts)
    assert got(rows) == {i: expected(LIBRARY.encode_ordinary(t or ""), t or "") for i, t in texts.items()}


EDGES = [
    None, "", " ", "\n", "a", "it's we'll 'S don't", "Zoë 汉字 \U0001f600‍́ x y　z", "<|endoftext|> <s>",
    "  two\n\n three \t\n four  ", "a'", "1st 22 ½²", "\x1c\x1d a\x85b", "end   ",
]


def test_edges(spark, docs_dir):
    rows = [(i, t, "en") for i, t in enumerate(EDGES)] + [(0, "twice", "en"), (None, "no id", "en")]
    found = bpe.round_trip_digest(spark.read.parquet(docs_dir(rows) + "/documents.parquet"), FILE, public_tokenizers.PATTERN).collect()
    want = sorted((str(i), *expected(plain(t or ""), t or "")) for i, t, _ in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found) == want
    empty = spark.read.parquet(docs_dir([]) + "/documents.parquet")
    assert bpe.round_trip_digest(empty, FILE, public_tokenizers.PATTERN).count() == 0


LONG = {
    "words": "The cat's sat, on 12 mats.\n\n  And then? " * 9,
    "no spaces": "word,12;Wort.'s!don't" * 20,
    "no boundary": "abcd" * 90,
    "signs": "-=" * 90,
    "runs": "ab" + " " * 70 + "c's" + "\n" * 40 + "d" + " \t" * 30 + " e" + "　" * 30,
    "run of spaces before a sign": "x" * 50 + " " * 50 + "!" + " " * 50,
    "only space": " " * 200,
    "unspaced": "汉字假名，かな。" * 30,
}


@pytest.mark.parametrize("name", LONG)
def test_pieces_give_the_whole_texts_ids(monkeypatch, name):
    import re

    monkeypatch.setattr(bpe, "_RUN", re.compile(bpe._RUN.pattern.replace(str(bpe.LONG_RUN), "10")))
    codec = bpe.codec(FILE, public_tokenizers.PATTERN)
    for size in (1, 7, 30):
        monkeypatch.setattr(bpe, "PIECE_CHARS", size)
        pieces = list(bpe.safe_pieces(LONG[name]))
        assert "".join(p for p, _ in pieces) == LONG[name]
        assert codec.encode(LONG[name]).tolist() == LIBRARY.encode_ordinary(LONG[name])
        assert name in ("no boundary", "signs") or len(pieces) > 1


def test_space_runs_beyond_the_librarys_stack():
    codec = bpe.codec(FILE, public_tokenizers.PATTERN)
    run = 1_500_000
    text = "a b" + " " * run + "x " * 50_000
    ids = codec.encode(text)
    assert codec.decode(ids.tolist()) == text.encode()
    # The same ids as with a run the library can take, plus the longer run's own.
    one = tiktoken.Encoding("one", pat_str=r"[\s\S]+", mergeable_ranks=RANKS, special_tokens={})
    head, tail = LIBRARY.encode_ordinary("a b"), LIBRARY.encode_ordinary(" x" + " x" * 49_999 + " ")
    assert ids.tolist() == head + one.encode_ordinary(" " * (run - 1)) + tail


def test_raw_bytes(spark):
    ids = LIBRARY.encode_ordinary("\U0001f9a5")
    assert len(ids) > 1
    df = spark.createDataFrame([(ids[:1], "old"), ([], "old"), (None, "old")], "ids array<int>, decoded string")
    out = [bytes(r["decoded"]) for r in bpe.decode_ids(df, FILE, public_tokenizers.PATTERN).collect()]
    assert out == [LIBRARY.decode_bytes(ids[:1]), b"", b""]
    assert out[0] and "\U0001f9a5".encode().startswith(out[0]) and out[0] != "\U0001f9a5".encode()
