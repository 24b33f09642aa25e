"""Rank-file BPE: the library's ids, cuts that change nothing, exact decoding, edge cases."""

import base64

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hourglass.llm import rank_bpe as R

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXT = st.text(alphabet=" \n\t\x1c　\u0085ab'sDLl1२é日.!-\"_😀", max_size=120)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 12))
def test_cuts_change_no_id(library, text, chunk):
    c = R.codec(PATH, PATTERN)
    small = object.__new__(R.RankBpe)
    small.__dict__ = c.__dict__ | {"_chunk": chunk, "_long_space": regex.compile(r"\p{White_Space}{%d,}+" % chunk)}
    parts = list(small._parts(text))
    assert "".join(p.decode() if isinstance(p, bytes) else p for p in parts) == text
    ids = small.encode(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert small.decode(ids) == text.encode()


def merged(ranks, piece):
    """Plain merging: the pair of least rank first, leftmost of equals."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


@settings(max_examples=100, deadline=None)
@given(TEXT)
def test_against_plain_merging(text):
    ranks = R.load_ranks(PATH)
    matches = regex.findall(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
                            .replace(r"[^\p{White_Space}", r"[^\p{White_Space}"), text)
    want = [i for m in matches for i in merged(ranks, m.encode())]
    assert R.codec(PATH, PATTERN).encode(text).tolist() == want


def test_runs_the_pattern_cannot_hold(library):
    """Runs of white space beyond the library's stack, in the middle and at the end."""
    c = R.codec(PATH, PATTERN)
    for text in (" " * 2_000_000 + "a b", "x\n" + "\n" * 1_500_000, "a" + "　" * 1_200_000 + "\nb", "x" * 300_000,
                 "word 12 " * 60_000, "a1" * 100_000, "日本" * 80_000, "'s" * 90_000):
        assert c.decode(c.encode(text)) == text.encode()
    for text in (" " * 300_000 + "a b", "x" * 300_000, "word 12 " * 60_000, "a1" * 100_000, "日本" * 80_000, "'s" * 90_000):
        assert c.encode(text).tolist() == library.encode_ordinary(text)


def test_rows_and_edges(spark, library):
    rows = [(1, "some words, 12 of them\n", "x", 5), (1, "some words, 12 of them\n", "x", 5), (None, "é日😀", "y", 6),
            (2, None, None, None), (3, "", "z", 7), (4, "<|endoftext|> 's\x00", "z", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    got = R.decode(R.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got) == sorted(
        (str(k), library.encode_ordinary(t or ""), (t or "").encode()) for k, t, *_ in rows)
    assert R.decode(R.encode(docs.limit(0), PATH, PATTERN), PATH, PATTERN).count() == 0


def test_ids_inside_a_character_decode(library):
    c = R.codec(PATH, PATTERN)
    ids = c.encode("a😀ༀb")
    assert b"".join(c.decode(ids[k:k + 1]) for k in range(len(ids))) == "a😀ༀb".encode()
    with pytest.raises(ValueError, match="not an id"):
        c.decode(np.array([50256], "<u4"))


def test_query_against_whole_texts(spark, library):
    import hashlib

    from hourglass.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op11_rank_bpe"](spark, sf).collect()}
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    assert got == want
