"""Token files: the library's ids, exact round trips, edge cases."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hourglass.llm import token_output as T
from hourglass.session import work_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n", "a  b", "a\n\nb c", " lead", "trail ", "tab\tx y", "x y z　",
       "it's  don't\n we'll", "<|endoftext|> a<|endoftext|>b", "\x1c!\x1c a", "日本語 テスト\n😀 ok",
       "a\r\nb", "word " * 3000, "x" * 20000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_same_ids_as_the_library(library):
    got = [x.tolist() for x in T.ByteBpe(PATH).encode(pa.array(ODD, pa.string()))]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab'sé.1日 \x1c<|>", max_size=40), max_size=6))
def test_same_ids_on_any_text(texts):
    library = Tokenizer.from_file(PATH)
    got = [x.tolist() for x in T.byte_bpe(PATH).encode(pa.array(texts, pa.string()))]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_get_whole_texts():
    other = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(other), T.ByteBpe(other)
    assert not encoder.by_words and T.byte_bpe(PATH).by_words
    got = [x.tolist() for x in encoder.encode(pa.array(ODD, pa.string()))]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in ODD]


def test_words_beyond_the_memory(library, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED_WORDS", 5)
    texts = [f"w{i} a,b{i % 7}\nx{i}" for i in range(300)] * 2
    got = [x.tolist() for x in T.ByteBpe(PATH).encode(pa.array(texts, pa.string()))]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=100), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(ids, planes):
    ids = np.array(ids, "<u4")
    frames = [p if p.strip(b"\0") else b"" for p in T.to_planes(ids, planes)]
    assert T.from_planes(frames, len(ids), planes).tolist() == ids.tolist()


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_files_round_trip(spark, library, planes):
    rows = [(i * 7 % 23, t, "x", 1) for i, t in enumerate(ODD)] + [(3, "again", "y", 2), (None, "n", "z", 3),
                                                                   (3, "again", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, ids int")
    out = work_dir(spark, "tokens")
    manifest = T.write_token_ids(docs, out, PATH, planes=planes, block_ids=64).collect()
    assert sum(m.n_docs for m in manifest) == len(rows)
    got = sorted((r.start, r.doc_id, bytes(r.ids)) for r in T.read_token_ids(spark, out).collect())
    keys = [(-1 if r[1] is None else r[1]) for r in got]
    assert keys == sorted(keys)
    start = 0
    for r in got:
        assert r[0] == start
        start += len(r[2]) // 4
    want = sorted((-1 if r[0] is None else r[0],
                   np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
                  for r in rows)
    assert sorted((k, r[2]) for k, r in zip(keys, got, strict=True)) == want


def test_empty_table(spark):
    out = work_dir(spark, "tokens")
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.write_token_ids(docs, out, PATH).count() == 0
    assert T.read_token_ids(spark, out).count() == 0


def test_damage_is_found(spark, tmp_path):
    out = f"file:{tmp_path}/t"
    T.write_token_ids(spark.createDataFrame([(1, "some words here")], "doc_id long, text string"), out, PATH)
    path = next((tmp_path / "t").glob("*.hgtp"))
    raw = bytearray(path.read_bytes())
    assert zlib.crc32(bytes(raw))
    raw[-1] ^= 1
    path.write_bytes(bytes(raw))
    with pytest.raises(ValueError, match="not a whole"):
        list(T.read_file(str(path)))
