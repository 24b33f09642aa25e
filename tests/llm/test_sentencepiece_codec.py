"""SentencePiece: the library's ids and text, its normalisation offsets, exact spans."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from hourglass.llm import sentencepiece_codec as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n", "a  b", "a\n\nb c", " lead", "trail ", "tab\tx y", "▁ x▁y", "<s> a</s>",
       "a\nb \n c", "日本語 テスト\n😀 ok", "a\r\nb", "word " * 3000, "x" * 5000, "l'été où\nça va"]


def test_same_ids_and_text_as_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    own = S.Codec(PATH)
    assert own.by_words
    ids = list(own.ids(pa.array(ODD, pa.string())))
    assert [x.tolist() for x in ids] == [library.encode(t or "") for t in ODD]
    assert own.decode(ids) == [library.decode(x.tolist()) for x in ids]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab'sé.1日▁<s>", max_size=40), max_size=6))
def test_same_ids_on_any_text(texts):
    own = S.codec(PATH)
    assert [x.tolist() for x in own.ids(pa.array(texts, pa.string()))] == own.library.encode(texts)


@given(st.text(alphabet=" \nabé日😀", max_size=60))
def test_spans_tile_the_text(text):
    own, raw = S.codec(PATH), text.encode()
    ids = next(own.ids(pa.array([text], pa.string())))
    ends = [*own.starts(raw, ids).tolist(), len(raw)]
    for k, i in enumerate(ids.tolist()):
        piece = own.library.id_to_piece(i)
        span = raw[ends[k]:ends[k + 1]]
        if own.library.is_byte(i):
            assert span == bytes([int(piece[3:5], 16)])
        else:
            assert span.decode() in (piece.replace("▁", " "), piece[1:].replace("▁", " "))


def number(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def field(k, v, kind):
    if kind == 0:
        return number(k << 3) + number(v)
    return number(k << 3 | kind) + (number(len(v)) if kind == 2 else b"") + v


def without_byte_fallback(raw):
    """The model with its byte pieces unused and the trainer's flag for them off."""
    out = b""
    for k, v in S.proto_fields(raw):
        if k == 1:      # a piece: text, score, kind
            v = b"".join(field(a, 5 if (a, b) == (3, 6) else b, {1: 2, 2: 5, 3: 0}[a]) for a, b in S.proto_fields(v))
        elif k == 2:
            v += field(35, 0, 0)
        out += field(k, v, 2)
    return out


def test_spans_of_unknown_pieces_without_byte_fallback(tmp_path):
    with open(PATH, "rb") as f:
        model = without_byte_fallback(f.read())
    (tmp_path / "own.model").write_bytes(model)
    own = S.Codec(str(tmp_path / "own.model"))
    assert not own.byte_fallback
    unknown = 0
    for text in ["", "hello 日本 wörld 😀 x  y", "ꙮ", "a ꙮꙮ𐎠 b\nc", " 𐎠", "a\tb \x01"]:
        ids = next(own.ids(pa.array([text], pa.string())))
        assert ids.tolist() == own.library.encode(text)
        found = own.library.encode(text, return_type="proto").pieces
        assert own.starts(text.encode(), ids).tolist() == [p.begin for p in found], text
        unknown += ids.tolist().count(own.library.unk_id())
    assert unknown >= 5


@pytest.mark.parametrize("rules", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("dummy", [True, False])
@pytest.mark.parametrize("extra", [True, False])
def test_normalisation_as_the_library(rules, dummy, extra):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rules, add_dummy_prefix=dummy,
                                                    remove_extra_whitespaces=extra, escape_whitespaces=True)
    own = S.Normalizer(next(v for k, v in S.proto_fields(library.serialized_model_proto()) if k == 3))
    for text in ["", " ", "  a  b ", "ﬁx ①  Ａb", "ﾃﾞｽﾄ　x", "éå", "﻿a​b", "HeLLo ẞ",
                 "½ km²\t\n x", "한국어 각", "日本語"]:
        want, at = library.normalize(text, with_offsets=True)
        got, align = own(text.encode())
        assert got.decode() == want, text
        # The library gives offsets by characters, this by bytes.
        step = np.cumsum([0, *(len(c.encode()) for c in want)]).tolist()
        assert [len(text.encode()[:align[k]].decode()) for k in step] == list(at), text


def test_documents(spark):
    rows = [(i, t, "a", b"z") for i, t in enumerate(ODD)] + [(None, "x y", "b", None), (1, "", "a", b"z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, starts binary")
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = S.encode_decode(docs, PATH).collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), library.encode(r[1] or "", add_bos=True, add_eos=True)) for r in rows)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    for r in got:
        assert r.decoded == library.decode(np.frombuffer(r.ids, "<u4").tolist())
        assert len(r.starts) == len(r.ids)
    assert S.encode_decode(docs.limit(0), PATH).count() == 0
