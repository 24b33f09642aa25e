"""The pipeline, stage by stage, against brute force on the smallest tables."""

import hashlib

import corpus_pipeline as P
import numpy as np
import pytest
import sentencepiece

from hourglass.llm import quality_cnn, queries, secret_scan
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_decontaminate import shingles, words
from tests.llm.test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """Each stage's result on its predecessor's, read again from files."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        path = f"file:{tmp_path_factory.mktemp('stage')}/{k}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source", "n_chars").collect()))


def test_columns_and_order(spark, outputs):
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [df.columns for df in outputs[:-1]] == [names] * 4
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece"]


def test_quality(spark, outputs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = quality_cnn.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    from tests.llm.test_quality_cnn import brute_score
    assert rows(outputs[0]) == [r for r in rows(docs) if brute_score(net, r[1].encode()) >= 0.7]


def test_one_of_each_group(outputs):
    before = rows(outputs[0])
    keep = {c for _, _, c in brute_components([(r[0], brute_print(r[1])) for r in before])}
    assert rows(outputs[1]) == [r for r in before if r[0] in keep]


def test_no_leaks(spark, outputs):
    before = rows(outputs[1])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {g for _, q in items for g in shingles(words(q), 5)}
    bad = {d for d, _ in brute_leaks([r[:2] for r in before if grams & set(shingles(words(r[1]), 5))], items)}
    assert bad and rows(outputs[2]) == [r for r in before if r[0] not in bad]


def test_secrets_are_masked(spark, outputs):
    ratio = secret_scan.train_on(outputs[2])
    want = []
    for r in rows(outputs[2]):
        text = r[1]
        taken = [False] * len(text)
        for s, e, _, _ in secret_scan.all_spans(text, ratio):
            taken[s:e] = [True] * (e - s)
        out = "".join("[secret]" * (i == 0 or not taken[i - 1]) if t else c for i, (c, t) in enumerate(zip(text, taken, strict=True)))
        want.append((r[0], out, r[2], r[3], len(out)))
    assert rows(outputs[3]) == want


def test_encoding(spark, outputs):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_file("piece_bpe_32k.model"))
    want = []
    for r in rows(outputs[3]):
        ids = library.encode(r[1], add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        want.append((r[0], len(ids), raw, hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted((r[0], r[1], bytes(r[2]), *r[3:]) for r in outputs[4].collect()) == want


def test_run_is_the_stages(spark, outputs):
    got = P.run(spark, SF)
    assert sorted((r.doc_id, r.ids_sha256) for r in got.collect()) == sorted((r.doc_id, r.ids_sha256) for r in outputs[4].collect())


def test_odd_rows_pass_every_stage(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"file:{tmp_path}/{name}.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, fingerprint long, ids binary"
    odd = [(None, None, None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1.0, "x", 5, b"z"), (1, "", "en", "s", 0, 1.0, "x", 5, b"z"),
           (2, "The house is old, and it has been there for long. " * 4000, "en", "s", 1, None, "y", None, None)]
    for data in (odd, []):
        docs = spark.createDataFrame(data, schema)
        for k, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, f"file:{tmp_path}")
            if k < 4:
                assert out.columns == docs.columns
            got = out.collect()
            if k in (0, 2, 3):
                assert len(got) <= len(data)
            if k == 1 and data:    # the empty texts are one group, named by id 1
                assert sorted(r.doc_id for r in got) == [1, 2]
            if k == 4:
                assert len(got) == len(data)
