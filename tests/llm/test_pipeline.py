import base64
import gc
import random
import weakref

import public_tokenizers
import pyarrow as pa
from pyspark import cloudpickle

import corpus_pipeline
from paperlode.llm import bpe, common
from paperlode.llm.common import table


def test_stages_take_effect(spark, tmp_path):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    text = lambda: "\n".join(" ".join(word() for _ in range(r.randint(9, 20))) for _ in range(4))
    docs = [(i, text(), "en", f"s{i % 3}") for i in range(120)]
    docs += [(200 + i, "$$$ ### %%% &&& *** " * 20, "en", "s") for i in range(40)]
    leak = " ".join(word() for _ in range(30))
    docs += [(300, docs[3][1], "en", "s"), (301, f"{text()} {leak} {word()}", "en", "s"), (302, None, "en", "s"), (None, text(), None, None)]
    rows = [(*d, len(d[1] or ""), "extra") for d in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i, *_ in docs if i is not None and i < 240], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"], name
        df.write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
    kept = {x.doc_id for x in df.collect()}
    assert set(range(120)) <= kept and None in kept and not kept & {*range(200, 240), 301}
    assert len(kept & {300, 302}) <= 1  # both are empty by now, so one of them goes
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {x.doc_id for x in out.collect()} == kept and out.columns[:2] == ["doc_id", "n_tokens"]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_workers_hold_no_memory_of_other_stages(spark, tmp_path, monkeypatch):
    r = random.Random(13)
    text = lambda: "\n".join(" ".join(r.choice(["red", "green", "blue", "black"]) + str(r.randint(0, 999)) for _ in range(12)) for _ in range(3))
    one = text()
    docs = [(i, one + f" {i}" if i < 6 else text(), "en", "s", 9) for i in range(12)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, text())], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sent, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, *a, **k: sent.append(run) or plain(self, run, *a, **k))
    returned = []
    monkeypatch.setattr("paperlode.llm.common._give_back", lambda: returned.append(True), raising=False)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = b"\n".join(f.read().splitlines()[:300])
    for name, stage in corpus_pipeline.STAGES:
        sent.clear()
        stage(spark, docs, str(tmp_path))
        assert sent, name
        if name != "tokens":
            for run in sent:  # as a worker does that had a task of the last stage before
                coder = weakref.ref(bpe.coder(ranks, public_tokenizers.PATTERN))
                returned.clear()
                assert not list(run(iter([])))
                gc.collect()
                assert coder() is None and returned, (name, run)
    one = pa.RecordBatch.from_pydict({"id": [1], "text": ["a b"]})
    returned.clear()
    assert len(list(sent[0](iter([one, one])))) == 2 and len(returned) == 3


def test_what_a_worker_keeps_goes_with_a_function_that_was_sent():
    sent = lambda **k: cloudpickle.loads(cloudpickle.dumps(common.lean(lambda batches: batches, **k)))
    ranks = b"\n".join(b"%s %d" % (base64.b64encode(bytes([i])), i) for i in range(256))
    coder = weakref.ref(bpe.coder(ranks, public_tokenizers.PATTERN))
    assert list(sent(keeps=True)(iter([]))) == []
    assert coder() is bpe.coder(ranks, public_tokenizers.PATTERN)
    assert list(sent()(iter([]))) == []
    gc.collect()
    assert coder() is None
