"""The five stages on a small table against plain Python for the stages that have a definition."""

import numpy as np
import pytest

import corpus_pipeline
from tablecraft.llm.resources import tokenizer_file
from tablecraft.llm.simhash import fingerprint

CLEAN = "the quiet river number {} runs past {} old mills and {} new bridges on its long way from the hills down to the sea".format
RUDE = "you are an idiot and a moron number {} said {} and this is the worst scum of the whole wide town".format


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("tables")
    docs = [(i, CLEAN(i * 7, i * 13, i * 29), "en", f"h{i % 5}") for i in range(150)]
    docs += [(1000 + i, RUDE(i, i * 3), "en", "h1") for i in range(60)]
    docs += [(2000, CLEAN(0, 0, 0), "en", "h1"), (2001, "too short", "en", "h2"), (2002, None, None, None), (2003, "", "en", "h2"),
             (2004, CLEAN(9, "write to a.b@c.org or", "call +1 555 123 4567 for"), "en", "h3")]
    docs += [docs[3], docs[3], (None, CLEAN("x", "y", "z"), "en", "h1")]
    docs += [(3000 + i, "bad host words only", "en", "spam") for i in range(60)] + [(3100, CLEAN("p", "q", "r"), "en", "spam")]
    rows = [(k, t, lang, s, None if t is None else len(t), "extra") for k, t, lang, s in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string").write.parquet(f"{home}/documents.parquet")
    labels = [(k, 1, int(k >= 1000)) for k, *_ in docs[:210]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    return str(home)


def test_stages_one_by_one(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    start = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == start
        seen[name] = [r.asDict() for r in docs.collect()]
    ids = {k: [r["doc_id"] for r in v] for k, v in seen.items()}
    assert set(range(150)) | {2000, 2001, 2004, None} <= set(ids["toxicity"]) and len([i for i in ids["toxicity"] if i and 1000 <= i < 1060]) < 3
    assert not {2001, 2002, 2003, 3000, 3100} & set(ids["quality"])
    prints = [fingerprint((r["text"] or "").encode()) % (1 << 64) for r in seen["quality"]]
    apart = np.bitwise_count(np.array(prints, dtype=np.uint64)[:, None] ^ np.array(prints, dtype=np.uint64)[None, :]) <= 4
    label = np.arange(len(prints))
    for _ in prints:
        label = np.array([label[row].min() for row in apart])
    assert len(seen["simhash"]) == len(set(label.tolist()))
    assert ids["simhash"].count(3) == 1 and 2000 not in ids["simhash"]
    text = {r["doc_id"]: r for r in seen["pii"]}[2004]
    assert "[EMAIL]" in text["text"] and "[PHONE]" in text["text"] and "@" not in text["text"] and text["n_chars"] == len(text["text"])
    assert sorted(ids["pii"], key=str) == sorted(ids["simhash"], key=str)


def test_run_packs_what_is_left(spark, folder):
    from tokenizers import Tokenizer

    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} >= {0, 1, 2, 2004} and not {2001, 2002, 3100} & {r.doc_id for r in got}
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    one = next(r for r in got if r.doc_id == 5)
    assert np.frombuffer(one.ids, "<u4").tolist() == tokenizer.encode(CLEAN(35, 65, 145), add_special_tokens=False).ids + [0]


def test_without_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
