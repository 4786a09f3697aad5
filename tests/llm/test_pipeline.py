"""The pipeline's stages against brute force on a small corpus."""

import random

import corpus_pipeline
import duckdb
import pytest
import tiktoken
from asofra.llm import byte_bpe, quality, simhash


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(8)
    sound = "ka lo mi ta re su ben dor".split()
    make = lambda n: ["".join(rng.choices(sound, k=3)) for _ in range(n)]
    passage = " ".join(make(30))
    rows, labels = [], []
    for k in range(80):
        words = make(150)
        text = " ".join(words)
        if k % 5 == 0:
            text = " ".join(w.upper() + "!!" for w in words)
        elif k % 16 == 1:
            text += " " + passage
        rows.append((k, text, "en", "s", len(text)))
        labels.append((k, int(k % 5 != 0), 0))
    rows.append((100, rows[2][1], "en", "s", 1))
    words = rows[3][1].split()
    rows.append((101, " ".join([*words[:70], "other", *words[71:]]), None, None, None))
    rows.append((102, None, None, None, None))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {r[0]: r[1] for r in rows}, passage


def test_stages(spark, folder):
    path, texts, passage = folder
    docs, left, trail = spark.read.parquet(f"{path}/documents.parquet"), set(texts), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        trail.append({r.doc_id for r in out.select("doc_id").collect()})
        docs = out
    good, exact, near, clean, last = trail
    assert good >= {k for k in range(80) if k % 5} and not good & {k for k in range(80) if k % 5 == 0}
    assert good - exact == {2} and exact - near == {101}
    assert near - clean == {k for k in near if passage in (texts[k] or "")} and last == clean


def test_run(spark, folder):
    path, texts, _ = folder
    import public_tokenizers

    ranks = byte_bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = corpus_pipeline.run(spark, path).collect()
    assert rows and all(list(r.ids) == whole.encode_ordinary(texts[r.doc_id] or "") for r in rows)


def test_stage_list():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert quality.THRESHOLD == 0.7 and (simhash.COPY_WORDS, simhash.WORDS) == (5, 4)


def test_duckdb_reads_the_same_rows(folder):
    path, texts, _ = folder
    count = duckdb.execute(f"SELECT count(*) FROM read_parquet('{path}/documents.parquet/*.parquet')").fetchone()[0]
    assert count == len(texts)
