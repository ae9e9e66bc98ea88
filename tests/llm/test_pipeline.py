"""The corpus pipeline against its stages' rules, applied one after another by brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_llm_operators import BYTES, brute_classes, brute_hits, brute_measures, rows_of, source

SECRET = "letmein" + "Q7x9" * 4
FILLER = [f"plain{i}" for i in range(60)]


def rejected(text):
    words, chars, symbols, lines, repeats, windows = brute_measures(text)
    return words < 20 or 100 * windows > 30 * words or symbols > words or lines >= 4 and 2 * repeats > lines or chars > 40 * words or chars < 2 * words


@pytest.fixture(scope="module")
def folder(spark, docs, texts, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    more = [(10_001, " ".join([*FILLER, f"password={SECRET}", *reversed(FILLER)])), (10_002, " ".join(f"{w}, a{i}" for i, w in enumerate(FILLER)))]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t), 1, "s", None, 1, 2) for i, t in more], docs.schema)
    docs.unionByName(rows).write.parquet(f"{at}/documents.parquet")
    long_ = next(t for t in texts if t and 60 < len(t.split()) < 200 and not rejected(t))
    items = [(1, " ".join(long_.split()[:40])), (3, None), (4, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    left = source(docs)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        before = len(left)
        if i == 0:
            left = [(k, t) for k, t in left if not rejected(t)]
        elif i == 1:
            classes = brute_classes(left)
            left = [(k, t) for k, t in left if k is None or classes[k] == k]
        elif i == 2:
            left = [(k, t) for k, t in left if not brute_hits(t, items)[-1]]
        else:
            left = [(k, t and t.replace(f"password={SECRET}", "password=[assign]")) for k, t in left]
            assert any("[assign]" in t for _, t in left) and not any(SECRET in t for _, t in left)
        assert Counter(source(out)) == Counter(left), name
        assert left and (len(left) < before or i == 3), name
        path = f"{folder}/stage{i}.parquet"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    library, pieces = Tokenizer.from_file(BYTES), defaultdict(list)
    for r in rows_of(corpus_pipeline.run(spark, folder)):
        pieces[r["doc_id"]].append(r)
    copies = Counter(k for k, _ in left)
    assert set(pieces) == set(copies)
    for k, t in left:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        own = sorted(pieces[k], key=lambda r: r["start"])
        assert sum(r["length"] for r in own) == len(ids) * copies[k]
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert (r["ids_crc32"], r["doc_tokens"]) == (zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))


def test_empty(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names():
    assert [re.sub(r"\W", "_", n) for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "benchmark_decontamination", "secret_scans", "harmonic_packing"]
