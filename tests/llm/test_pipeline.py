"""The pipeline's stages on the smallest tables, each against a plain version on its own input."""
import hashlib
import math
from collections import Counter

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as C
from hostlake.llm import bpe, queries, rule_ensemble
from hostlake.llm.common import row_key
from tests.llm import test_fuzzy_lines as lines
from tests.llm import test_mixing as mixing
from tests.llm import test_simhash_golay as simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(C.STAGES)
    good = stage["quality classifier"](spark, docs, SF).cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    verdicts = rule_ensemble.classify(docs, labels)
    want = {r.doc_id for r in verdicts.where("predicted = 1").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == want
    clean = labels.where("quality = 1").join(good, "doc_id", "left_anti").count()
    assert clean <= 0.03 * labels.count()

    flat = stage["line dedup"](spark, good, SF).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    lines.KEY.update({(r.doc_id, r.text): r.k for r in good.withColumn("k", row_key(F.col("doc_id"), F.col("text"))).collect()})
    assert flat.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in flat.collect()), key=repr) == lines.brute(rows)
    assert all(r.n_chars == len(r.text) for r in flat.collect())

    single = stage["simhash near-dedup"](spark, flat, SF).cache()
    groups = simhash.slow_components([(r.doc_id, r.text) for r in flat.collect()])
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in groups})

    mixed = stage["source mixing"](spark, single, SF).cache()
    n = Counter(r.source if r.source in queries.MIX else None for r in single.collect())
    share = sum(queries.MIX.values()) + queries.MIX_OTHER
    rate = {s: queries.MIX.get(s, queries.MIX_OTHER) / share * sum(n.values()) / k for s, k in n.items()}
    want = {r.doc_id: mixing.slow_copies(queries.MIX_SEED, r.doc_id, rate[r.source if r.source in queries.MIX else None])
            for r in single.collect()}
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == Counter({d: c for d, c in want.items() if c})
    assert math.isclose(share, 1.0)

    path = P.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.Vocabulary.load(path).ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in mixed.collect()}
    final = stage["byte-level bpe"](spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in final) == Counter(r.doc_id for r in mixed.collect())
    for r in final:
        assert r.ids == library.encode_ordinary(texts[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_applies_all_stages(spark):
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert 0 < out.count() < 2 * spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages_take_nulls_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900_000, "", "en", "src0", 0), (900_001, "", None, None, 0),
                                 (900_002, "a b c d e f g\na b c d e f g", "en", "src1", 27)], docs.schema)
    for table in (odd, docs.limit(0)):
        rows = table
        for name, stage in C.STAGES:
            rows = stage(spark, rows, SF)
            assert rows.columns == docs.columns or name == "byte-level bpe"
        rows.collect()
