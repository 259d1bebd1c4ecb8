import public_tokenizers
import pyarrow.parquet as pq
import tiktoken

import corpus_pipeline as cp
from tests.llm.test_op10_ngram_join import brute as near_brute
from tests.llm.test_op10_ngram_join import near_copies as near_rows
from tests.llm.test_op10_ngram_join import run as near_run
from tests.llm.test_op2_exact import norm
from tidemark.llm import op5_toxicity, op6_bpe
from tidemark.llm import op7_decontaminate as dc

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]


def test_rows_against_brute_force(spark):
    docs = dict(zip(*pq.read_table(f"{SF}/documents.parquet").select(["doc_id", "text"]).to_pydict().values()))
    bench = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()["text"]
    scored = op5_toxicity.classify(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    left = {r["doc_id"]: docs[r["doc_id"]] for r in scored.collect() if r["score"] < 0.7}
    groups = {}
    for i, t in left.items():
        groups.setdefault(norm(t), []).append(i)
    left = {k: left[k] for k in (min(g, key=lambda i: (-len(left[i]), i)) for g in groups.values())}
    left = {i: left[i] for i, _, first in near_brute(sorted(left.items())) if i == first}

    def contaminated(text):
        words = dc.words_of(text)
        for b in bench:
            item = dc.words_of(b)
            ids = {w: k for k, w in enumerate(dict.fromkeys(item + words))}
            if len(item) >= dc.MATCH and set(zip(*(item[k:] for k in range(5)))) & set(zip(*(words[k:] for k in range(5)))):
                tiles = dc.tile([ids[w] for w in item], [ids[w] for w in words])
                if sum(n for _, _, n in tiles) >= dc.COVERAGE * len(item):
                    return True
        return False
    left = {i: t for i, t in left.items() if not contaminated(t)}
    tok = op6_bpe.load(public_tokenizers.path(cp.TOKENS), public_tokenizers.PATTERN)
    enc = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tok.bpe.ranks, special_tokens={})
    rows = cp.run(spark, SF).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(enc.encode_ordinary(t)) for i, t in left.items()}
    assert len(rows) == len(left)


def test_each_stage_on_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count()
    kept = cp.exact_dedup(spark, odd, SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "4", "5", "6", "7", "None"]


def test_exact_stage_with_clashing_columns_and_repeated_ids(spark):
    rows = [(1, "a b", "x", 1), (1, "a b", "x", 1), (1, "ab", "y", 2), (None, "c", "z", 3), (2, "ab  ", "w", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _digest string, _id int")
    out = cp.exact_dedup(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, "c"), (2, "ab  ")]


def test_dedup_stages_with_null_and_repeated_ids(spark):
    base = " ".join(f"w{k}" for k in range(60))
    near, far = base.replace("w59", "x"), " ".join(f"v{k}" for k in range(60))
    rows = [(1, base), (None, base + " "), (None, near), (1, near.replace("w0 ", "y ")), (None, far), (1, far + " z"), (2, "alone"),
            (None, ""), (3, "alone"), (3, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    exact = sorted(cp.exact_dedup(spark, docs, "").collect(), key=str)
    assert [(r["doc_id"], r["text"]) for r in exact] == sorted(
        [r for k, r in enumerate(rows) if k not in (0, 8, 9)], key=lambda r: str(spark_row(*r)))
    kept = [(r["doc_id"], r["text"]) for r in cp.near_dedup(spark, docs, "").collect()]
    assert len(kept) == 4 and (2, "alone") in kept and (None, "") in kept and (1, far + " z") in kept
    assert sum(t.startswith(("w0", "y")) for _, t in kept) == 1


def spark_row(doc_id, text):
    from pyspark.sql import Row
    return Row(doc_id=doc_id, text=text)


def test_a_third_of_null_ids_equals_brute_force(spark):
    rows = [(None if k % 3 == 0 else i, t) for k, (i, t) in enumerate(near_rows(seed=9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_run(docs) == near_brute(rows)
    kept = cp.near_dedup(spark, docs, "").count()
    distinct = [(k, t) for k, (_, t) in enumerate(rows)]
    assert kept == len({c for _, _, c in near_brute(distinct)})
