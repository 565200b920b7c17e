"""The chain of stages against brute force, and its independence from the rest."""

from array import array

from helpers import WORD_BPE, fingerprint, groups, hit_words, without_copied_runs
from test_word_sets import alike, runs
from tokenizers import Tokenizer

import corpus_pipeline
from lapwright.llm.common import stored

SMALL = "/root/testdata/sf0.001"


def test_each_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    library = Tokenizer.from_file(WORD_BPE)
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, SMALL))
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count() and after
        if name != "bpe_encoding":
            assert docs.columns == columns
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
            wrong = [d for d in before if d in labels and (d in after) != (labels[d] == 1)]
            assert len(wrong) <= 0.05 * len(labels)
        elif name == "line_dedup":
            expected = without_copied_runs(sorted(before.items()))
            assert {d: r.text for d, r in after.items()} == {
                d: t for d, t in expected.items() if t == before[d] or t.strip()
            }
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "simhash_near_dedup":
            prints = {d: fingerprint(t) for d, t in before.items()}
            sets = {d: runs(t) for d, t in before.items()}
            roots = groups(before, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4 or alike(sets[a], sets[b]))
            first = {}
            for d in before:
                first[roots[d]] = min(d, first.get(roots[d], d))
            assert set(after) == set(first.values())
        elif name == "benchmark_decontamination":
            assert set(after) == {d for d, t in before.items() if not hit_words(t, items)[1]}
        else:
            for d, r in after.items():
                ids = library.encode(before[d], add_special_tokens=False).ids
                assert list(array("I", r.ids)) == ids
                assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()} == set(after)
