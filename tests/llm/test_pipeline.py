from collections import Counter

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from hirelake.llm import mixing, simhash
from hirelake.llm.tokens import _tokenizer, vocabulary

from .conftest import FOLDER, LONG, ODD


def test_registration():
    queries = entry.queries()
    for n in range(1, 14):
        assert len([q for q in queries if q.startswith(f"op{n}_")]) == 1
    assert queries["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "simhash_near_dedup", "mixing", "packing"]
    assert set(entry.oracle_sql()) <= set(queries)


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_follow_their_operators(spark, given):
    docs = given("documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == columns and not as_rows(kept) - as_rows(docs)
    stages = dict(corpus_pipeline.STAGES)
    deduped = stages["simhash_near_dedup"](spark, docs, FOLDER)
    groups = simhash.near_duplicate_groups(docs, width=4, apart=4)
    assert sorted(r["doc_id"] for r in deduped.collect()) == sorted({r["component_id"] for r in groups.collect()})
    mixed = stages["mixing"](spark, docs, FOLDER)
    taken = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    times = Counter(r["doc_id"] for r in mixed.collect())
    for number, plan in taken.items():
        assert times[number] == (plan["epochs"] if plan["size"] else times[number]) + (plan["part_words"] > 0)
    assert mixed.columns == columns


def test_whole_pipeline(spark):
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    lengths = Counter()
    for p in pieces:
        lengths[p["sequence_id"]] += len(p["ids"]) // 4
    assert pieces and all(n & (n - 1) == 0 and n <= 4096 for n in lengths.values())


def test_stages_on_odd_documents(spark, odd, none, clashing):
    for docs in (odd, clashing, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, docs, FOLDER)
            assert result.columns == docs.columns
            result.count()
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
        if docs is not none:
            whole = [p for p in pieces if p["doc_id"] == 7]
            ids = b"".join(p["ids"] for p in sorted(whole, key=lambda p: p["start"]))
            wanted = _tokenizer(vocabulary("word_bpe_49k.json")).encode(LONG, add_special_tokens=False).ids + [2]
            assert np.frombuffer(ids, "<u4").tolist() == wanted
            assert {p["doc_id"] for p in pieces} == {r[0] for r in ODD}
