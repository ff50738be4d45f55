import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from loomspan.llm import langid, mixing, packing
from loomspan.plans.scratch import Scratch
from tests.llm.test_text_operators import near_by_hand


def test_stages_against_brute_force(spark, sf_dir):
    scratch = Scratch(spark, "test")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judge = langid.Judge(langid.learn(docs), 400)
    states = [docs]
    for _, stage in corpus_pipeline.STAGES:
        states.append(scratch.keep(stage(spark, states[-1], sf_dir)))
    texts = [{r.doc_id: r for r in s.collect()} for s in states]
    want = {i for i, r in texts[0].items() if judge.predict(r.text)[0] != "und" and judge.predict(r.text)[1] >= langid.MIN_SCORE}
    assert set(texts[1]) == want and all(s.columns == docs.columns for s in states[1:-1])
    assert set(texts[2]) <= set(texts[1]) and all(r.n_chars == len(r.text) and re.search(r"\S", r.text) for r in texts[2].values())
    _, parts = near_by_hand({i: r.text for i, r in texts[2].items()}, 80)
    assert set(texts[3]) == {i for i, p in parts.items() if i == p}
    assert texts[4] == texts[3] and set(texts[5]) == set(texts[4])
    assert all(0 < r.n_tokens <= r.bucket for r in texts[5].values())
    # the mix decides the order of the packed documents: each source's documents by id, its blocks in the slots of the schedule
    by = {}
    for i, r in sorted(texts[3].items()):
        by.setdefault(r.source or "", []).append(i)
    slots = mixing.schedule(mixing.tempered({x: len(y) for x, y in by.items()}), {x: -(-len(y) // mixing.BLOCK_ROWS) for x, y in by.items()})
    order = [i for _, i in sorted(((slots[x][k // mixing.BLOCK_ROWS], k % mixing.BLOCK_ROWS), i) for x, y in by.items() for k, i in enumerate(y))]
    assert [i for _, i in sorted((r.position, i) for i, r in texts[5].items())] == order != sorted(order)
    ends = packing.boundaries(sorted(Counter(r.n_tokens for r in texts[5].values()).items()))
    for end in ends:
        inside = [texts[5][i] for i in order if min(e for e in ends if e >= texts[5][i].n_tokens) == end]
        held = max(1, packing.TOKEN_BUDGET // end)
        assert [(r.bucket, r.batch, r.batch_row) for r in inside] == [(end, k // held, k % held) for k in range(len(inside))]


def test_run_on_an_empty_table(spark, tmp_path, sf_dir):
    spark.read.parquet(f"{sf_dir}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nulls_survive_or_go_by_rule(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "source": F.lit(None).cast("string")}).unionByName(docs.limit(1).withColumns({"doc_id": F.lit(10**9).cast("long"), "text": F.lit(None).cast("string")}))
    state = docs.unionByName(odd)
    for _, stage in corpus_pipeline.STAGES:
        state = Scratch(spark, "test").keep(stage(spark, state, sf_dir))
    ids = [r.doc_id for r in state.collect()]
    assert ids.count(None) == 1 and 10**9 not in ids
