"""The pipeline's stages on the smallest table, each against its own input."""

import corpus_pipeline as cp
import __spark_entry__ as entry

from fundlens.llm.common import materialise, table
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_lsh_forest import brute as near_brute

SF = "/root/testdata/sf0.001"


def test_stages_and_their_decisions(spark):
    docs = table(spark, SF, "documents")
    seen = [docs]
    for name, stage in cp.STAGES:
        seen.append(materialise(stage(spark, seen[-1], SF), "test-" + name.replace(" ", "-")))
    assert all(d.columns == docs.columns and d.schema == docs.schema for d in seen[:-1])
    rows = [{r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()} for d in seen[:-1]]
    toxic = {r["doc_id"] for r in entry.queries()["op5_toxicity"](spark, SF).where("predicted = 1").collect()}
    assert set(rows[1]) == set(rows[0]) - toxic
    assert rows[2] == {i: t for i, t, _, _ in line_brute(list(rows[1].items()))}
    assert set(rows[3]) == {i for i, (_, _, kept) in near_brute(list(rows[2].items()), 5).items() if kept}
    assert set(rows[4]) <= set(rows[3])
    assert {r["doc_id"] for r in seen[5].select("doc_id").distinct().collect()} == set(rows[4])
    want = sorted(tuple(r) for r in seen[5].select("doc_id", "start", "length", "ids_crc32").collect())
    got = sorted(tuple(r) for r in cp.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect())
    assert got == want


def test_odd_rows_pass_the_stages(spark):
    docs = table(spark, SF, "documents").limit(0)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0),
                                 (3, "x " * 30_000, None, None, None), (3, "x " * 30_000, None, None, None)], docs.schema)
    for source in (odd, docs):
        now = source
        for _, stage in cp.STAGES[:-1]:
            now = materialise(stage(spark, now, SF), "test-odd")
            assert now.count() == source.count() and now.columns == docs.columns


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert {n for n in entry.oracle_sql() if n.startswith("op")} == {"op1_maxscore_topk", "op2_line_chunks", "op11_hard_negatives"}
