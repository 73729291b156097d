"""Learned scores: held-out accuracy, exact matching against brute force, and odd inputs."""

import random
import zlib

import numpy as np
import pytest

from fundlens.llm import fit, langid, quality, toxicity
from fundlens.llm.common import table

SF = "/root/testdata/sf0.01"
ODD = [(None, "plain words here"), (10**9 + 1, None), (10**9 + 2, ""), (10**9 + 3, "12 34 ² Ⅷ ½ !!"), (10**9 + 4, "word " * 60_000),
       (10**9 + 5, "plain words"), (10**9 + 5, "plain words")]


def with_odd(spark, docs):
    extra = spark.createDataFrame([(i, t, None, "s", 0) for i, t in ODD], docs.schema)
    return docs.unionByName(extra).selectExpr("*", "1 AS score", "'x' AS y")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_automaton_finds_exactly_the_terms_within_their_edits():
    rng = random.Random(2)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(3, 12))): rng.random() for _ in range(40)}
    m = toxicity.Matcher(words, {})
    for _ in range(4000):
        if rng.random() < 0.5:
            w = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 13)))
        else:
            w = list(rng.choice(sorted(words)))
            for _ in range(rng.randrange(0, 4)):
                i = rng.randrange(len(w) + 1)
                w[i:i + rng.randrange(0, 2)] = rng.choice(["", "a", "d"])
            w = "".join(w)
        near = [(edits(w, t), -words[t]) for t in words if edits(w, t) <= toxicity.edits_allowed(t)]
        got = m.lookup(w)
        assert (got is None) == (not near), w
        if near:
            assert got == (-min(near)[1], min(near)[0])


def test_stems_and_look_alikes():
    m = toxicity.Matcher({"pathetic": 3.0}, {"vile": 2.0}, frozenset(["pathetix"]))
    assert m.lookup("vilest") == (2.0, 0) and m.lookup("vil") is None
    assert m.lookup("pathettic") == (3.0, 1) and m.lookup("pathetix") is None


def test_quotation_weighs_less_than_abuse():
    m = toxicity.Matcher({"idiot": 4.0}, {})
    plain = toxicity.features("and you are an idiot for it", m)
    told = toxicity.features('the word "idiot" was said in the report', m)
    assert plain[0] > told[0] and told[5] == 1.0 and plain[6] == 1.0
    assert toxicity.features("", m) == [0.0] * toxicity.FEATURES


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable")) + 1
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@pytest.mark.parametrize("name,run,label,least", [("toxic", toxicity.toxicity, "toxic", 0.85),
                                                   ("quality", quality.quality, "quality", 0.9)])
def test_held_out_accuracy_and_odd_rows(spark, name, run, label, least):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = run(with_odd(spark, docs), labels).toPandas()
    assert len(got) == docs.count() + len(ODD) and got.score.between(0, 1).all()
    assert got.columns.tolist() == ["doc_id", "held_out", "score", "predicted"]
    assert all(h == (i == i and zlib.crc32(str(int(i)).encode()) % 5 == 0) for i, h in zip(got.doc_id, got.held_out))
    truth = got.merge(labels.toPandas(), on="doc_id")
    truth = truth[truth.held_out]
    assert auc(truth.score.to_numpy(), truth[label].to_numpy()) >= least


@pytest.mark.parametrize("run,none_known", [(toxicity.toxicity, 0.25), (quality.quality, 0.5)])
def test_scores_without_rows_or_labels(spark, run, none_known):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert run(none, labels).count() == 0
    assert {round(r["score"], 9) for r in run(docs, labels).collect()} == {none_known}
    one = spark.createDataFrame([(1, 1, 1), (2, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert run(docs, one).count() == 2


def test_language_held_out_accuracy_and_odd_rows(spark):
    docs = table(spark, SF, "documents")
    got = langid.identify(with_odd(spark, docs)).toPandas()
    assert len(got) == docs.count() + len(ODD) and got.score.between(0, 1).all()
    truth = got.merge(docs.toPandas()[["doc_id", "lang"]], on="doc_id")
    assert (truth.lang_pred == truth.lang)[truth.held_out].mean() > 0.98
    odd = got[got.doc_id.isin([10**9 + 1, 10**9 + 2, 10**9 + 3])]
    assert set(odd.lang_pred) == {"und"}


def test_language_models_are_distributions():
    import pyarrow as pa
    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(["q"] * 60), pa.array(words), pa.array([1] * 60, pa.int64())], names=["lang", "word", "n"])
    rows = pa.concat_tables([pa.Table.from_batches([b]) for b in langid._count_grams(3, 40)(iter([batch]))]).to_pandas()
    rows = rows.groupby(["lang", "n", "gram", "context", "longer"], as_index=False)["count"].sum()
    rows["count"] = np.where(rows.n == 3, rows["count"], 1)
    rows = rows.groupby(["lang", "n", "gram", "context"], as_index=False)["count"].sum()
    m = langid.Model.build(pa.Table.from_pandas(rows), 3, 40)
    for n, (grams, p, ctxs, back) in enumerate(m.tables, 1):
        by = rows[rows.n == n].set_index("gram")
        mass = {}
        for g, v in zip(grams, p[:, 0]):
            c = int(by.loc[int(g)]["context"])
            mass[c] = mass.get(c, 0) + float(v)
        for c, b in zip(ctxs, back[:, 0]):
            assert mass[int(c)] + float(b) == pytest.approx(1, abs=1e-5)


def test_language_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.identify(none).count() == 0
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(docs).collect()] == [("und", 0.0)] * 2


def test_logistic_recovers_a_rate():
    x, y = np.zeros((100, 1)), np.array([1] * 20 + [0] * 80)
    assert fit.probability(x[:1], fit.logistic(x, y, np.ones(100)))[0] == pytest.approx(0.2, abs=0.01)
