"""Quality and toxicity: held-out accuracy, exactness of the index, awkward rows."""

import math
import pickle
import random
from collections import Counter

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F
from strata.llm import quality_model as q
from strata.llm import toxicity as t

SF = "/root/testdata/sf0.01"


def held_out_errors(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    rows = query(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    return rows


def test_quality_held_out(spark):
    rows = held_out_errors(spark, q.op1_quality, "quality")
    wrong = sum(r["predicted"] != r["y"] for r in rows)
    assert wrong <= 0.05 * len(rows)


def test_toxicity_held_out(spark):
    rows = held_out_errors(spark, t.op6_toxicity, "toxic")
    assert sum(r["predicted"] != r["y"] for r in rows) <= 0.12 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_additive_model_learns_steps_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(q.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = q.fit(x[:2000], y[:2000])
    assert ((model.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    assert any({a, b} == {0, 1} for a, b, *_ in model.pairs)
    # Scores are sums of table entries.
    one = model.intercept + sum(v[np.searchsorted(e, x[0, j], side="left")] for j, (e, v) in enumerate(zip(model.edges, model.tables)))
    one += sum(v[np.searchsorted(ea, x[0, a], side="left"), np.searchsorted(eb, x[0, b], side="left")] for a, b, ea, eb, v in model.pairs)
    assert np.isclose(model.margins(x[:1])[0], one)


def test_one_class_and_no_rows():
    x = np.zeros((3, len(q.FEATURES)))
    assert np.allclose(q.fit(x, np.ones(3)).scores(x), 4 / 5)
    assert np.allclose(q.fit(x[:0], np.ones(0)).scores(x), 0.5)


def index_of(rng, n=700):
    """An index of random texts, and the vectors of length 1 of these, by term."""
    words = [f"w{i}" for i in range(40)] + ["^abcdef", "^ghijkl"]
    idf = {t.hashed(w): 1 + rng.random() * 4 for w in words}
    keys = np.array(sorted(np.array(list(idf), np.uint64).view(np.int64).tolist()), np.int64)
    weights = np.array([idf[int(np.uint64(k & 0xFFFFFFFFFFFFFFFF))] for k in keys.tolist()])
    texts = [" ".join(rng.choices([*words[:40], "abcdefgh", "ghijklmn", "other"], k=rng.randint(0, 12))) for _ in range(n)]
    found = []
    for text in texts:
        k, c = t.terms(text)
        known = np.isin(k, keys)
        found.append((k[known], c[known]))
    number = np.repeat(np.arange(n, dtype=np.int32), [len(k) for k, _ in found])
    at = np.searchsorted(keys, np.concatenate([k for k, _ in found])).astype(np.int32)
    index = t.Index.of(keys, weights, number, at, np.concatenate([c for _, c in found]), [(i, rng.randrange(2), i) for i in range(n)])
    queries = [index.query(*f)[:2] for f in found]
    return index, queries, [dict(zip(a.tolist(), w.tolist())) for a, w in queries]


@pytest.mark.parametrize("common, block", [(128, 64), (3, 16), (0, 700)])
def test_nearest_equal_brute_force(monkeypatch, common, block):
    monkeypatch.setattr(t, "COMMON", common)
    monkeypatch.setattr(t, "BLOCK", block)
    rng = random.Random(1)
    index, queries, vectors = index_of(rng)
    index = pickle.loads(pickle.dumps(index))
    asked = list(range(0, 700, 7))
    for k, leave in ((1, False), (15, True), (100, False), (700, False), (900, True)):
        found = index.nearest([queries[i] for i in asked], k, asked if leave else None)
        for i, (ids, products) in zip(asked, found):
            every = sorted(
                ((round(sum(w * v.get(x, 0.0) for x, w in vectors[i].items()), 12), -j) for j, v in enumerate(vectors) if not (leave and j == i)),
                reverse=True,
            )
            best = [c for c, _ in every if c > 0][:k]
            assert np.allclose(products, best) and len(ids) == len(best)
            # Equal products go by number; they may differ in the last digit here.
            assert [-j for c, j in every if c > 0][:k] == ids.tolist() or np.isclose(np.diff(best), 0, atol=1e-11).any()


def test_few_common_weights_are_looked_up():
    """Blocks whose bound stays below the best are not completed."""
    rng = random.Random(4)
    index, queries, _ = index_of(rng, 3000)
    of = index.made()
    seen = []
    real = of["common"]

    class Watched(np.ndarray):
        def __getitem__(self, item):
            if isinstance(item, slice):
                seen.append(item.start // t.BLOCK)
            return np.asarray(super().__getitem__(item))

    of["common"] = real.view(Watched)
    one = next(q for q in queries if len(q[0]) == 1)
    index.nearest([one], 5)
    assert 0 < len(set(seen)) <= len(of["most"])


def test_votes():
    index, _, _ = index_of(random.Random(2), 10)
    index.labels = np.array([1.0, 0, 0, 1, 0, 0, 0, 0, 0, 0])
    smooth = lambda share: (share + t.PRIOR * index.plain) / (1 + t.PRIOR)
    near, products = np.arange(10).repeat(2)[:16], np.linspace(0.9, 0.15, 16)
    got = index.votes(near, products)
    toxic = index.labels[near[:15]]
    assert np.isclose(got[0], smooth(products[:15] @ toxic / products[:15].sum()))
    outer = products[:15] - products[15]
    assert np.isclose(got[1], smooth(outer @ toxic / outer.sum()))
    assert np.allclose(index.votes(near, products * 0.37), got)
    assert np.allclose(index.votes(near[:2], np.array([0.5, 0.5])), smooth(1.0))
    assert np.isclose(index.votes(near, np.full(16, 0.5))[1], smooth(toxic.mean()))


def test_scores_are_calibrated():
    rng = np.random.default_rng(3)
    y = (rng.random(800) < 0.3).astype(float)
    n = 2 * len(t.VOTERS)
    votes = rng.random((800, n))
    votes[:, 4] = np.clip(np.where(y > 0, 0.7, 0.2) + rng.normal(0, 0.1, 800), 0.01, 0.99)
    scores = t.fit_voting(votes, y).scores(votes)
    assert ((scores > 0.5) == (y > 0)).mean() > 0.95 and abs(scores.mean() - y.mean()) < 0.01
    plain = t.fit_voting(votes, np.ones(800))
    assert np.isclose(plain.scores(np.full(n, 0.25)), 0.25)


def awkward_tables(spark, tmp_path):
    rows = corpus.awkward()
    corpus.frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], i % 2 if r[0] else None, None if i % 5 else 1) for i, r in enumerate(rows)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (777777, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows


def test_awkward_rows(spark, tmp_path):
    rows = awkward_tables(spark, tmp_path)
    for query in (q.op1_quality, t.op6_toxicity):
        got = query(spark, str(tmp_path)).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] is not None for r in got)


def test_empty_tables(spark, tmp_path):
    for name, rows in (("none", []), ("some", corpus.awkward())):
        corpus.frame(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        for query in (q.op1_quality, t.op6_toxicity):
            got = query(spark, f"{tmp_path}/{name}").collect()
            assert len(got) == len(rows) and all(r["score"] == 0.5 for r in got)


def test_ids_and_labels_of_held_out_rows_do_not_matter(spark, tmp_path):
    awkward_tables(spark, tmp_path)
    scores = [sorted((str(r["doc_id"]), r["score"]) for r in q.op1_quality(spark, str(tmp_path)).collect())]
    other = tmp_path / "other"
    spark.read.parquet(f"{tmp_path}/documents.parquet").write.parquet(f"{other}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(f"{other}/labels.parquet")
    scores.append(sorted((str(r["doc_id"]), r["score"]) for r in q.op1_quality(spark, str(other)).collect()))
    assert scores[0] == scores[1]


def plain_vectors(texts):
    """TF-IDF vectors of length 1 over all words and six-letter beginnings."""
    counts = []
    for text in texts:
        found = t.WORD.findall(text.lower())
        counts.append(Counter(found + ["^" + w[: t.PREFIX] for w in found if len(w) > t.PREFIX]))
    frequency = Counter(w for c in counts for w in c)
    raw = [{w: (1 + math.log(n)) * (math.log((len(texts) + 1) / (frequency[w] + 1)) + 1) for w, n in c.items()} for c in counts]
    return [{w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()} for v in raw]


def test_toxicity_cosines_votes_and_scores(spark):
    """The whole query against plain Python: cosines of whole texts, leave-one-out votes, logistic, scores."""
    rng = random.Random(5)
    rows = [(i, corpus.prose(rng, rng.randint(1, 40)) + (" zyx" if i in (3, 200) else ""), "en", "a", 1) for i in range(250)]
    rows += [(250, "zyx", "en", "a", 1), (251, "onlyhere", "en", "a", 1), (252, "", "en", "a", 0)]
    label = {i: int(i % 4 == 3) for i in range(150)}
    labels = spark.createDataFrame(list(label.items()), "doc_id bigint, toxic int")
    docs = corpus.frame(spark, rows)
    learnt = t.toxicity_index(docs, labels, F.lit(True))
    got = {r["row"]["doc_id"]: r for r in t.score_toxicity(docs, learnt).collect()}
    vectors = plain_vectors([r[1] for r in rows])
    assert len(got) == len(rows)
    plain = (sum(label.values()) + 0.5) / 151

    def nearest(i, leave):
        """Votes do not ask for the terms that no example has: they scale all cosines of a text alike."""
        cosines = [(sum(x * vectors[j].get(w, 0.0) for w, x in vectors[i].items()), j) for j in range(150) if j != leave]
        return sorted((c for c in cosines if c[0] > 0), key=lambda c: (-c[0], c[1]))

    def votes_of(near):
        out = []
        for k in t.VOTERS:
            for outside in (0.0, near[k][0] if len(near) > k else 0.0):
                weights = [c - outside for c, _ in near[:k]]
                weights = weights if sum(weights) > 0 else [1.0] * len(near[:k])
                out.append((sum(w * label[j] for w, (_, j) in zip(weights, near)) / sum(weights) + t.PRIOR * plain) / (1 + t.PRIOR))
        return out

    taught = [i for i in range(150) if rows[i][1]]
    votes = np.array([votes_of(nearest(i, i)) if nearest(i, i) else [plain] * (2 * len(t.VOTERS)) for i in taught])
    voting = t.fit_voting(votes, np.array([label[i] for i in taught], float))
    assert np.allclose(voting.weights, learnt.voting.weights, atol=1e-6) and np.allclose(voting.means, learnt.voting.means)
    for i in range(len(rows)):
        near = nearest(i, None)
        evidence = got[i]["evidence"]
        cosines = {j: c for c, j in near}
        assert np.allclose([e["cosine"] for e in evidence], [c for c, _ in near[: t.EVIDENCE]]), i
        assert all(np.isclose(cosines[e["doc_id"]], e["cosine"]) and e["toxic"] == label[e["doc_id"]] for e in evidence)
        assert np.isclose(got[i]["score"], voting.scores(np.array(votes_of(near))) if near else plain, atol=1e-6), i
    # A word of one labelled row finds it.
    assert [e["doc_id"] for e in got[250]["evidence"]] == [3]


def test_rows_of_a_repeated_labelled_id_are_bounded_fairly(spark):
    """A labelled doc_id with very many rows takes its share, not all places; equal rows are one example."""
    rows = [(1, f"text {i} of one id", "en", "a", 1) for i in range(60)] + [(2, "same", "en", "a", 1)] * 300
    rows += [(10 + i, f"other {i}", "en", "a", 1) for i in range(60)]
    labels = spark.createDataFrame([(1, 0), (2, 1)] + [(10 + i, 1) for i in range(60)], "doc_id bigint, toxic int")
    from strata.llm.quality_model import training_rows

    every = training_rows(corpus.frame(spark, rows), labels, "toxic", F.lit(True), 1000).collect()
    assert len(every) == 121 and sum(r["doc_id"] == 2 for r in every) == 1
    some = [sorted((r["doc_id"], r["text"]) for r in training_rows(corpus.frame(spark, rows).repartition(n), labels, "toxic", F.lit(True), 40).collect()) for n in (1, 5)]
    assert len(some[0]) == 40 and some[0] == some[1]
    assert 5 < sum(d == 1 for d, _ in some[0]) < 35
