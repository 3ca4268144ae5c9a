"""Queries over whole tables, against brute force: no id, prefix or split is left out."""

from __future__ import annotations

import hashlib
import re
import time

import numpy as np
import pytest

from millrace import catalog
from millrace.operators import similarity, transport
from millrace.plans import records


@pytest.fixture
def vectors(spark, tmp_path):
    """Three labels of unequal sizes, some ids above 1,000, over several blocks."""
    r = np.random.default_rng(4)
    rows = [(i * 7, int(label), r.normal(size=8).astype(float).tolist()) for i, label in enumerate(r.choice(3, 700, p=[0.5, 0.3, 0.2]))]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    sets = {label: ([v for v, k, _ in rows if k == label], np.array([e for _, k, e in rows if k == label], np.float32).astype(float)) for label in range(3)}
    return str(tmp_path), {k: (ids, m / np.linalg.norm(m, axis=1, keepdims=True)) for k, (ids, m) in sets.items()}


def test_similarity_of_whole_sets(spark, vectors):
    folder, sets = vectors
    near = {a: sets[a][1] @ sets[a + 1][1].T for a in (0, 1)}
    got = {(r.i, r.j): r.cosine for r in catalog.QUERIES["cosine_pairs"](spark, folder).collect()}
    expected = {(i, j): near[a][x, y] for a in near for x, i in enumerate(sets[a][0]) if i % 100 == 0 for y, j in enumerate(sets[a + 1][0])}
    assert got.keys() == expected.keys() and max(abs(got[k] - expected[k]) for k in got) < 1e-6
    scores = {(r.a, r.b): r.score for r in catalog.QUERIES["selfsim_by_label"](spark, folder).collect()}
    assert scores == {(a, a + 1): pytest.approx((m.max(1).mean() + m.max(0).mean()) / 2, abs=1e-6) for a, m in near.items()}


def test_transport_of_unequal_sets(spark, vectors):
    r = np.random.default_rng(1)
    for n, m in ((1, 4), (2, 3), (4, 6), (6, 4), (7, 5), (5, 5), (70, 75)):
        cost = r.random((n, m))
        # Every member as often as the other side's size: an assignment.
        copies = np.repeat(np.repeat(cost, m, 0), n, 1) if n < 70 else np.repeat(np.repeat(cost, 15, 0), 14, 1)
        assert similarity.transport_cost(cost) == pytest.approx(similarity.assignment(copies) / len(copies))
    assert similarity.exact_transport([[1, 0]], [[1, 0], [0, 1]]) == (pytest.approx(0.5), "transport")
    folder, sets = vectors
    got = {r.label: r for r in catalog.QUERIES["emd_pairs"](spark, folder).collect()}
    assert {k: x.backend for k, x in got.items()} == {0: "transport", 1: "transport"}
    for a, x in got.items():
        assert x.score == pytest.approx(1 - similarity.transport_cost(1 - sets[a][1] @ sets[a + 1][1].T), abs=2e-6)


def test_transport_of_large_sets():
    """A thousand members a side in seconds, proved by prices: no pair's cost is below their sum, and together they are worth the cost."""
    r = np.random.default_rng(2)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (r.normal(size=(1100, 48)), r.normal(size=(1201, 48)) + 0.1))
    began = time.process_time()
    plan = transport.Plan(a, b, np.full(len(a), len(b)), np.full(len(b), len(a)))
    cost = plan.solve() / (len(a) * len(b))
    u, v = plan.price[: len(a)] / transport.SCALE, -plan.price[len(a) : -1] / transport.SCALE
    assert (1 - a @ b.T - u[:, None] - v).min() > -1e-10 and u.mean() + v.mean() == pytest.approx(cost, abs=1e-9)
    assert similarity.exact_transport(a.tolist(), b.tolist()) == (pytest.approx(1 - cost, abs=1e-9), "transport")
    # It took over a minute.
    assert time.process_time() - began < 30


def test_transport_of_odd_sets():
    r = np.random.default_rng(3)
    one, two = r.normal(size=(60, 5)), r.normal(size=(45, 5))
    hub, zero = np.repeat(one[:1], 70, 0), np.zeros((3, 5))
    sets = [one, two, one[:1], np.concatenate([one, hub]), np.concatenate([two, zero]), zero, np.round(one), -one, np.concatenate([hub, two[:40] * 1e-9])]
    # Two tight clusters, of which each side has most in another.
    far = [np.where(np.arange(80)[:, None] < share, 1, -1) * np.eye(5)[0] + 1e-6 * r.normal(size=(80, 5)) for share in (72, 8)]
    sets += far
    for a in sets:
        for b in sets:
            x, y = (np.divide(s, np.linalg.norm(s, axis=1, keepdims=True), out=np.zeros(s.shape), where=s.any(1, keepdims=True)) for s in (a, b))
            expected = similarity.transport_cost(np.clip(1 - x @ y.T, 0, 2))
            assert transport.cost(x, y) == pytest.approx(expected, abs=1e-9)


def distance(left, right):
    row = list(range(len(right) + 1))
    for i, x in enumerate(left, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(right, 1):
            last, row[j] = row[j], last if x == y else 1 + min(last, row[j], row[j - 1])
    return row[-1]


def test_edit_distance_of_whole_texts(spark, tmp_path):
    texts = [" ".join(f"w{(i * k) % 97}" for i in range(90)) for k in (1, 2, 3)] + ["same " * 45 + "end", "same " * 45 + "other {x}"]
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.item_id: r.distance for r in catalog.QUERIES["token_edit_distance"](spark, str(tmp_path)).collect()}
    split = [re.findall(r"\\[A-Za-z]+|[A-Za-z0-9_]+|[^\t\n\x0B\f\r A-Za-z0-9_]", t) for t in texts]
    assert got == {i: distance(split[i], split[i + 1]) for i in range(4)} and got[3] == 4


def test_no_token_arrays_on_the_driver(spark):
    """Small as the table is, its tokens are joined by a shuffle: no broadcast, however the size is estimated."""
    tables = "/root/testdata/sf0.001"
    for name in ("token_jaccard", "token_jaccard_documents"):
        df = catalog.QUERIES[name](spark, tables)
        assert df.count() > 0
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_every_document_has_its_ids(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else f"s{i % 3}", f"text {i}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.sample_id, r.content_hash) for r in catalog.QUERIES["stable_ids"](spark, str(tmp_path)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {i: (sha(f"{source or ''}\n{text}")[:16], sha(text)) for i, source, text in rows}


def test_last_block_of_every_record(spark):
    tables = "/root/testdata/sf0.001"
    codes = records.codes(spark, tables).collect()
    got = {r.sample_id: r.code for r in catalog.QUERIES["last_fenced_block"](spark, tables).collect()}
    assert len(got) == len(codes) and any("```" in r.code for r in codes)
    for r in codes:
        text = f"text ```latex\n{r.source} ``` more ```{r.code}```"
        blocks = re.findall(r"```(?:latex)?[\t\n\x0B\f\r ]*(.*?)```", text, re.DOTALL | re.IGNORECASE)
        assert got[r.sample_id] == blocks[-1].strip("\t\n\x0b\f\r ")
