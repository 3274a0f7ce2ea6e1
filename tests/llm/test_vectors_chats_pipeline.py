"""Vector operators, chats and the pipeline against brute force."""

import base64
import math
import random

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import chat, language, lattice, stable_search
from millrace.llm.common import keep
from millrace.llm.queries import QUERIES

DDL = "vec_id long, embedding array<float>, label int, score string, node string"
UNUSABLE = [None, [], [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] * 16]


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v], 0, "s", "n") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, DDL)


def clustered(n, groups, spread, seed=0, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, size))
    return (centres[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, size))).astype(np.float32)


def check_search(rows, ids, vectors, asked, least=0.9, k=10):
    vectors, ids = np.asarray(vectors, float), np.asarray(ids)
    by, hit, total = {}, 0, 0
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) <= set(asked)
    for q in asked:
        far = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        best = [i for i in np.lexsort((ids, far))[:k] if far[i] < np.inf]
        own = sorted(by.get(q, []), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(best) + 1))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert all(abs(r.score - far[ids == r.vec_id][0]) < 1e-9 for r in own)
        hit, total = hit + len({r.vec_id for r in own} & set(ids[best].tolist())), total + len(best)
    assert hit >= least * total


def test_search_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = [r.vec_id for r in rows]
    check_search(QUERIES["op1_stable_search"](spark, SF).collect(), ids, [r.embedding for r in rows], [i for i in ids if i % 100 == 0])


def test_search_over_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(stable_search, "CELL", 150)
    monkeypatch.setattr(stable_search, "BLOCK", 20)
    vectors = clustered(1500, 30, 0.3)
    vectors[300:700] = vectors[0]  # copies
    got = stable_search.nearest(frame(spark, vectors), F.col("vec_id") % 20 == 0).collect()
    check_search(got, range(1500), vectors, range(0, 1500, 20))
    copies = [r.vec_id for r in sorted((r for r in got if r.query_id == 0), key=lambda r: r.rank)]
    assert copies == list(range(300, 310))


def test_search_odd_rows(spark):
    vectors = [*UNUSABLE, *clustered(4, 2, 0.1).tolist(), [1.0, 2.0]]
    got = stable_search.nearest(frame(spark, vectors), F.lit(True)).collect()
    check_search(got, range(6, 10), vectors[6:10], range(6, 10), least=1.0)
    assert stable_search.nearest(frame(spark, vectors).limit(0), F.lit(True)).collect() == []
    twice = stable_search.nearest(frame(spark, [vectors[6], vectors[6], vectors[7]], [1, 1, 2]), F.lit(True)).collect()
    assert sorted((r.query_id, r.vec_id) for r in twice) == [(1, 2), (2, 1)]


@pytest.mark.parametrize("offset,scale", [(0.0, 1.0), (1e5, 1.0), (1e7, 1.0), (0.0, 1e160), (0.0, 1e-170), (3e9, 1e140)])
def test_search_far_from_zero(spark, monkeypatch, offset, scale):
    """A common offset and very large or small numbers cost no neighbours."""
    monkeypatch.setattr(stable_search, "CELL", 200)
    vectors = (np.random.default_rng(4).standard_normal((800, 64)) * 0.01 + offset) * scale
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = stable_search.nearest(df, F.col("vec_id") % 20 == 0).collect()
    near = {}
    for r in got:
        near.setdefault(r.query_id, []).append(r)
    hit = 0
    for q in range(0, 800, 20):
        far = np.array([math.dist([0.0] * 64, (v / scale - vectors[q] / scale).tolist()) for v in vectors]) if scale != 1 else np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        best = set(np.argsort(far, kind="stable")[:10].tolist())
        hit += len(best & {r.vec_id for r in near[q]})
        assert all(r.score == pytest.approx(far[r.vec_id] * scale, rel=1e-9 if scale == 1 else 1e-4) for r in near[q])
    assert hit >= 0.98 * 400


def test_search_cuts_crowded_cells_into_parts(spark, monkeypatch):
    """One cell, cut into parts and blocks: the same neighbours."""
    monkeypatch.setattr(stable_search, "PART", 100 * 16)
    monkeypatch.setattr(stable_search, "BLOCK", 7)
    vectors = clustered(900, 3, 0.2, seed=9)
    check_search(stable_search.nearest(frame(spark, vectors), F.col("vec_id") % 20 == 0).collect(), range(900), vectors, range(0, 900, 20))


def test_chi_square_quantile():
    assert stable_search.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert stable_search.chi_square_quantile(0.5, 2) == pytest.approx(2 * math.log(2), abs=1e-6)


def brute_links(ids, vectors):
    units = np.array(vectors, float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    close = units @ units.T >= 0.95
    np.fill_diagonal(close, False)
    label = np.array(ids)
    while True:
        low = np.minimum(label, np.where(close, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (low == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, close.sum(axis=1), label, strict=True)}
        label = low


def test_lattice_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    expected = brute_links([r.vec_id for r in rows], [r.embedding for r in rows])
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op10_lattice_links"](spark, SF).collect()}
    assert got == expected


@pytest.mark.parametrize("block", [2048, 64])
def test_lattice_groups_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    vectors = clustered(600, 12, 0.06, size=64)
    vectors[200:400] = clustered(200, 1, 0.05, seed=5, size=64)
    vectors[400:450] = vectors[0]
    expected = brute_links(list(range(600)), vectors)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(frame(spark, vectors)).collect()}
    found, links = sum(v[0] for v in got.values()), sum(v[0] for v in expected.values())
    assert 0.995 * links <= found <= links
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in expected.items()}
    assert all(v[2] == (v[1] == k) for k, v in got.items())


def test_lattice_odd_rows(spark):
    one = clustered(1, 1, 0.1)[0]
    vectors = [*UNUSABLE, one, one * 2, one[:8], -one, one * 1e-30]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(frame(spark, vectors)).collect())
    assert got == [
        *[(i, 0, i, True) for i in range(6)], (6, 2, 6, True), (7, 2, 6, False), (8, 0, 8, True), (9, 0, 9, True), (10, 2, 6, False),
    ]
    assert lattice.near_vectors(frame(spark, vectors).limit(0)).collect() == []


def test_decoding_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    points = rng.uniform(-2, 2, (500, 8))
    home, near = lattice.decode(points), lattice.neighbours()
    assert len(near) == 240 and np.allclose((near**2).sum(axis=1), 2)
    assert (((points - home) ** 2).sum(axis=1)[:, None] <= ((points[:, None] - home[:, None] - near) ** 2).sum(axis=2) + 1e-9).all()


EVENTS = "conv_id long, seq long, turn long, place int, kind string, role string, text string"


def folded(spark, events):
    rows = chat.fold(spark.createDataFrame(events, EVENTS)).orderBy("conv_id", "turn", "place").collect()
    return [(r.conv_id, r.turn, r.role, r.text) for r in rows]


def test_fold_deltas_edits_and_regenerations(spark):
    events = [
        (1, 0, 0, 1, "message", "user", "Hi"), (1, 1, 1, 1, "delta", "assistant", "He"), (1, 2, 1, 1, "delta", None, "llo"),
        (1, 3, 2, 1, "message", "user", "Bye"), (1, 4, 1, 1, "regenerate", "assistant", None), (1, 5, 1, 1, "delta", None, "Good "),
        (1, 6, 1, 1, "delta", None, "day"), (1, 7, 2, 1, "message", "user", "And?"),
        (2, 0, 0, 1, "message", "user", "a"), (2, 1, 1, 1, "message", "assistant", "b"), (2, 2, 0, 1, "edit", None, "c"),
        (None, 0, None, 1, "message", None, None),
    ]
    random.Random(0).shuffle(events)
    assert folded(spark, events) == [
        (None, None, "", ""), (1, 0, "user", "Hi"), (1, 1, "assistant", "Good day"), (1, 2, "user", "And?"), (2, 0, "user", "c"),
    ]


def test_chats_round_trip(spark):
    texts = ["", "\\", "\\\\n", "</turn>", "<\\/turn>\n", "### user: ", "#### ###  ", "\\### Assistant: </turn> ok", "é\n\n😀", ": x", None]
    roles = ["user", "assistant", "User", "a: b", "=x", "", "tool\n", "</turn>", None, "assistant", "assistant"]
    rows = [(7, i, roles[i % len(roles)], texts[i % len(texts)]) for i in range(300)]
    rows += [(None, 0, "assistant", "x"), (8, None, "user", "y"), (8, 3, "user", "same"), (8, 3, "user", "same")]
    log = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    shown = keep(chat.format_chats(chat.log_of(log)), "chats")
    got = {r.conv_id: r for r in chat.digests(shown).collect()}
    import hashlib

    for conv in (7, 8, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(own), hashlib.sha256(told.encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {r.conv_id: r[1] for r in shown.groupBy("conv_id").agg(F.sum(F.length("formatted"))).collect()} == {k: v.formatted_chars for k, v in got.items()}
    assert chat.digests(chat.format_chats(chat.log_of(log.limit(0)))).collect() == []


def test_native_operators_have_no_python_nodes(spark):
    for name in ("op2_chat_formatting", "op5_mixing", "op6_surrogates"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name


def test_junk_and_unknown_languages_go_clean_documents_stay(spark):
    docs, rng = spark.read.parquet(f"{SF}/documents.parquet"), np.random.default_rng(11)
    junk = [rng.bytes(300).hex(), base64.b64encode(rng.bytes(300)).decode(), "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 500))]
    junk += ["все люди рождаются свободными и равными в своем достоинстве и правах", "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw"]
    rows = [(10**6 + i, t, lang, "s", len(t)) for i, t in enumerate(junk * 2) for lang in ([None, "en"][i // len(junk)],)]
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.union(spark.createDataFrame(rows, docs.schema)), SF).select("doc_id").collect()}
    assert not [i for i in kept if i >= 10**6]
    clean = docs.where(language.held_out() & F.col("text").rlike("[A-Za-z]")).collect()
    assert len(clean) > 20 and all(r.doc_id in kept for r in clean)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 ..", "en", "s", 5), (10**6 + 2, docs.first().text, "en", None, 1)], docs.schema)
    names, now = [n for n, _ in corpus_pipeline.STAGES], docs.union(extra)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, keep(stage(spark, now, SF), "stage")
        kept[name] = {r.doc_id for r in now.select("doc_id").collect()}
        assert kept[name] <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != names[-1]:
            assert now.columns == docs.columns
    assert not {10**6, 10**6 + 1} & kept["language"] and 10**6 + 2 in kept["language"]
    assert 10**6 + 2 not in kept["near copies"]
    assert kept["personal data"] == kept["near copies"] and kept["packing"] == kept["mixing"]
    assert corpus_pipeline.run(spark, SF).columns == now.columns
