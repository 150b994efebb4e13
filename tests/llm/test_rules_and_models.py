"""Quality rules, quality classifier, mixing and sharding."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, difference

from tripmart.llm import mixing, quality_model, quality_rules, queries, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    body = text or ""
    words, seen, covered = WORD.findall(body), defaultdict(list), set()
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                covered.update(range(i, i + 8))
    lines = [x for x in body.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in body)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_against_plain_code(documents, awkward):
    repeats = "a b c d e f g h i\nx\nx\na b c d e f g h i\n" + "w " * 20
    for docs in (documents, awkward, documents.sparkSession.createDataFrame([(1, repeats), (2, "l\r\nl\r\nl")], "doc_id long, text string")):
        for r in quality_rules.judge(docs).collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(r.text)
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert r.kept == (not r.failed) and (r.kept <= (not r.base_failed))


def test_rules_keep_other_columns_and_can_be_filtered(awkward, nothing):
    judged = quality_rules.judge(awkward)
    assert set(awkward.columns) <= set(judged.columns) and len(judged.columns) == len(set(judged.columns))
    assert judged.where("kept").count() == sum(r.kept for r in judged.collect())
    assert quality_rules.judge(nothing).count() == 0


def test_rules_run_no_python(documents, plan):
    text = plan(quality_rules.judge(documents))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_rules_keep_good_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(labels, "doc_id")
    judged = quality_rules.judge(docs)
    assert judged.where("not base_failed and not kept").count() == 0


@pytest.mark.parametrize("name", ["op1_quality_rules", "op7_minhash_near_dedup", "op8_warc", "op9_suffix_dedup"])
def test_query_against_its_sql(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLE[name]) is None


# ------------------------------------------------------------------ classifier


def test_classifier_is_right_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op5_quality_classifier(spark, folder).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and sum(a == b for a, b in judged) / len(judged) > 0.97


def test_features_do_not_read_labels_of_held_out_rows(spark, documents):
    ids = [r.doc_id for r in documents.collect()]
    held = [i for i in ids if zlib.crc32(str(i).encode()) % 5 == 0]
    base = [(i, i % 2) for i in ids if i not in held]
    frames = [spark.createDataFrame(base + [(i, q) for i in held], "doc_id long, quality int") for q in (0, 1)]
    scores = [sorted(quality_model.classify(documents, f, keep=["doc_id"]).collect()) for f in frames]
    assert scores[0] == scores[1]


def test_model_is_the_quadratic_discriminant(spark):
    rng = np.random.default_rng(0)
    width = quality_model.FEATURES
    x = rng.normal(size=(300, width)) * np.linspace(0.5, 2, width)
    y = (np.arange(300) % 3 > 0).astype(int)
    x[y == 1] += 0.5
    frame = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y, strict=True)], "_features array<double>, y int")
    model = quality_model.fit(frame.repartition(5), "y")
    covs = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum(c * n for c, n in zip(covs, (100, 200), strict=True)) / 300
    logs = []
    for c in (0, 1):
        cov = 0.9 * covs[c] + 0.1 * np.diag(np.diag(pooled)) + 1e-9 * np.eye(width)
        d = x - x[y == c].mean(0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1]))
    odds = np.log(201 / 101) + logs[1] - logs[0]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-odds)))


def test_classifier_on_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 0), (None, 1), (6, 7)], "doc_id long, quality int")
    rows = quality_model.classify(awkward, labels)
    assert rows.count() == awkward.count() and all(0 <= r.score <= 1 for r in rows.collect())
    assert set(awkward.columns) <= set(rows.columns)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_model.classify(awkward, none, keep=["doc_id"]).collect()} == {0.5}
    assert quality_model.classify(nothing, labels).count() == 0


# ------------------------------------------------------------------ sharding


def test_shards_are_balanced_and_groups_whole(documents):
    rows = sharding.assign(documents, 16).collect()
    total, where = Counter(), defaultdict(set)
    slots = defaultdict(list)
    for r in rows:
        assert r.size == len(r.text.encode()) + 1
        total[r.shard] += r.size
        where[r.text].add(r.shard)
        slots[r.shard].append(r.slot)
    assert max(map(len, where.values())) == 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) - min(total.values()) <= 0.001 * sum(total.values())


def test_differencing_beats_greedy_and_loses_nothing():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 10_000) for _ in range(400)]
    shard = sharding.differenced(sizes, 7)
    sums = [sum(s for s, k in zip(sizes, shard, strict=True) if k == j) for j in range(7)]
    greedy = [0] * 7
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    assert max(sums) - min(sums) <= max(greedy) - min(greedy)
    assert sharding.differenced([], 3) == [] and sharding.differenced([5], 3).__len__() == 1
    # the textbook case: 8, 7, 6, 5, 4 differ by 2 in two parts
    two = sharding.differenced([8, 7, 6, 5, 4], 2)
    assert abs(sum(s * (1 if k else -1) for s, k in zip([8, 7, 6, 5, 4], two, strict=True))) == 2


def test_sharding_awkward_rows(awkward, nothing):
    rows = sharding.assign(awkward, 4).collect()
    assert len(rows) == awkward.count() and len({r.shard for r in rows if r.text is None}) == 1
    assert {r.size for r in rows if not r.text} == {1}
    assert sharding.assign(nothing, 4).count() == 0


def test_a_heavy_group_is_an_item_of_its_own(spark):
    docs = spark.createDataFrame([(i, "x" * 50) for i in range(500)] + [(1000 + i, f"t{i}") for i in range(500)], "doc_id long, text string")
    rows = sharding.assign(docs, 4).collect()
    hot = {r.shard for r in rows if r.text.startswith("x")}
    assert len(hot) == 1 and not any(r.shard in hot for r in rows if r.text.startswith("t"))


# ------------------------------------------------------------------ mixing


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    out, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > 2 * sizes[s]}
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
        if not open_:
            return out


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(rows) == sorted(again)
    text = {r.doc_id: r.text for r in docs.collect()}
    sizes, taken, goal = Counter(), Counter(), {}
    for r in rows:
        assert r.size == len(WORD.findall(text[r.doc_id])) and 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        goal[r.source] = r.target
    want = plain_targets(sizes)
    for s, target in goal.items():
        assert target == pytest.approx(want[s])
        assert taken[s] == pytest.approx(target, rel=0.01)


def test_rates_are_tilted_exponentially(spark):
    docs = spark.createDataFrame([(i, "w " * n, "ab"[i % 2]) for i, n in enumerate(range(1, 201))], "doc_id long, text string, source string")
    rows = mixing.mix(docs, weights=(1, 3), share=1.0).collect()
    for source in "ab":
        own = [r for r in rows if r.source == source and r.rate < 2]
        slopes = {round(np.log(r.rate) / r.size, 9) for r in own}
        assert len(slopes) == 1
        assert sum(r.rate * r.size for r in rows if r.source == source) == pytest.approx(
            next(r.target for r in rows if r.source == source), rel=1e-5
        )


def test_mixing_awkward_rows(awkward, nothing):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count() and all(r.copies <= 1 for r in rows if r.size == 0)
    mixed = mixing.repeated(awkward)
    assert mixed.columns == awkward.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(nothing).count() == 0 and mixing.repeated(nothing).count() == 0
