"""Rank statistic and isotonic calibration against brute force."""

import random

import pytest

from quarry.operators import calibration


def rows(seed, n=400, levels=25):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        s = rng.randrange(levels) / levels
        out.append((s, int(rng.random() < s)))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "score double, label int")


def pairs_won(data):
    pos, neg = [s for s, y in data if y == 1], [s for s, y in data if y == 0]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels, parts", [(3, 1), (25, 4), (10_000, 7)])
def test_auc_equals_all_pairs(spark, levels, parts):
    data = rows(levels, levels=levels)
    dirty = data + [(None, 1), (float("nan"), 0), (0.5, None), (0.5, 7)]
    got = calibration.auc(frame(spark, dirty).repartition(5), n_parts=parts).first()
    assert got.auc == pytest.approx(pairs_won(data), abs=1e-12) and got.n_pos + got.n_neg == len(data)


def test_one_label_or_nothing(spark):
    assert calibration.auc(frame(spark, [(0.1, 1)])).first().auc is None
    assert tuple(calibration.auc(frame(spark, [])).first()) == (0, 0, None)


def test_no_task_orders_all_scores(spark):
    plan = calibration.auc(frame(spark, rows(1)))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in line]
    assert all("_v_under" not in line or "_pid" in line.split("windowspecdefinition(")[1] for line in windows)


def test_confusion_cells(spark):
    data = rows(2)
    for r in calibration.confusion(frame(spark, data), [0.0, 0.4, 0.41, 2.0]).collect():
        yes = [(s >= r.threshold, y) for s, y in data]
        assert (r.tp, r.fp, r.tn, r.fn) == (yes.count((True, 1)), yes.count((True, 0)), yes.count((False, 0)), yes.count((False, 1)))


def pooled(data):
    """Pool adjacent violators over the sums by score."""
    blocks = []
    for s in sorted({s for s, _ in data}):
        own = [y for t, y in data if t == s]
        blocks.append([sum(own), len(own), [s]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a, n, xs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a, blocks[-1][1] + n, blocks[-1][2] + xs]
    return {x: a / n for a, n, xs in blocks for x in xs}


@pytest.mark.parametrize("levels", [8, 300])
def test_calibration_is_the_nearest_monotone_function(spark, levels):
    data = rows(levels, n=3000, levels=levels)
    model = calibration.calibrate(frame(spark, data).repartition(6))
    want = pooled(data)
    asked = spark.createDataFrame([(s, None) for s in want] + [(-1.0, None), (9.0, None), (None, None)], "score double, label int")
    got = {r.score: r.probability for r in calibration.calibrated(asked, model).collect()}
    assert all(got[s] == pytest.approx(p, abs=1e-9) for s, p in want.items())
    assert got[-1.0] == pytest.approx(min(want.values())) and got[9.0] == pytest.approx(max(want.values())) and got[None] is None
    for r in calibration.reliability(calibration.calibrated(frame(spark, data), model), "probability").collect():
        assert r.mean_probability == pytest.approx(r.share_good, abs=1e-6)


def test_classifier_separates_what_differs(spark):
    """Every document is scored, the kept ones by the threshold; the cells of the held-out fold add up to its rows."""
    from quarry.operators import classifier

    rng = random.Random(4)
    good, bad = ["river", "garden", "letter", "morning", "teacher"], ["zzq", "xxk", "click", "buy", "promo"]
    texts = [" ".join(rng.choices(good if i % 2 else bad, k=30)) for i in range(120)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120) if i % 3] + [(5000, 1), (3, None)], "doc_id long, quality int")
    scored = {r.doc_id: r for r in classifier.quality_classifier(docs, labels, threshold=0.6).collect()}
    assert len(scored) == len(texts) and all(r.kept == (r.p_quality >= 0.6) for r in scored.values())
    assert all(scored[i].kept == bool(i % 2) for i in range(120))
    held = classifier.quality_holdout(docs, labels).first()
    assert held.auc == 1.0 and held.n == held.tp + held.fp + held.tn + held.fn and (held.fp, held.fn) == (0, 0) and held.n > 5
