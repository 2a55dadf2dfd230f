import math
import random

import pytest
from pyspark.sql import functions as F

from perplexis.operators import evaluation as E
from perplexis.operators import running
from perplexis.operators.running import row_numbers, running_totals


def table(spark, rows):
    return spark.createDataFrame(rows, "score double, class int").withColumn(
        "pred", F.when(F.col("score") < 0.9, 1).otherwise(0)
    )


def made(seed, n=300, digits=2):
    rng = random.Random(seed)
    return [(round(rng.gauss(0.85 if c else 1.0, 0.1), digits), c) for c in (rng.randint(0, 1) for _ in range(n))]


def curve(rows):
    """Points of the curve by definition: counts at or below each score."""
    p, n = sum(c for _, c in rows), sum(1 - c for _, c in rows)
    points = [(math.inf, 0, 0)]
    for s in sorted({s for s, _ in rows}):
        points.append((-s, sum(1 - c for x, c in rows if x <= s), sum(c for x, c in rows if x <= s)))
    return [(t, fp, tp, fp / n, tp / p) for t, fp, tp in points]


def interp(x, points):
    last = max(i for i, p in enumerate(points) if p[3] <= x)
    if last == len(points) - 1:
        return points[last][4]
    (_, _, _, x0, y0), (_, _, _, x1, y1) = points[last], points[last + 1]
    return y0 + (y1 - y0) * (x - x0) / (x1 - x0)


@pytest.mark.parametrize("seed,digits", [(1, 2), (2, 1), (3, 6)])
def test_curve_areas_and_readings(spark, seed, digits):
    rows = made(seed, digits=digits)
    cumulative = E.cumulative_counts(table(spark, rows + [(math.nan, 1), (None, 0)]))
    points = curve(rows)
    got = sorted((tuple(r) for r in E.roc_curve(cumulative).collect()), key=lambda r: -r[0])
    assert got == points

    auc = sum((b[3] - a[3]) * (b[4] + a[4]) / 2 for a, b in zip(points, points[1:]))
    assert E.roc_auc(cumulative).first().auc == pytest.approx(auc)
    assert E.roc_auc_rank(cumulative).first().auc == pytest.approx(auc)

    for r in E.roc_log_grid(cumulative).collect():
        assert r.tpr == pytest.approx(interp(r.fpr, points)), r.fpr
    assert E.tpr_at_fpr(cumulative).first().tpr == pytest.approx(interp(1e-4, points))


@pytest.mark.parametrize("seed,digits", [(4, 2), (5, 1)])
def test_thin_curve_keeps_the_shape(spark, seed, digits):
    rows = made(seed, digits=digits) + [(2.0 + i / 10, 0) for i in range(20)]
    cumulative = E.cumulative_counts(table(spark, rows))
    points = curve(rows)
    thin = sorted((tuple(r) for r in E.roc_curve_thin(cumulative).collect()), key=lambda r: -r[0])
    body = points[1:]
    expected = [points[0]] + [
        p for i, p in enumerate(body)
        if i in (0, len(body) - 1) or any(
            body[i + 1][k] - p[k] != p[k] - body[i - 1][k] for k in (1, 2)
        )
    ]
    assert thin == expected and len(thin) < len(points)
    area = lambda ps: sum((b[3] - a[3]) * (b[4] + a[4]) / 2 for a, b in zip(ps, ps[1:]))
    assert area(thin) == pytest.approx(area(points))
    assert interp(1e-4, thin) == pytest.approx(interp(1e-4, points))


def test_confusion_and_f1(spark):
    rows = [(0.5, 1), (0.6, 1), (0.95, 1), (0.5, 0), (1.2, 0), (math.nan, 1)]
    t = table(spark, rows)
    assert {(r["class"], r.pred): r.n for r in E.confusion(t).collect()} == {(1, 1): 2, (1, 0): 2, (0, 1): 1, (0, 0): 1}
    row = E.f1(t).first()
    assert row.f1 == pytest.approx(4 / 7) and row.n == 6 and row.n_missing == 1
    assert E.f1(table(spark, [(1.0, 0)])).first().f1 == 0


def test_metrics_row(spark):
    rows = made(7)
    t = table(spark, rows)
    cumulative = E.cumulative_counts(t)
    row = E.evaluation_metrics(t, cumulative).first()
    assert row.n == len(rows) and row.n_missing == 0
    assert row.f1 == E.f1(t).first().f1
    assert row.auc == E.roc_auc(cumulative).first().auc
    assert row.tpr_at_fpr == E.tpr_at_fpr(cumulative).first().tpr


def test_calibration(spark):
    rows = made(8, n=120)
    cumulative = E.cumulative_counts(table(spark, rows))
    candidates = sorted({s for s, _ in rows}) + [math.inf]
    n = sum(1 - c for _, c in rows)

    def f1(t):
        tp = sum(c for s, c in rows if s < t)
        fp = sum(1 - c for s, c in rows if s < t)
        return 2 * tp / (tp + fp + sum(c for _, c in rows))

    best = max(candidates, key=lambda t: (f1(t), -t))
    got = E.calibrate_f1(cumulative).first()
    assert got.threshold == best and got.f1 == pytest.approx(f1(best))
    for limit in (1e-4, 0.1, 1.0):
        rate = lambda t: sum(1 - c for s, c in rows if s < t) / n
        got = E.calibrate_fpr(cumulative, limit).first()
        assert got.threshold == max(t for t in candidates if rate(t) <= limit)
        assert got.n_human == n and got.fpr == pytest.approx(rate(got.threshold))


def test_empty_and_one_sided_tables(spark):
    for rows in ([], [(0.5, 1), (0.7, 1)]):
        cumulative = E.cumulative_counts(table(spark, rows))
        assert math.isnan(E.roc_auc(cumulative).first().auc or math.nan)


@pytest.mark.parametrize(("rows", "blocks"), [(1000, 1024), (100, 1024), (7, 1024), (3, 4)])
def test_running_totals_do_not_depend_on_ranges(spark, monkeypatch, rows, blocks):
    monkeypatch.setattr(running, "RANGES_PER_BLOCK", blocks)
    rng = random.Random(1)
    values = [(i % 3, rng.choice([math.inf, -2.0, 0.0, 1.5, 7.25, rng.random()]), i) for i in range(200)]
    df = spark.createDataFrame(values, "g int, x double, i int")
    got = running_totals(df, ["x", "i"], {"t": F.col("i")}, by=["g"], rows=rows).collect()
    assert len(got) == 200
    for r in got:
        assert r.t == sum(i for g, x, i in values if g == r.g and (x, i) <= (r.x, r.i))
    numbers = sorted(r.row_number for r in row_numbers(df, ["x", "i"], rows=rows).collect())
    assert numbers == list(range(1, 201))


def test_ranges_follow_the_rows_and_split_ties(spark, tmp_path):
    spark.range(1000).selectExpr("CAST(IF(id % 3 = 0, 5, id) AS DOUBLE) AS x", "id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    ranged, ranges = running.with_ranges(df, ["x"], rows=100)
    sizes = [r["count"] for r in ranged.groupBy("range_id").count().collect()]
    assert ranges == 10 and sum(sizes) == 1000 and max(sizes) < 250
    assert running.with_ranges(df, ["x"])[1] == 1
    numbers = row_numbers(df, ["x"], rows=100).collect()
    assert sorted(r.row_number for r in numbers) == list(range(1, 1001))
    assert all(a.x <= b.x for a, b in zip(*[sorted(numbers, key=lambda r: r.row_number)[i:] for i in (0, 1)]))
