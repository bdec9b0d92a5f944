"""Cross-fitted detectors: every row is predicted, none by a model that saw its IP."""

import pytest

from tollgate.operators import detectors as D

KIND = "window_start timestamp, ip string, label double, " + ", ".join(f"{c} double" for c in D.FEATURES)


def rows_of(spark, ips):
    import datetime as dt
    return spark.createDataFrame([(dt.datetime(2024, 1, 1 + d), f"10.0.0.{i}", float(i % 2), *[float(i % 2 * 50 + k + d) for k in range(7)])
                                  for i in range(ips) for d in range(2)], KIND)


@pytest.mark.parametrize("detector", [D.decision_tree, D.kmeans])
def test_every_row_has_a_prediction(spark, detector):
    rows = rows_of(spark, 40)
    got = detector(rows).collect()
    assert sorted((r.window_start, r.ip) for r in got) == sorted((r.window_start, r.ip) for r in rows.collect())
    assert all(r.prediction == r.label for r in got)
    assert {(r.ip, r.windows) for r in D.fit_rate(detector(rows)).collect()} == {(f"10.0.0.{i}", 2) for i in range(40)}


def test_folds_part_the_ips_and_nothing_to_learn_from(spark):
    rows, seen = rows_of(spark, 30), []
    for part, train in D.folds_of(rows, 3):
        own = {r.ip for r in part.collect()}
        assert not own & {r.ip for r in train.collect()}
        seen += own
    assert sorted(seen) == sorted({r.ip for r in rows.collect()})
    assert [r.prediction for r in D.kmeans(rows_of(spark, 1)).collect()] == [None, None]
