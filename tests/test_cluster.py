import random

import numpy as np
import pytest

from curbwise.operators import cluster
from test_geo import vincenty

METRE = 1 / 111032.0


def labels_of(df):
    return {(r.g, r.spot): r.cluster for r in df.collect()}


def brute(points, reach=30.0):
    """Connected components by repeated scanning."""
    out = {}
    for g in {p[0] for p in points}:
        group = sorted(p for p in points if p[0] == g)
        label = {p[1]: p[1] for p in group}
        changed = True
        while changed:
            changed = False
            for a in group:
                for b in group:
                    if vincenty(a[2], a[3], b[2], b[3]) <= reach and label[a[1]] != label[b[1]]:
                        label[a[1]] = label[b[1]] = min(label[a[1]], label[b[1]])
                        changed = True
        out |= {(g, k): v for k, v in label.items()}
    return out


def frame(spark, points):
    return spark.createDataFrame(points, "g string, spot string, lat double, lng double")


@pytest.mark.parametrize("gaps, groups", [([25, 25], 1), ([31], 2), ([29.9], 1), ([0], 1)])
def test_chained_points_join(spark, gaps, groups):
    north, points = 0.0, [("g", "p0", 39.9, 116.3)]
    for i, gap in enumerate(gaps):
        north += gap
        points.append(("g", f"p{i + 1}", 39.9 + north * METRE, 116.3))
    assert len(set(labels_of(cluster.label_points(frame(spark, points), ["g"])).values())) == groups


def test_all_paths_agree_with_brute_force(spark):
    rnd = random.Random(7)
    points = [
        (f"g{g}", f"{i:04d}", 39.9 + rnd.random() * size * METRE, 116.3 + rnd.random() * size * METRE)
        for g, (n, size) in enumerate([(1, 10), (40, 150), (60, 250), (25, 900)]) for i in range(n)
    ]
    want, df = brute(points), frame(spark, points)
    assert labels_of(cluster.label_points(df, ["g"])) == want
    assert labels_of(cluster.label_bounded(df, ["g"])) == want


def test_long_line_is_one_cluster_after_few_rounds(spark):
    points = [("g", f"{(i * 37) % 101:04d}", 39.9 + i * 25 * METRE, 116.3) for i in range(101)]
    got = labels_of(cluster.label_points(frame(spark, points), ["g"]))
    assert set(got.values()) == {"0000"} and len(got) == 101


def test_component_labels():
    a, b = np.array([4, 3, 2, 7]), np.array([3, 2, 1, 8])
    assert cluster.component_labels(9, a, b).tolist() == [0, 1, 1, 1, 1, 5, 6, 7, 7]
