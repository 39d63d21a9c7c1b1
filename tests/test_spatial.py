import math
import random

from fluxsieve.operators.spatial import nearest, snap


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_008.8 * math.asin(min(1.0, math.sqrt(h)))


def test_nearest_with_a_crowded_cell_copies_and_far_points(spark):
    rng = random.Random(5)
    crowd = [(40 + rng.random() * 1e-4, -100 + rng.random() * 1e-4) for _ in range(300)]
    dst = [(rng.uniform(-80, 80), rng.uniform(-179, 179)) for _ in range(60)] + crowd + [crowd[0]] * 40
    src = [(rng.uniform(-85, 85), rng.uniform(-179.9, 179.9)) for _ in range(50)] + crowd[:40] + [(40.00005, -100.00002)] * 30
    got = nearest(
        spark.createDataFrame([(i, *p) for i, p in enumerate(src)], "src_id int, lat double, lon double"),
        spark.createDataFrame([(i, *p) for i, p in enumerate(dst)], "idx int, lat double, lon double")).collect()
    assert len(got) == len(src)
    for r in got:
        want = min((metres(src[r["src_id"]], p), i) for i, p in enumerate(dst))
        assert abs(r["metres"] - want[0]) < 1e-6
        assert abs(metres(src[r["src_id"]], dst[r["idx"]]) - want[0]) < 1e-6


def brute_clusters(points, limit):
    label = list(range(len(points)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(points):
        for j in range(i):
            if metres(a, points[j]) <= limit:
                a_, b_ = find(i), find(j)
                label[max(a_, b_)] = min(a_, b_)
    return [find(i) for i in range(len(points))]


def test_snap_equals_single_linkage(spark):
    rng = random.Random(9)
    points = [(48 + rng.random() * 0.02, 9 + rng.random() * 0.03) for _ in range(120)]
    points += [(48.03 + rng.random() * 1e-5, 9.05 + rng.random() * 1e-5) for _ in range(80)]   # one dense spot
    points += [(48.0309, 9.05 + i * 0.0012) for i in range(20)] + [points[3]] * 25
    for limit in (100.0, 250.0):
        got = snap(spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lat double, lon double"), limit)
        assert {r["id"]: r["cluster"] for r in got.collect()} == dict(enumerate(brute_clusters(points, limit)))
