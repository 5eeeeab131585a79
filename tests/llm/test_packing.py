from itertools import combinations

from quillon.llm.packing import bucket_bounds, pack


def test_bounds_against_brute_force():
    histogram, capacity = {1: 4, 2: 3, 3: 7, 5: 2, 6: 1, 9: 5}, 10
    cost = lambda bounds: sum(n / (capacity // min(b for b in bounds if b >= s)) for s, n in histogram.items())
    sizes = sorted(histogram)
    best = min(cost((*c, sizes[-1])) for k in range(3) for c in combinations(sizes[:-1], k))
    assert abs(cost(bucket_bounds(histogram, capacity, 3)) - best) < 1e-9


def test_pack(spark):
    sizes = [(i, (i * 37) % 95 + 1) for i in range(500)] + [(900, 250), (901, 0), (902, 100), (903, None)]
    out = pack(spark.createDataFrame(sizes, "key bigint, size int"), 100).collect()
    boxes: dict = {}
    for r in out:
        boxes.setdefault(r.container_id, []).append(r.size)
    assert max(map(sum, boxes.values())) <= 100
    whole = {}
    for r in out:
        whole.setdefault(r.key, []).append((r.part, r.start, r.size))
    assert {k: sum(s for _, _, s in v) for k, v in whole.items()} == {k: s for k, s in sizes if s is not None}
    assert sorted(whole[900]) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)] and all(len(v) == 1 for k, v in whole.items() if k != 900)
    total = sum(s or 0 for _, s in sizes)
    assert len(boxes) <= 1.03 * total / 100 + 1


def test_empty(spark):
    assert pack(spark.createDataFrame([], "key bigint, size int"), 100).count() == 0


def test_the_bounds_decide(spark):
    import random
    from bisect import bisect_left
    from collections import Counter

    from quillon.llm.packing import filled, padded_containers

    rng = random.Random(3)
    sizes = sorted((min(100, int(rng.expovariate(1 / 30)) + 1) for _ in range(3000)), reverse=True)
    histogram, fills, padded = Counter(sizes), {}, {}
    for k in (1, 4, 16):
        bounds = bucket_bounds(histogram, 100, k)
        box, stage = filled(sizes, [bisect_left(bounds, s) for s in sizes], 100, bounds)
        room: Counter = Counter()
        own: dict = {}
        for b, st, s in zip(box, stage, sizes):
            room[b] += s
            own.setdefault(b, []).append((st, bisect_left(bounds, s)))
        assert max(room.values()) <= 100 and set(room) == set(range(max(box) + 1))
        # stage 1 is one bucket a container, stage 2 holds shorter buckets than it
        assert all(len({x for st, x in v if st == 1}) == 1 and all(x < min(y for st, y in v if st == 1) for st, x in v if st == 2) for v in own.values())
        fills[k], padded[k] = sum(sizes) / (len(room) * 100), padded_containers(histogram, 100, bounds)
    assert fills[1] < fills[4] <= fills[16] and fills[16] > 0.995 and padded[1] > padded[4] > padded[16]
    one, many = ({(r.key, r.container_id) for r in pack(spark.createDataFrame(list(enumerate(sizes)), "key bigint, size int"), 100, k).collect()} for k in (1, 16))
    assert one != many


def test_padding_of_the_bounds_is_least():
    from itertools import combinations

    from quillon.llm.packing import padded_containers

    histogram = {1: 4, 2: 3, 3: 7, 5: 2, 6: 1, 9: 5, 10: 2}
    sizes = sorted(histogram)
    for k in (1, 2, 3, 4):
        best = min(padded_containers(histogram, 10, [*c, 10]) for n in range(k) for c in combinations(sizes[:-1], n))
        assert abs(padded_containers(histogram, 10, bucket_bounds(histogram, 10, k)) - best) < 1e-9
