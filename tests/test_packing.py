"""Packing by counts of sizes against a walk from block to block."""

import random
import time
from collections import Counter

import pytest
from textloom.operators import sampling as P


def walked(blocks, cap, tolerance):
    """blocks: (block, size) -> block: (zone, indivisible)."""
    zones, out = [], {}
    for block, size in sorted(blocks, key=lambda x: (-x[1], x[0])):
        at = next((i for i, z in enumerate(zones) if z[0] + size <= cap), None)
        if at is None and size <= tolerance and zones:
            low = min(range(len(zones)), key=lambda i: zones[i][0])
            at = low if zones[low][1] or zones[low][0] + size <= cap + tolerance else None
        if at is None:
            at = len(zones)
            zones.append([0, size > cap])
        zones[at][0] += size
        out[block] = (at + 1, zones[at][1])
    return out


@pytest.mark.parametrize("seed", range(12))
def test_places(seed):
    draw = random.Random(seed)
    cap, tolerance = draw.choice([(100, 10), (7, 3), (1500, 100), (20, 0), (5, 9)])
    blocks = [(f"b{i:04d}", draw.choice([0, 1, 2, 3, draw.randint(1, cap), draw.randint(1, max(1, cap // 5)), draw.randint(cap, 2 * cap)])) for i in range(draw.randint(0, 600))]
    by_size = {}
    for block, size in sorted(blocks, key=lambda x: (-x[1], x[0])):
        by_size.setdefault(size, []).append(block)
    got = {}
    for size, first, last, zone, whole in P.packed(sorted(Counter(s for _, s in blocks).items(), reverse=True), cap, tolerance):
        for block in by_size[size][first:last]:
            assert block not in got
            got[block] = (zone, whole)
    assert got == walked(blocks, cap, tolerance)


def test_a_million_blocks_in_a_theme():
    draw = random.Random(1)
    sizes = Counter(draw.randint(1, 400) for _ in range(1_000_000))
    began = time.process_time()
    places = P.packed(sorted(sizes.items(), reverse=True), 1500, 100)
    assert time.process_time() - began < 60  # a few seconds on an idle machine
    assert sum(b - a for _, a, b, _, _ in places) == 1_000_000
    used = Counter()
    for size, a, b, zone, _ in places:
        used[zone] += size * (b - a)
    assert max(used.values()) <= 1600 and sum(used.values()) == sum(s * n for s, n in sizes.items())


def test_spark(spark):
    draw = random.Random(4)
    blocks = [(t, f"b{i:03d}", draw.choice([1, 5, 30, 60, 170])) for t in ("one", "two:x", "small") for i in range(3 if t == "small" else 200)]
    got = P.pack(spark.createDataFrame(blocks, "theme string, block string, size bigint").repartition(5), cap=150, tolerance=10).collect()
    assert len(got) == len(blocks)
    for theme in ("one", "two:x", "small"):
        want = walked([(b, s) for t, b, s in blocks if t == theme], 150, 10)
        several = max(z for z, _ in want.values()) > 1
        name = theme.replace(":", "-")
        assert {r.block: (r.zone, r.indivisible) for r in got if r.theme == theme} == {b: (f"{name}-{z}" if several else name, w) for b, (z, w) in want.items()}
