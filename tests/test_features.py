"""Similarities of many pairs at once, and how candidate pairs are dealt to tasks."""

import random

import numpy as np
import pytest

from tessera.functions import similarity as S
from tessera.operators.features import feature_matrix
from tessera.plans import queries as Q

SMALL = "/root/testdata/sf0.001"


def texts(n: int) -> list[str]:
    rnd = random.Random(5)
    words = "lavender spring brand 13 promo corporation http page é 漢字 \U0001f600 ÿ".split()
    some = ["", "", "x", "ab", "x" * 4_100, "ab" * 150]
    return some + [" ".join(rnd.choices(words, k=rnd.randint(1, 12))) if k % 4 else "".join(rnd.choices("ab é", k=rnd.randint(0, 9))) for k in range(n)]


@pytest.mark.parametrize("one", ["indel_ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio", "jaro_winkler"])
def test_many_pairs_as_one_by_one(one):
    a = texts(400)
    b = a[1:] + a[:1]
    assert getattr(S, f"{one}s")(a, b).tolist() == [getattr(S, one)(x, y) for x, y in zip(a, b)]
    assert getattr(S, f"{one}s")([], []).tolist() == []


def test_groups_stay_small():
    a, b = ["a"] * 100 + ["ab" * 900] * 200, ["b" * 3_000] * 300
    groups = list(S._groups(a, b))
    assert sorted(k for g in groups for k in g) == list(range(300))
    assert all(len(g) * (max(len(a[k]) for k in g) + max(len(b[k]) for k in g)) <= 16 * S.STEP for g in groups)


def test_jaro_winkler_by_brute_force():
    def brute(a, b):
        reach, used, left = max(0, max(len(a), len(b)) // 2 - 1), set(), []
        for i, c in enumerate(a):
            for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
                if j not in used and b[j] == c:
                    used.add(j)
                    left.append(c)
                    break
        m = len(left)
        if not m:
            return 0.0
        swaps = sum(x != b[j] for x, j in zip(left, sorted(used))) // 2
        jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
        same = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
        return jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro

    a = [x for x in texts(300) if x and len(x) < 400]
    b = a[3:] + a[:3]
    assert np.array_equal(S.jaro_winklers(a, b), [brute(x, y) for x, y in zip(a, b)])


def test_pairs_are_dealt_to_all_cores(spark):
    s1, t = Q.sides(spark, SMALL)
    pairs = Q.pairs(spark, SMALL)
    out = feature_matrix(pairs, s1, t)
    assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert out.count() == pairs.count()


@pytest.mark.parametrize("name", ["M7", "M8"])
def test_matching_blocks_once(spark, monkeypatch, name):
    calls, known = [], Q.pairs
    monkeypatch.setattr(Q, "pairs", lambda *a: calls.append(a) or known(*a))
    monkeypatch.setattr(Q, "TREES", Q.SMALL)
    found = Q.SPARK[name](spark, SMALL)
    assert found.columns == ["s1_id", "target_id", "probability"]
    assert len(calls) == 1
    assert found.where(f"probability < {0.5 if name == 'M7' else 0.7}").count() == 0
