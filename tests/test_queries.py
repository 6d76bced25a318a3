"""Every registered query against its SQL equivalent, value by value."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, mismatch
from kinweave.plans.registry import registered

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registered(), entry.oracle_sql()

@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert not set(QUERIES) - set(ORACLES)
    assert set(ORACLES) <= set(entry.queries())


def murmur3(data: bytes, seed: int = 42) -> int:
    """Spark's ``hash`` of a string: Murmur3 in which each byte after the last whole word is a word with its sign."""
    turn = lambda x, n: (x << n | x >> 32 - n) & 0xFFFFFFFF
    whole = len(data) // 4 * 4
    words = [int.from_bytes(data[i : i + 4], "little") for i in range(0, whole, 4)]
    words += [(b - 256 if b > 127 else b) & 0xFFFFFFFF for b in data[whole:]]
    h = seed
    for k in words:
        k = turn(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = turn(h ^ k, 13) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def test_murmur_sample_is_a_twentieth_of_the_guests(spark):
    guests = [r.id for r in QUERIES["cohorts"](spark, SF).collect()]
    hashes = {g: murmur3(g.encode()) for g in guests}
    want = {g for g, h in hashes.items() if abs(h) % 100 < 5}
    assert any(hashes[g] < 0 for g in want) and any(hashes[g] > 0 for g in want)
    found = [r.golden_id for r in QUERIES["pass_holders_murmur"](spark, SF).collect()]
    assert sorted(found) == sorted(want)


def test_entry_is_the_segment_report(spark):
    found = entry.entry(spark)
    assert found.columns == ["segment", "cohorts", "avg_cohort_spend_gbp", "avg_spend_per_member_gbp"]
    assert found.count() == 2


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert mismatch(QUERIES[name](spark, SF), con, ORACLES[name]) is None
