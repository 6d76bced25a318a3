import itertools
import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave import session
from kinweave.functions.similarity import jaro_winkler, jaro_winkler_batch
from kinweave.operators.resolve import blocking, clustering, comparisons, model, scoring

SCHEMA = "record_id string, " + ", ".join(f"{c} string" for c in blocking.FIELDS)
PAIR = ", ".join(f"{c}_{s} string" for s in "lr" for c in ["record_id", *blocking.FIELDS])


def random_records(spark, n=120, seed=0, hot=True):
    """Records with few distinct values, copies, nulls and one email, phone and street shared by many."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        row = [
            rnd.choice(["Robert", "Robret", "Bob", "Anna", "Ana", "花子"]),
            rnd.choice(["Smith", "Smyth", "Okoro", "佐藤"]),
            rnd.choice([None, "a@x", "a.b@x", "a@y", f"u{rnd.randrange(15)}@x"]),
            rnd.choice([None, f"44{rnd.randrange(20)}"]),
            rnd.choice([None, "AB1 2CD", "AB1 3CD", "AB2 1XX", "C1 1AA"]),
            rnd.choice([None, "1980-01-01", "1991-02-03", "1955-09-09"]),
        ]
        if hot and rnd.random() < 0.35:
            row[rnd.choice([2, 3])] = rnd.choice(["all@x", "440"])
        if hot and rnd.random() < 0.2:
            row[1], row[4] = "Smith", "AB1 2CD"
        rows.append(row)
    rows += [rows[0]] * 10 + [rows[1]] * 3
    return spark.createDataFrame([(f"r{i:04d}", *r) for i, r in enumerate(rows)], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def by_hand(records):
    """Every pair with the first rule it meets."""
    out = []
    for a, b in itertools.combinations(sorted(records.collect(), key=lambda r: r.record_id), 2):
        for rule in blocking.BLOCKING_RULES:
            if all(a[c] is not None and a[c] == b[c] for c in rule):
                out.append((a.record_id, b.record_id, blocking.rule_name(rule)))
                break
    return sorted(out)


@pytest.mark.parametrize("slice_rows", [5_000, 4])
def test_candidates_and_their_count(spark, slice_rows):
    records = random_records(spark)
    want = by_hand(records)
    found = blocking.candidate_pairs(records, slice_rows=slice_rows).select("record_id_l", "record_id_r", "match_key")
    assert rows(found) == want
    if slice_rows == 5_000:
        counted = blocking.count_rule_pairs(records).first()
        assert tuple(counted) == (len(want), records.count())
        n = records.count()
        prior = model.estimate_prior(records).first()
        assert prior["prior"] == pytest.approx(len(want) / 0.7 / (n * (n - 1) / 2))
        biggest = blocking.block_sizes(records, ("email",)).orderBy(F.desc("records")).first()
        emails = [r.email for r in records.collect()]
        assert biggest["records"] == max(emails.count(e) for e in set(emails) if e)


def test_prior_of_one_record(spark):
    one = random_records(spark, 2, hot=False).limit(1)
    assert model.estimate_prior(one).first()["prior"] is None


def test_gammas_level_by_level(spark):
    def pair(**changed):
        left = dict(record_id="a", first_name="Katherine", last_name="Bennett", email="kb@mail.example", phone="1", postcode="AB1 2CD", dob="1980-01-01")
        right = {**left, "record_id": "b", **changed}
        return tuple(left.values()) + tuple(right.values())

    cases = [
        (pair(), (6, 4, 3, 1, 1)),
        (pair(first_name="Bennett", last_name="Katherine"), (5, 4, 3, 1, 1)),
        (pair(first_name="Katherin", email="kb@other.example"), (4, 3, 3, 1, 1)),
        (pair(first_name="Kahterine", last_name="Benett", email="kc@mail.example"), (4, 2, 3, 1, 1)),
        (pair(first_name="Bob", postcode="AB1 9ZZ"), (2, 4, 2, 1, 1)),
        (pair(last_name="Okoro", postcode="AB9 9ZZ", phone="2"), (1, 4, 1, 0, 1)),
        (pair(first_name="Bob", last_name="Okoro", postcode="C1 1AA", dob="1", email="zz@q.example"), (0, 0, 0, 1, 0)),
        (pair(first_name=None, email=None, postcode=None, phone=None, dob=None), (-1, -1, -1, -1, -1)),
    ]
    comps = comparisons.guest_comparisons()
    frame = spark.createDataFrame([(*c, i) for i, (c, _) in enumerate(cases)], PAIR + ", i int")
    got = {r.i: tuple(r[f"gamma_{c.name}"] for c in comps) for r in comparisons.with_gammas(frame, comps, ("i",)).collect()}
    assert [got[i] for i in range(len(cases))] == [g for _, g in cases]
    # Swapping the sides changes nothing.
    turned = frame.select("i", *[F.col(f"{c}_{s}").alias(f"{c}_{t}") for s, t in ("lr", "rl") for c in ["record_id", *blocking.FIELDS]])
    back = {r.i: tuple(r[f"gamma_{c.name}"] for c in comps) for r in comparisons.with_gammas(turned, comps, ("i",)).collect()}
    assert back == got
    plain = comparisons.guest_comparisons(graded_postcode=False)[2]
    assert {r.i: r.gamma_postcode for r in comparisons.with_gammas(frame, [plain], ("i",)).collect()}[4] == 0


def test_similarity_counts_code_points(spark):
    pairs = [
        ("MARTHA", "MARHTA", 0.961111), ("DIXON", "DICKSONX", 0.813333), ("DWAYNE", "DUANE", 0.84), ("abc", "xyz", 0.0),
        ("太郎", "太朗", 0.666667), ("Иван", "Ивна", 0.933333), ("محمد", "محمود", 0.953333), ("민준", "민준", 1.0),
        ("a", "", 0.0), ("x" * 80 + "y", "x" * 80 + "z", 0.995062),
    ]
    assert jaro_winkler_batch([p[0] for p in pairs], [p[1] for p in pairs]) == pytest.approx([p[2] for p in pairs], abs=1e-6)
    frame = spark.createDataFrame([(a, b) for a, b, _ in pairs] + [(None, "a"), ("a", None)], "a string, b string")
    found = [tuple(r) for r in frame.select(jaro_winkler("a", "b"), jaro_winkler("b", "a")).collect()]
    assert found[-2:] == [(None, None)] * 2
    assert [f[0] for f in found[:-2]] == pytest.approx([p[2] for p in pairs], abs=1e-6)
    assert all(f[0] == f[1] for f in found[:-2])


def test_term_frequencies_weigh_rare_values_more(spark):
    records = random_records(spark)
    phones = [r.phone for r in records.collect() if r.phone]
    assert dict(rows(comparisons.term_frequencies(records, "phone"))) == pytest.approx({p: phones.count(p) / len(phones) for p in set(phones)})
    scored = scoring.score_pairs(records, model.GIVEN_MODEL, threshold=None).where("gamma_phone = 1")
    u = model.GIVEN_MODEL.u["phone"][1]
    for r in scored.select("tf_phone", "bf_tf_phone").distinct().collect():
        assert r.bf_tf_phone == pytest.approx(math.log2(u / r.tf_phone))


def test_scores_add_up_and_rise_with_agreement(spark):
    scored = scoring.score_pairs(random_records(spark), model.GIVEN_MODEL, threshold=None)
    parts = rows(model.explain(scored, model.GIVEN_MODEL).groupBy("record_id_l", "record_id_r").agg(F.sum("bits")))
    total = {(r.record_id_l, r.record_id_r): r for r in scored.collect()}
    assert len(parts) == len(total)
    for a, b, bits in parts:
        weight = total[a, b].match_weight
        assert weight == pytest.approx(bits + model.prior_bits(model.GIVEN_MODEL))
        assert total[a, b].match_probability == pytest.approx(2**weight / (1 + 2**weight))
    for name, m in model.GIVEN_MODEL.m.items():
        best = model.level_bits(model.GIVEN_MODEL, name, len(m) - 1)
        assert all(best > model.level_bits(model.GIVEN_MODEL, name, i) for i in range(len(m) - 1))


@pytest.mark.parametrize("seed, threshold, slice_rows", [(1, 0.8, 5_000), (2, 0.999, 3)])
def test_bounds_leave_out_no_result(spark, seed, threshold, slice_rows):
    records = random_records(spark, 150, seed)
    everything = scoring.score_pairs(records, model.GIVEN_MODEL, threshold=None).where(F.col("match_probability") >= threshold)
    found = scoring.score_pairs(records, model.GIVEN_MODEL, threshold=threshold, slice_rows=slice_rows)
    columns = ["record_id_l", "record_id_r", "match_key", F.round("match_weight", 6)]
    assert rows(found.select(*columns)) == rows(everything.select(*columns))


def random_model(rnd, sour):
    """A model with random level probabilities; with ``sour`` every level of the phone counts against a match."""
    def shares(n):
        x = [rnd.random() + 0.02 for _ in range(n)]
        return [v / sum(x) for v in x]

    m = {k: shares(len(v)) for k, v in model.GIVEN_MODEL.m.items()}
    u = {k: shares(len(v)) for k, v in model.GIVEN_MODEL.u.items()}
    if sour:
        m["phone"], u["phone"] = [0.4, 0.6], [0.3, 0.7]
    return model.MatchModel(rnd.choice([0.001, 0.05, 0.4]), m, u)


@pytest.mark.parametrize("seed", range(2))
def test_bounds_leave_out_no_result_of_any_model(spark, seed):
    rnd = random.Random(seed)
    records, tried = random_records(spark, 60, seed), random_model(rnd, sour=seed % 2 == 0)
    threshold = rnd.choice([0.2, 0.6, 0.95])
    everything = scoring.score_pairs(records, tried, threshold=None).where(F.col("match_probability") >= threshold)
    found = scoring.score_pairs(records, tried, threshold=threshold, slice_rows=5)
    columns = ["record_id_l", "record_id_r", "match_key", F.round("match_weight", 6)]
    assert rows(found.select(*columns)) == rows(everything.select(*columns))


def test_a_partner_without_the_common_value_is_found(spark):
    """A phone that all share speaks against a match, so the best partner is the one without a phone."""
    people = [(f"r{i:03d}", f"N{i}x", f"L{i}y", f"u{i}@x", "440", None, None) for i in range(101)]
    records = spark.createDataFrame([*people, ("s000", "N0x", "L0y", "u0@x", None, None, None)], SCHEMA)
    tried = model.MatchModel(model.GIVEN_MODEL.prior, {**model.GIVEN_MODEL.m, "phone": [0.4, 0.6]}, model.GIVEN_MODEL.u)
    best = scoring.score_pairs(records, tried, threshold=None).where("record_id_r = 's000'").first()
    threshold = best.match_probability - 1e-9
    found = scoring.score_pairs(records, tried, threshold=threshold).select("record_id_l", "record_id_r")
    assert ("r000", "s000") in rows(found)


def test_hot_block_is_joined_on_more_than_its_value(spark):
    """A phone shared by 300 unrelated records makes few pairs, and none of the matches is missing."""
    people = [(f"r{i:04d}", f"N{i}x{i}", f"L{i}y{i}", f"u{i}@x", "440", f"A{i} {i}AA", f"19{i % 90 + 10}-01-01") for i in range(300)]
    twins = [(f"s{i:04d}", *people[i][1:3], None, "440", None, people[i][6]) for i in range(5)]
    records = spark.createDataFrame(people + twins, SCHEMA)
    known = comparisons.with_term_frequencies(records, comparisons.guest_comparisons())
    met = scoring.promising_pairs(known, ("phone",), model.GIVEN_MODEL, 0.8, 305, 50)
    assert met.count() < 2_000 < 305 * 304 / 2
    found = scoring.score_pairs(records, model.GIVEN_MODEL, slice_rows=50).select("record_id_l", "record_id_r")
    assert rows(found) == [(f"r{i:04d}", f"s{i:04d}") for i in range(5)]


def test_refinements_cover_every_combination_that_reaches_the_threshold(spark):
    m = model.GIVEN_MODEL
    assert scoring.refinements(m, ("email",), 0.8, 0.3) is None
    keys = scoring.refinements(m, ("phone",), 0.8, 0.3)
    assert keys and all(level > 0 for _, level in keys)
    # Agreeing on the last name again is no refinement of a rule that has it.
    keys = scoring.refinements(m, ("postcode", "last_name"), 0.8, 0.3)
    assert ("name", 2) not in [(c.name, level) for c, level in keys]


@pytest.mark.parametrize("slice_rows", [4])
def test_resolve_equals_clustering_every_scored_pair(spark, slice_rows):
    records = random_records(spark, 90, seed=4)
    scored = scoring.score_pairs(records, model.GIVEN_MODEL)
    want = rows(clustering.cluster_pairs(records, scored))
    assert rows(clustering.resolve(records, model.GIVEN_MODEL, slice_rows=slice_rows)) == want
    assert len(want) == records.count() and len({g for _, g in want}) < len(want)


def test_resolving_leaves_one_table(spark):
    root = Path(session.checkpoint_root(spark).removeprefix("file:"))
    before = set(root.glob("*/*"))
    found = clustering.resolve(random_records(spark, 40, seed=9), model.GIVEN_MODEL)
    assert found.count() == 53
    new = [d.name for d in set(root.glob("*/*")) - before]
    assert len(new) == 1 and new[0].startswith("by-content")


def test_copies_without_evidence_stay_apart(spark):
    lone = [(f"r{i}", "Ana", "Ito", None, None, None, None) for i in range(3)]
    records = spark.createDataFrame(lone, SCHEMA)
    assert rows(clustering.resolve(records, model.GIVEN_MODEL)) == [(f"r{i}", f"r{i}") for i in range(3)]


def test_three_spellings_become_one_guest(spark):
    """Ana Smith, A. Smith and Ana Smyth are one guest, Ben Okoro is another."""
    records = spark.createDataFrame([
        ("r1", "Ana", "Smith", "ana.smith@mail.com", "4471", "L1 1AA", "1990-05-01"),
        ("r2", "A.", "Smith", "ana.s@mail.com", "4471", "L1 1AA", "1990-05-01"),
        ("r3", "Ana", "Smyth", "ana.smith@mail.com", None, "L1 1AA", None),
        ("r4", "Ben", "Okoro", "ben@mail.com", "4472", "M2 2BB", "1985-01-01"),
    ], SCHEMA)
    assert rows(clustering.resolve(records, model.GIVEN_MODEL)) == [("r1", "r1"), ("r2", "r1"), ("r3", "r1"), ("r4", "r4")]
    best = dict(rows(clustering.link_confidence(scoring.score_pairs(records, model.GIVEN_MODEL))))
    assert set(best) == {"r1", "r2", "r3"} and min(best.values()) >= 0.8


def test_random_pairs_are_all_pairs_when_few(spark):
    records = random_records(spark, 60)
    n = records.count()
    assert model.sample_random_pairs(records).count() == n * (n - 1) // 2
    some = model.sample_random_pairs(records, max_pairs=500).count()
    assert 200 < some < 900
    shares = model.estimate_u(records, comparisons.guest_comparisons()).groupBy("comparison").agg(F.sum("u_prob")).collect()
    assert [r[1] for r in shares] == pytest.approx([1.0] * 5)


@pytest.mark.parametrize("slice_rows", [5_000, 4])
def test_pattern_counts_multiply_copies(spark, slice_rows):
    records = random_records(spark, 80, seed=7)
    comps = [c for c in comparisons.guest_comparisons() if c.name in ("name", "dob")]
    want = comparisons.pattern_counts(comparisons.with_gammas(blocking.rule_pairs(records, ("email",)), comps), comps)
    found = model.rule_patterns(records, ("email",), comps, slice_rows)
    assert rows(found.withColumn("pairs", F.col("pairs").cast("long"))) == rows(want)


def test_em_recovers_planted_probabilities():
    rnd = np.random.default_rng(0)
    comps = [c for c in comparisons.guest_comparisons() if c.name in ("postcode", "phone", "dob")]
    m = {"postcode": [0.05, 0.05, 0.1, 0.8], "phone": [0.1, 0.9], "dob": [0.05, 0.95]}
    u = {"postcode": [0.7, 0.2, 0.05, 0.05], "phone": [0.98, 0.02], "dob": [0.97, 0.03]}
    n, share = 200_000, 0.3
    match = rnd.random(n) < share
    drawn = np.stack([
        np.where(match, rnd.choice(len(m[c.name]), n, p=m[c.name]), rnd.choice(len(u[c.name]), n, p=u[c.name])) for c in comps
    ], axis=1)
    drawn[rnd.random(drawn.shape) < 0.1] = -1
    patterns, pairs = np.unique(drawn, axis=0, return_counts=True)
    table = [{**{f"gamma_{c.name}": p[i] for i, c in enumerate(comps)}, "pairs": k} for p, k in zip(patterns, pairs)]
    found_share, found = model.em_session(table, comps, u, rounds=100)
    assert found_share == pytest.approx(share, abs=0.01)
    for name in m:
        assert found[name] == pytest.approx(m[name], abs=0.02)


def test_training_without_pairs_keeps_the_starting_point(spark):
    records = spark.createDataFrame([("r1", "A", "B", None, None, None, None), ("r2", "C", "D", None, None, None, None)], SCHEMA)
    trained = model.train(records)
    assert trained.sessions == {} and trained.model.m["phone"] == model.starting_m(1)


def test_quality_reports(spark):
    raw = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 3)], "record_id string, true_id long")
    resolved = spark.createDataFrame([("a", "a"), ("b", "b"), ("c", "c"), ("d", "c")], "record_id string, golden_id string")
    assert tuple(clustering.merge_quality(resolved, raw).first()) == (3, 66.7)
    assert tuple(clustering.compression(resolved, raw).first()) == (4, 3, 1.3333, 3)
    # The one pair put together is wrong, the one true pair is missed.
    assert tuple(clustering.pair_quality(resolved, raw).first()) == (0.0, 0.0)
    one = resolved.withColumn("golden_id", F.lit("a"))
    assert clustering.merge_quality(one, raw).first()["pct_true_groups_fully_merged"] == 100.0
    assert clustering.pair_quality(one, raw).first()["precision"] == pytest.approx(1 / 6)
