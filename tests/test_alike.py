"""Similar texts inside a block against a comparison of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from kinweave.functions.similarity import jaro_winkler_batch
from kinweave.operators.resolve import alike, comparisons, model, scoring

rnd = random.Random(7)


def names(n, letters="abcdeé木", least=0, most=12):
    made = ["".join(rnd.choices(letters, k=rnd.randint(least, most))) for _ in range(n)]
    for i in range(0, n - 1, 2):  # every second one a misspelling of the one before
        text = list(made[i])
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randrange(len(text) + 1)
            text[at : at + rnd.randint(0, 1)] = rnd.choices(letters, k=rnd.randint(0, 1))
        made[i + 1] = "".join(text)
    return made


def similarity(a, b):
    return 1.0 if a == b else jaro_winkler_batch([min(a, b)], [max(a, b)])[0]


@pytest.mark.parametrize("threshold", [0.72, 0.8, 0.88, 0.92, 0.99, 1.0])
def test_similar_texts_share_their_entries_once(threshold):
    texts = list(dict.fromkeys(names(120) + names(20, "ab", 1, 4) + names(16, "abcdefgh", 50, 80)))
    texts.sort(key=lambda t: (len(t), t))
    filed = {side: [{} for _ in texts] for side in (True, False)}
    for side, entries in filed.items():
        for i, t in enumerate(texts):
            for key, start, chosen, rarest in alike.filed_under(t, threshold, side):
                assert key not in entries[i]
                entries[i][key] = (start, chosen, rarest)
    for j, longer in enumerate(texts):
        for i, shorter in enumerate(texts[:j]):
            met = 0
            for key in filed[True][j].keys() & filed[False][i].keys():
                start, chosen, rarest = filed[True][j][key]
                if key == "long":
                    met += 1
                    continue
                exact = start in (4, len(shorter)) or longer[start : start + 1] != shorter[start : start + 1]
                common = [c for c in rarest if c in filed[False][i][key][2]]
                met += exact and common[: len(chosen)] == chosen
            assert met <= 1
            if similarity(longer, shorter) >= threshold:
                assert met == 1, (longer, shorter)


@pytest.mark.parametrize("slice_rows", [5_000, 7])
def test_alike_pairs_equal_all_pairs(spark, slice_rows):
    first, last = names(150), names(150, "xyz", 1, 5)
    people = [(f"r{i:03d}", rnd.choice(["p", "q", "p", None]), f or None, l, i) for i, (f, l) in enumerate(zip(first, last))]
    people += [(f"s{i:03d}", *p[1:]) for i, p in enumerate(people[:20])] + [("t0", "p", "", "", 1), ("t1", "p", "", "", 2)]
    people += [("u0", "p", "a" * 70, "xy", 1), ("u1", "p", "a" * 60 + "b" * 4, "xy", 1), ("u2", "p", "a" * 69, "xyx", None)]
    records = spark.createDataFrame(people, "record_id string, phone string, first_name string, last_name string, extra int")
    found = alike.alike_pairs(records, ("phone",), [(F.col("first_name"), 0.8), (F.lower("last_name"), 0.75)], slice_rows)
    assert found.columns == [f"{c}_{side}" for side in "lr" for c in records.columns]
    want = sorted(
        (*a, *b) for a in people for b in people
        if a[0] < b[0] and a[1] and a[1] == b[1] and None not in (a[2], b[2])
        and similarity(a[2], b[2]) >= 0.8 and similarity(a[3], b[3]) >= 0.75
    )
    assert len(want) > 40
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_thresholds_and_empty_tables(spark):
    records = spark.createDataFrame([], "record_id string, phone string, first_name string")
    assert alike.alike_pairs(records, ("phone",), [(F.col("first_name"), 0.9)]).count() == 0
    with pytest.raises(ValueError):
        alike.alike_pairs(records, ("phone",), [(F.col("first_name"), 0.7)])


SCHEMA = "record_id string, first_name string, last_name string, email string, phone string, postcode string, dob string"


def test_shared_email_meets_few_pairs(spark):
    """One email shared by 300 people, where similar names are enough to match: few pairs are made, no match is missing."""
    spelled = names(300, "abcdefghijklmnoprstuvw", 5, 9)
    people = [(f"r{i:04d}", a, b, "all@x", None, None, None) for i, (a, b) in enumerate(zip(spelled, names(300, "abcdefghijklmnoprstuvw", 5, 9)))]
    records = spark.createDataFrame(people, SCHEMA)
    m = model.GIVEN_MODEL
    # An email that says little, and names that say much.
    tried = model.MatchModel(m.prior, {**m.m, "email": [0.2] * 5}, {**m.u, "email": [0.2] * 5})
    keys = scoring.refinements(tried, ("email",), 0.005, 1.0, similar=True)
    assert keys and any(scoring._similar_parts(*key) for key in keys)
    assert scoring.refinements(tried, ("email",), 0.005, 1.0) is None
    known = comparisons.with_term_frequencies(records, comparisons.guest_comparisons())
    made = scoring.promising_pairs(known, ("email",), tried, 0.005, 300, 50).count()
    assert made < 300 * 299 / 2 / 20
    rules = [("email",)]
    want = scoring.score_pairs(records, tried, rules, threshold=None).where("match_probability >= 0.005")
    found = scoring.score_pairs(records, tried, rules, threshold=0.005, slice_rows=50)
    pairs = lambda df: sorted((r.record_id_l, r.record_id_r) for r in df.collect())
    assert len(pairs(want)) > 5 and pairs(found) == pairs(want)


def in_blocks(people, least):
    """All pairs of (id, block, first, last) of a block with similar names, by comparing everybody with everybody."""
    by_block = {}
    for p in sorted(people):
        by_block.setdefault(p[1], []).append(p)
    pairs = [(a, b) for ps in by_block.values() for i, a in enumerate(ps) for b in ps[i + 1 :]]
    alike_ = True
    for part in (2, 3):
        alike_ &= jaro_winkler_batch([min(a[part], b[part]) for a, b in pairs], [max(a[part], b[part]) for a, b in pairs]) >= least
    return {(a[0], b[0]) for (a, b), ok in zip(pairs, alike_) if ok}


@pytest.mark.parametrize("shared", [True, False])
def test_a_text_is_filed_once_not_for_each_row(spark, monkeypatch, shared):
    """Names that repeat in a block, and from block to block, are filed once; names of one block meet in it alone."""
    first, last = names(60, "abcdefgh", 4, 7), names(16, "stuvwxyz", 4, 6)
    mark = (lambda b: "") if shared else (lambda b: chr(0x4E00 + b))
    people = [
        (f"r{b:02d}-{i:03d}", f"b{b}", first[i % 60] + mark(b), last[(i // 2 + b) % 16] + mark(b)) for b in range(8) for i in range(120)
    ]
    rows, written = {}, alike.cut

    def counted(df, name="cut", *more):
        out = written(df, name, *more)
        rows[name] = out.count() if name.startswith("filed") else None
        return out

    monkeypatch.setattr(alike, "cut", counted)
    records = spark.createDataFrame(people, "record_id string, phone string, first_name string, last_name string")
    found = alike.alike_pairs(records, ("phone",), [(F.col("first_name"), 0.9), (F.col("last_name"), 0.9)])
    got = [(r.record_id_l, r.record_id_r) for r in found.select("record_id_l", "record_id_r").collect()]
    want = in_blocks(people, 0.9)
    assert len(want) > 50 and len(got) == len(set(got)) and set(got) == want
    texts = {x + mark(b) for x in last for b in range(8)}
    for side, as_longer in (("l", True), ("r", False)):
        assert 0 < rows[f"filed-{side}"] <= sum(1 for t in texts for _ in alike.filed_under(t, 0.9, as_longer))


def test_rows_meet_by_the_part_that_tells_them_apart(spark, monkeypatch):
    """Where nearly all have one last name, which costs nothing to file, rows meet by their first names."""
    monkeypatch.setattr(alike, "FILING", 0)
    people = [(f"r{i:03d}", f"b{i % 2}", n, "same" if i % 50 else "samee") for i, n in enumerate(names(400, "abcdefghijklm", 5, 8))]
    tried, meeting = [], alike._meeting
    monkeypatch.setattr(alike, "_meeting", lambda *a: tried.append(meeting(*a)) or tried[-1])
    records = spark.createDataFrame(people, "record_id string, phone string, first_name string, last_name string")
    found = alike.alike_pairs(records, ("phone",), [(F.col("first_name"), 0.85), (F.col("last_name"), 0.85)])
    assert {(r.record_id_l, r.record_id_r) for r in found.collect()} == in_blocks(people, 0.85)
    (_, cost, _, by_last), (_, less, _, by_first) = tried
    assert less < cost / 10 and by_first < by_last / 10


@pytest.mark.parametrize("threshold", [0.72, 0.8, 0.9, 0.97])
def test_no_similar_texts_are_told_apart_by_their_characters(spark, threshold):
    texts = sorted(set(names(120) + names(40, "ab", 0, 4) + names(24, "abcdefgh", 50, 80) + names(20, "xy😀é", 1, 5)))
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", alike.bag("t").alias("bag"))
    left, right = (df.select(*[F.col(c).alias(f"{c}_{x}") for c in df.columns]) for x in "lr")
    kept = left.join(right, (F.col("t_l") < F.col("t_r")) & alike.may_reach(threshold, "t_l", "t_r", "bag_l", "bag_r"))
    kept = {(r.t_l, r.t_r) for r in kept.select("t_l", "t_r").collect()}
    pairs = [(a, b) for i, a in enumerate(texts) for b in texts[i + 1 :]]
    reaching = {p for p, x in zip(pairs, jaro_winkler_batch(*map(list, zip(*pairs)))) if x >= threshold}
    assert reaching and reaching <= kept
    assert len(kept) < len(pairs) / 2
