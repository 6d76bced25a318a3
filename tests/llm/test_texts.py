import functools
import hashlib
import itertools
import pickle
import re

import numpy as np
import public_tokenizers
import pytest

import edge
from kinweave.llm import license_scan, secret_scan, toxicity


def spans_by_hand(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(s[2] for s in sorted(found))


@pytest.mark.parametrize("text", [
    "", "password=abc", "PassWord : 'abcdef'", "secret:token:abcdefgh", "token=token=abcdef", "api_key=x apikey = 1234567",
    "AKIAXAKIA" + "Y" * 20, "AKIA" + "Z" * 15, "0" * 23 + "g" + "a" * 24, "é password=abcdefé", "paſſword=abcdef", "secret=" + "a" * 50_000,
])
def test_base_spans(text):
    assert secret_scan.written(secret_scan.base_spans(text)) == spans_by_hand(text)


def test_guessing_is_priced_by_the_cheapest_segmentation():
    cost = secret_scan.guess_cost
    assert cost("") == 0 and cost("password") < cost("Password1") < cost("p4ssw0rd!x") < cost("Xq7$kLw0pZ")
    assert cost("aaaaaaaaaaaa") < cost("aaabaaabaaab") and cost("qwertyuiop") < cost("qpwoeiruty")
    assert cost("20240131") < cost("73240131") and cost("dragonmonkey") < cost("dragonmonkez")
    # Never above brute force, never above the sum over any cut.
    for value in ("dragon1990qwerty", "b7db7aa4a5", "aaaa1234zxcv"):
        assert cost(value) <= sum(np.log10(secret_scan._class_size(c)) for c in value) + 1e-9
        assert all(cost(value) <= cost(value[:i]) + cost(value[i:]) + 1e-9 for i in range(len(value)))
    assert cost("x" * 20_000) < 10


@functools.cache
def cost_by_hand(value):
    """The cheapest cut into single characters, words, repeats of characters and blocks, and walks, all lengths tried; for small letters."""
    best = [0.0]
    repeated = [[] for _ in range(len(value) + 1)]
    for start in range(len(value)):
        for size in range(2, 65):
            block, times = value[start : start + size], 2
            while len(block) == size and value.startswith(block, start + size * (times - 1)):
                repeated[start + size * times].append((start, block, times))
                times += 1
    for end in range(1, len(value) + 1):
        options = [best[end - 1] + np.log10(26)]
        options += [best[start] + cost_by_hand(block) + np.log10(times) for start, block, times in repeated[end]]
        repeat = walk = True
        for start in range(end - 2, -1, -1):
            a, b = value[start : start + 2]
            repeat = repeat and a == b
            walk = walk and (secret_scan._neighbours(a, b) or abs(ord(a) - ord(b)) == 1)
            if end - start >= 3 and repeat:
                options.append(best[start] + np.log10(26 * (end - start)))
            if end - start >= 3 and walk:
                options.append(best[start] + np.log10(47 * (end - start)) + 0.6)
            if rank := secret_scan._RANK.get(value[start:end]):
                options.append(best[start] + np.log10(rank + 1) + np.log10(2))
        best.append(min(options))
    return best[-1]


def test_segments_of_long_runs_begin_anywhere():
    cost = secret_scan.guess_cost
    rnd = np.random.default_rng(4)
    values = ["password" + "d" * 150, "password" + "d" * 500, "monkey" + "y" * 66, "welcome" + "ew" * 80, "apple" + "ed" * 40 + "d" * 90]
    for _ in range(40):
        pieces = ["password", "hello", "x", "d" * rnd.integers(1, 120), "we" * rnd.integers(1, 60), "abc", "q"]
        values.append("".join(pieces[k] for k in rnd.integers(0, len(pieces), 5)))
    for value in values:
        assert cost(value) == pytest.approx(cost_by_hand(value), abs=1e-9), value
    assert cost(values[0]) < 4.3 and secret_scan.guess_spans(f"password: {values[0]}") == []
    assert cost("we" * 10_000) < 10


def test_blocks_that_repeat_are_cheap():
    rnd = np.random.default_rng(7)
    values = ["abcabc", "foobarfoobar", "zxqvzxqvzxqv", "xxyxxyxxyq", "qabababababw", "aabbaabbaabb", "kqkqkqzkqkqkqz"]
    values += ["".join(rnd.choice(list("qkz"), rnd.integers(4, 14))) for _ in range(60)]
    for value in values:
        assert secret_scan.guess_cost(value) == pytest.approx(cost_by_hand(value), abs=1e-9), value
    assert secret_scan.guess_cost("zqxj7" * 4000) < 12


def test_dictionary_of_ranked_words(spark):
    known = secret_scan.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert known.index("the") < known.index("elephant") and len(known) == len(set(known)) and all(map(str.isalpha, known))
    ranks = secret_scan.ranked(known)
    easy = ("elephant", "elephantmountain", "abc123abc123", "foobarfoobar", "Elephant1990", "01022024", "010224")
    assert all(secret_scan.guess_cost(value, ranks) < secret_scan.THRESHOLD + 1 for value in easy)
    assert all(secret_scan.guess_cost(value, ranks) < secret_scan.THRESHOLD for value in easy[:1] + easy[2:])
    assert secret_scan.guess_cost("Xq7$kLw0pZ9v", ranks) > 12 and secret_scan.guess_cost("zT8!vQ2@mN4#", ranks) > 12
    rows = [(i, f"Vrelgon vrelgon, drass pwd=quonzilber token: quonzilber {'narf' if i < 4 else 'x'}") for i in range(9)]
    docs = spark.createDataFrame([*rows, (None, None), (10, ""), (11, "y" * 30 + " \u00e9t\u00e9s")], "doc_id long, text string")
    assert secret_scan.learned(docs) == ["drass", "vrelgon"]
    assert secret_scan.learned(docs, least_docs=4) == ["drass", "vrelgon", "narf"]
    assert secret_scan.learned(docs, size=1) == ["drass"] and secret_scan.learned(docs.limit(0)) == []
    assert secret_scan.learned(docs, least_docs=1)[-1] == "\u00e9t\u00e9s"
    ranks = secret_scan.ranked(["vrelgon", "drass"], ["drass"])
    assert ranks["drass"] == 1 and ranks["vrelgon"] == 1 and ranks["password"] == 1
    found = secret_scan.scan(spark.createDataFrame([(1, "pwd=vrelgondrass")], "doc_id long, text string"), ranks=ranks).collect()[0]
    assert found.n_guess == 0 and secret_scan.guess_spans("pwd=vrelgondrass")


def test_context_values_that_are_hard_to_guess():
    text = "pwd: Xq7$kLw0pZ9v and passphrase = password and client_secret='zT8!vQ2@mN4#' plain words"
    spans = secret_scan.guess_spans(text)
    assert [text[a:b] for a, b, _ in spans] == ["Xq7$kLw0pZ9v", "zT8!vQ2@mN4#"]
    assert secret_scan.redact(text, spans).count("[SECRET]") == 2
    assert secret_scan.redact("abcdef", [(1, 3, "a"), (2, 4, "b"), (4, 5, "c")], "_") == "a__f"


def test_scan_of_awkward_rows(spark):
    docs = edge.documents(spark)
    found = {(r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in secret_scan.scan(docs).collect()}
    want = set()
    for doc_id, text, *_ in edge.rows():
        base = spans_by_hand(text or "")
        want.add((doc_id, hashlib.sha256(base.encode()).hexdigest(), *(base.count(k) for k in ("assign", "access", "hex"))))
    assert found == want and secret_scan.scan(docs).count() == len(edge.rows())
    clean = secret_scan.redacted(docs)
    assert clean.columns == docs.columns and clean.schema == docs.schema
    changed = [r for r in clean.collect() if r.doc_id == 9][0]
    assert "AKIA" not in changed.text and "password=" not in changed.text and changed.n_chars == len(changed.text)
    others = lambda df: sorted(map(str, df.where("doc_id IS NULL OR doc_id <> 9").collect()))
    assert others(clean) == others(docs)
    assert secret_scan.scan(edge.empty(spark)).count() == 0 and secret_scan.redacted(edge.empty(spark)).count() == 0


def aligned_by_hand(template, text):
    """Most matched words of the best local alignments, without a band."""
    best = {}
    score = np.zeros((len(template) + 1, len(text) + 1), int)
    for i, j in itertools.product(range(1, len(template) + 1), range(1, len(text) + 1)):
        step = license_scan.MATCH if template[i - 1] == text[j - 1] else license_scan.MISMATCH
        score[i, j] = max(0, score[i - 1, j - 1] + step, score[i - 1, j] + license_scan.GAP, score[i, j - 1] + license_scan.GAP)
    best = score.max()
    return best


def test_banded_alignment_finds_the_best_score():
    rnd = np.random.default_rng(0)
    for _ in range(30):
        template = rnd.integers(1, 30, 40)
        text = np.concatenate([rnd.integers(31, 60, 20), template, rnd.integers(31, 60, 10)])
        for _ in range(3):
            at = rnd.integers(20, len(text) - 12)
            text = np.delete(text, at) if rnd.random() < 0.5 else np.insert(text, at, 99)
        matched, first, last = license_scan.align(template, text, 20)
        edits = 2 * matched - aligned_by_hand(template.tolist(), text.tolist())
        assert 0 <= edits <= 12 and matched >= 34 and 18 <= first < last < len(text)
    assert license_scan.align(template, np.array([99] * 5), 0) == (0, -1, -1)
    assert license_scan.align(template, np.empty(0, int), 3) == (0, -1, -1)


def test_licenses_with_edits_repeats_and_overlaps():
    index = license_scan.Index(license_scan.TEMPLATES)
    for name, template in license_scan.TEMPLATES.items():
        words = template.split()
        found = license_scan.find(index, f"Some words. {template} More words.")
        assert (name, 1.0) in [(f[0], f[1] / f[2]) for f in found], name
        if len(words) > 30:
            text = " ".join(["before"] + words[:10] + ["extra"] + words[10:20] + words[21:] + ["after"])
            best = max(license_scan.find(index, text), key=lambda f: f[1])
            assert best[0] == name and text[best[3] : best[4]].split()[0].strip('"(') == words[0].strip('"(')
    twice = license_scan.find(index, "ALL RIGHTS RESERVED all rights reserved")
    assert [(f[0], f[3], f[4]) for f in twice] == [("all-rights-reserved", 0, 19), ("all-rights-reserved", 20, 39)]
    assert license_scan.find(index, "") == license_scan.find(index, "all rights") == []
    with pytest.raises(ValueError):
        license_scan.Index({"short": "two words"})


@pytest.mark.parametrize("name", sorted(license_scan.TEMPLATES))
def test_licenses_with_one_word_changed(name):
    index = license_scan.Index(license_scan.TEMPLATES)
    words = license_scan.words(license_scan.TEMPLATES[name])
    for i in range(len(words)):
        for text, matched in (
            (words[:i] + ["zzz"] + words[i + 1 :], len(words) - 1), (words[:i] + words[i + 1 :], len(words) - 1),
            (words[:i] + ["zzz"] + words[i:], len(words)),
        ):
            if matched >= license_scan.COVERAGE * len(words):
                found = license_scan.find(index, f"Some plain text {' '.join(text)} and so on")
                # A changed template can be another one, word for word.
                assert any(f[1] == matched and (f[0] == name or f[1] == f[2]) for f in found), (text, found)


def test_short_license_with_a_word_in_every_gap():
    index = license_scan.Index(license_scan.TEMPLATES)
    assert license_scan.find(index, "We all the rights are reserved.") == [("all-rights-reserved", 3, 3, 3, 30)]
    assert license_scan.find(index, "Released under an MIT License")[0][:3] == ("mit-short", 4, 5)
    assert pickle.loads(pickle.dumps(index)).candidates(np.array([0, index.numbers["reserved"]], np.int32)) == []


def test_license_scan_of_awkward_rows(spark):
    found = license_scan.scan(edge.documents(spark)).collect()
    assert [(r.doc_id, r.license, r.coverage, r.span_start, r.span_end) for r in found] == [(12, "all-rights-reserved", 1.0, 0, 19)]
    assert license_scan.scan(edge.empty(spark)).count() == 0


def test_toxicity_learns_labels_and_scores_every_row(spark):
    rnd = np.random.default_rng(3)
    words = ["".join(rnd.choice(list("etaoinshrdlu"), 5)) for _ in range(200)]
    docs, labels = [], []
    for i in range(800):
        toxic = i % 4 == 0
        text = list(rnd.choice(words, 40))
        if toxic:
            text[rnd.integers(0, 40)] = "Dimwit"
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    frame = spark.createDataFrame(docs, edge.SCHEMA).withColumn("toxic", edge_lit("x")).withColumn("score", edge_lit("y"))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(frame, known)
    found = toxicity.scores(frame, model).collect()
    right = [r.predicted == int(r.doc_id % 4 == 0) for r in found if r.held_out]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert all((r.predicted == 1) == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found)
    odd = toxicity.scores(edge.documents(spark), model)
    assert odd.count() == len(edge.rows()) and odd.where("score IS NULL OR held_out IS NULL").count() == 0
    kept = toxicity.without_toxic(frame, model)
    assert kept.columns == frame.columns and 590 <= kept.count() <= 610
    nothing = toxicity.train(frame, known.limit(0))
    assert toxicity.scores(frame, nothing).where("predicted = 1").count() == 0
    assert toxicity.scores(edge.empty(spark), toxicity.train(edge.empty(spark), known)).count() == 0


def edge_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def test_held_out_documents_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"text number {i % 7} of many words", "en", "s", 1) for i in range(200)], edge.SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    turned = labels.withColumn("toxic", edge_when(labels))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def edge_when(labels):
    from pyspark.sql import functions as F

    return F.when(toxicity.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
