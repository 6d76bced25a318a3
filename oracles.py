"""SQL equivalents of the registered queries, for an independent ANSI engine over the same tables.

Each statement is a final SELECT over named subqueries; ``compose`` prefixes the ones it needs.
"""

from __future__ import annotations

import re

from kinweave.operators.resolve.comparisons import guest_comparisons
from kinweave.operators.resolve.model import FLOOR, GIVEN_MODEL, starting_m
from kinweave.plans.value import COHORT_VALUE_COLUMNS, COHORT_VALUE_COMMENT
from kinweave.sources import guests

COMPARISONS = guest_comparisons()
TOP = {c.name: c.top for c in COMPARISONS}

# Renames each non-ASCII character of the names to an ASCII one that no name contains. The oracle's string
# distance counts bytes; after the renaming a byte is a character.
_foreign = sorted({ch for ch in "".join(guests.LETTERS) if ord(ch) > 127})
_spare = "0123456789!#$%&()*+,-/:;<=>?[]^_`{|}~QXZJ"
assert len(_foreign) <= len(_spare)


def one_byte(expr: str) -> str:
    return f"translate({expr}, '{''.join(_foreign)}', '{_spare[:len(_foreign)]}')"


def similarity(a: str, b: str) -> str:
    return f"jaro_winkler_similarity({one_byte(f'least({a}, {b})')}, {one_byte(f'greatest({a}, {b})')})"


def _low(expr: str) -> str:
    return f"(({expr}) & 4294967295::UBIGINT)"


def _turned(expr: str, bits: int) -> str:
    return f"({_low(f'{expr} << {bits}')} | ({expr} >> {32 - bits}))"


def murmur_step(h: str, k: str) -> str:
    """SQL for the state after one more word."""
    mixed = _low(f"{_turned(_low(f'{k} * 3432918353::UBIGINT'), 15)} * 461845907::UBIGINT")
    return _low(f"{_turned(f'xor({h}, {mixed})', 13)} * 5::UBIGINT + 3864292196::UBIGINT")


def murmur_end(h: str, length: str) -> str:
    """SQL for the hash from the last state and the number of bytes."""
    shifted = lambda x, bits: f"list_transform([{x}], lambda y: xor(y, y >> {bits}))[1]"
    h = shifted(f"xor({h}, CAST({length} AS UBIGINT))", 16)
    h = shifted(_low(f"{h} * 2246822507::UBIGINT"), 13)
    return shifted(_low(f"{h} * 3266489909::UBIGINT"), 16)


CTES: dict[str, str] = {
    "guests_raw": guests.GUESTS_RAW.format(customer="customer", orders="orders"),
    "party_members": guests.PARTY_MEMBERS.format(orders="orders"),
    "bookings": guests.BOOKINGS.format(orders="orders"),
    "transactions": guests.TRANSACTIONS.format(orders="orders"),
    "guests_resolved": "SELECT record_id, golden_id FROM given_map",
    "members": "SELECT DISTINCT party_id, booking_id, golden_id FROM party_members JOIN guests_resolved USING (record_id)",
    "attended": """SELECT DISTINCT a.golden_id AS src, b.golden_id AS dst, 'attended_with' AS relationship
        FROM members a JOIN members b ON a.party_id = b.party_id AND a.golden_id < b.golden_id""",
    "payers": "SELECT b.party_id, g.golden_id FROM bookings b JOIN guests_resolved g ON b.payer_record_id = g.record_id",
    "paid": """SELECT DISTINCT p.golden_id AS src, m.golden_id AS dst, 'paid_for' AS relationship
        FROM payers p JOIN members m ON m.party_id = p.party_id AND m.golden_id <> p.golden_id""",
    "edges": "SELECT * FROM attended UNION SELECT * FROM paid",
    "triplets": """SELECT record_id AS subject_id, 'raw_record' AS subject_type, 'RESOLVES_TO' AS predicate,
          golden_id AS object_id, 'guest' AS object_type, CAST(0.95 AS DOUBLE) AS confidence,
          'entity_resolution' AS source_method, 'splink' AS source_agent
        FROM guests_resolved
        UNION ALL
        SELECT DISTINCT a.golden_id, 'guest', 'VISITED_WITH', b.golden_id, 'guest', CAST(1.0 AS DOUBLE), 'shared_party', 'graph_build'
        FROM members a JOIN members b ON a.party_id = b.party_id AND a.golden_id <> b.golden_id
        UNION ALL
        SELECT src, 'guest', 'PAID_FOR', dst, 'guest', CAST(1.0 AS DOUBLE), 'booking_payer', 'graph_build' FROM paid""",
    "visited": "SELECT subject_id AS src, object_id AS dst FROM triplets WHERE predicate = 'VISITED_WITH'",
    "paid_edges": "SELECT subject_id AS src, object_id AS dst FROM triplets WHERE predicate = 'PAID_FOR'",
    "visit_vertices": "SELECT src AS id FROM visited UNION SELECT dst FROM visited",
    "names": """SELECT golden_id, name FROM (
          SELECT golden_id, first_name || ' ' || last_name AS name, row_number() OVER (PARTITION BY golden_id
            ORDER BY length(first_name || ' ' || last_name) DESC, first_name || ' ' || last_name DESC) AS rn
          FROM guests_resolved JOIN guests_raw USING (record_id)) WHERE rn = 1""",
    "labeled": """SELECT t.subject_id, s.name AS subject_name, t.predicate, t.object_id, o.name AS object_name,
          t.confidence, t.source_method
        FROM triplets t LEFT JOIN names s ON t.subject_id = s.golden_id LEFT JOIN names o ON t.object_id = o.golden_id
        WHERE t.predicate IN ('VISITED_WITH', 'PAID_FOR')""",
    "companions": "SELECT src AS guest_id, count(*) AS degree FROM visited GROUP BY src",
    "top_guest": "SELECT guest_id AS seed FROM companions ORDER BY degree DESC, guest_id LIMIT 1",
    "all_guests": "SELECT DISTINCT golden_id AS id FROM guests_resolved",
    # Every smaller id that reaches a guest over attended and paid edges in either direction.
    "edges_both_ways": "SELECT src, dst FROM edges UNION SELECT dst, src FROM edges",
    "reached(id, label)": """SELECT id, id FROM all_guests UNION
        SELECT e.dst, r.label FROM reached r JOIN edges_both_ways e ON e.src = r.id WHERE r.label < e.dst""",
    "cohorts": "SELECT id, min(label) AS cohort_id FROM reached GROUP BY id",
    "txn": """SELECT t.txn_id, t.amount_gbp, c.cohort_id, r.golden_id
        FROM transactions t JOIN guests_resolved r USING (record_id) JOIN cohorts c ON c.id = r.golden_id""",
    "pass_holders": """SELECT id AS golden_id FROM cohorts WHERE CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 100 < 5""",
    # Murmur3 of the bytes of an id with seed 42: whole words little-endian, then the bytes left, each a word with its sign.
    "murmur_words": """SELECT id, n, list_transform(range(n // 4 + n % 4), lambda i: CASE WHEN i < n // 4
            THEN CAST('0x' || x[8 * i + 7:8 * i + 8] || x[8 * i + 5:8 * i + 6] || x[8 * i + 3:8 * i + 4] || x[8 * i + 1:8 * i + 2] AS UBIGINT)
            ELSE CAST('0x' || if(x[2 * (i + 3 * (n // 4)) + 1:2 * (i + 3 * (n // 4)) + 1] >= '8', 'ffffff', '')
              || x[2 * (i + 3 * (n // 4)) + 1:2 * (i + 3 * (n // 4)) + 2] AS UBIGINT) END) AS words
        FROM (SELECT id, lower(hex(encode(id))) AS x, octet_length(encode(id)) AS n FROM cohorts)""",
    "murmur_mixed": f"""SELECT id, {murmur_end('list_reduce(list_prepend(42::UBIGINT, words), lambda h, k: ' + murmur_step('h', 'k') + ')', 'n')} AS h
        FROM murmur_words""",
    "murmur_holders": """SELECT id AS golden_id FROM murmur_mixed
        WHERE abs(CASE WHEN h >= 2147483648 THEN CAST(h AS BIGINT) - 4294967296 ELSE CAST(h AS BIGINT) END) % 100 < 5""",
    "members_per_cohort": "SELECT cohort_id, count(*) AS n FROM cohorts GROUP BY cohort_id",
    "spend_per_cohort": "SELECT cohort_id, sum(amount_gbp) AS spend FROM txn GROUP BY cohort_id",
    "passes_per_cohort": """SELECT cohort_id, count(*) AS passes FROM cohorts
        WHERE id IN (SELECT golden_id FROM pass_holders) GROUP BY cohort_id""",
    "cohort_spend": """SELECT cohort_id, if(passes > 0, 'has_pass_holder', 'no_pass_holder') AS segment,
          n AS cohort_members, round(coalesce(spend, 0), 2) AS total_spend_gbp
        FROM members_per_cohort LEFT JOIN spend_per_cohort USING (cohort_id) LEFT JOIN passes_per_cohort USING (cohort_id)""",
    "hops": """SELECT guest_id, reachable_guest, min(hops) AS hops FROM (
          SELECT src AS guest_id, dst AS reachable_guest, 1 AS hops FROM visited
          UNION ALL SELECT a.src, b.dst, 2 FROM visited a JOIN visited b ON a.dst = b.src)
        WHERE guest_id <> reachable_guest GROUP BY 1, 2""",
    "from_seed": "SELECT src, dst FROM visited WHERE src = (SELECT seed FROM top_guest)",
    "walk": """SELECT 1 AS depth, dst AS guest_id FROM from_seed
        UNION SELECT 2, b.dst FROM from_seed a JOIN visited b ON b.src = a.dst WHERE b.dst <> a.src
        UNION SELECT 3, c.dst FROM from_seed a JOIN visited b ON b.src = a.dst JOIN visited c ON c.src = b.dst
          WHERE b.dst <> a.src AND c.dst <> a.src AND c.dst <> a.dst""",
    "paths(depth, guest, path)": """SELECT 1, dst, [src, dst] FROM from_seed
        UNION ALL SELECT depth + 1, e.dst, list_append(path, e.dst) FROM paths p JOIN visited e ON e.src = p.guest
          WHERE depth < 6 AND NOT list_contains(path, e.dst)""",
    "apart(hops, src, dst)": """SELECT 0, id, id FROM visit_vertices
        UNION SELECT hops + 1, a.src, e.dst FROM apart a JOIN visited e ON e.src = a.dst WHERE hops < 3""",
    "undirected": "SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM visited",
    "corners": """SELECT unnest([x.a, x.b, y.b]) AS id FROM undirected x JOIN undirected y ON x.b = y.a
        JOIN undirected z ON z.a = x.a AND z.b = y.b""",
    "votes(round, id, label)": """SELECT 0, id, id FROM visit_vertices
        UNION ALL
        SELECT round + 1, id, label FROM (
          SELECT round, id, label, row_number() OVER (PARTITION BY id ORDER BY sum(n) DESC, label) AS rn FROM (
            SELECT v.round, e.dst AS id, v.label, 1 AS n FROM votes v JOIN visited e ON e.src = v.id
            UNION ALL SELECT v.round, e.src, v.label, 1 FROM votes v JOIN visited e ON e.dst = v.id
            UNION ALL SELECT v.round, v.id, v.label, 0 FROM votes v)
          WHERE round < 5 GROUP BY round, id, label) WHERE rn = 1""",
}


def _ranks(name: str, vertices: str, edges: str) -> None:
    CTES[f"{name}_out"] = f"SELECT src, count(*) AS n FROM {edges} GROUP BY src"
    CTES[f"{name}_step(round, id, r)"] = f"""SELECT 0, id, CAST(1 AS DOUBLE) FROM {vertices}
        UNION ALL
        SELECT round + 1, id, 0.15 + 0.85 * sum(gain) FROM (
          SELECT s.round, e.dst AS id, s.r / o.n AS gain FROM {name}_step s JOIN {edges} e ON e.src = s.id JOIN {name}_out o ON o.src = s.id
          UNION ALL SELECT s.round, s.id, 0 FROM {name}_step s)
        WHERE round < 10 GROUP BY round, id"""
    CTES[name] = f"""SELECT id, round(r * (SELECT count(*) / sum(r) FROM {name}_step WHERE round = 10), 6) AS pagerank
        FROM {name}_step WHERE round = 10"""


_ranks("ranks", "all_guests", "edges")
_ranks("visit_ranks", "visit_vertices", "visited")

# Entity resolution

FIELDS = ["first_name", "last_name", "email", "phone", "postcode", "dob"]
RULE_SQL = {
    "email": "l.email = r.email",
    "postcode+last_name": "(l.postcode = r.postcode AND l.last_name = r.last_name)",
    "phone": "l.phone = r.phone",
}
BOTH_SIDES = ", ".join(f"l.{c} AS {c}_l, r.{c} AS {c}_r" for c in ["record_id", *FIELDS])


def user(c: str) -> str:
    return f"split_part({c}, '@', 1)"


GAMMA = {
    "name": ("first_name_l IS NULL OR first_name_r IS NULL OR last_name_l IS NULL OR last_name_r IS NULL", [
        "first_name_l = first_name_r AND last_name_l = last_name_r",
        "first_name_l = last_name_r AND last_name_l = first_name_r",
        *[f"{similarity('first_name_l', 'first_name_r')} >= {t} AND {similarity('last_name_l', 'last_name_r')} >= {t}"
          for t in (0.92, 0.88)],
        "last_name_l = last_name_r",
        "first_name_l = first_name_r",
    ]),
    "email": ("email_l IS NULL OR email_r IS NULL", [
        "email_l = email_r",
        f"{user('email_l')} = {user('email_r')}",
        f"{similarity('email_l', 'email_r')} >= 0.88",
        f"{similarity(user('email_l'), user('email_r'))} >= 0.88",
    ]),
    "postcode": ("postcode_l IS NULL OR postcode_r IS NULL", [
        "postcode_l = postcode_r",
        "split_part(postcode_l, ' ', 1) = split_part(postcode_r, ' ', 1)",
        "regexp_extract(postcode_l, '^[A-Za-z]+') = regexp_extract(postcode_r, '^[A-Za-z]+') AND regexp_extract(postcode_l, '^[A-Za-z]+') <> ''",
    ]),
    "phone": ("phone_l IS NULL OR phone_r IS NULL", ["phone_l = phone_r"]),
    "dob": ("dob_l IS NULL OR dob_r IS NULL", ["dob_l = dob_r"]),
}


def gamma_columns(names: list[str]) -> str:
    out = []
    for name in names:
        missing, levels = GAMMA[name]
        cases = " ".join(f"WHEN {cond} THEN {len(levels) - i}" for i, cond in enumerate(levels))
        out.append(f"CASE WHEN {missing} THEN -1 {cases} ELSE 0 END AS gamma_{name}")
    return ", ".join(out)


ALL = list(GAMMA)
CTES |= {
    "records": f"SELECT record_id, {', '.join(FIELDS)} FROM guests_raw",
    "candidates": f"""SELECT {BOTH_SIDES}, CASE {' '.join(f"WHEN {cond} THEN '{name}'" for name, cond in RULE_SQL.items())} END AS match_key
        FROM records l JOIN records r ON l.record_id < r.record_id AND ({' OR '.join(RULE_SQL.values())})""",
    "gammas": f"SELECT record_id_l, record_id_r, match_key, phone_l, {gamma_columns(ALL)} FROM candidates",
    "tf": """SELECT phone, count(*) / (SELECT count(phone) FROM records) AS tf_phone FROM records
        WHERE phone IS NOT NULL GROUP BY phone""",
    "prior": """SELECT count(*) AS rule_pairs, (SELECT count(*) FROM records) AS records,
        count(*) / 0.7 / ((SELECT count(*) FROM records) * ((SELECT count(*) FROM records) - 1) / 2) AS prior FROM candidates""",
    "drawn": """SELECT *, CAST('0x' || substr(md5(record_id), 1, 15) AS BIGINT) % (SELECT greatest(1, CAST(ceil(n * (n - 1) / 2 / 1000000) AS BIGINT))
        FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM records)) AS bucket FROM records""",
    "random_gammas": f"""SELECT {gamma_columns(ALL)} FROM (SELECT {BOTH_SIDES} FROM drawn l JOIN drawn r
        ON l.bucket = r.bucket AND l.record_id < r.record_id)""",
    "random_levels": " UNION ALL ".join(
        f"SELECT '{n}' AS comparison, gamma_{n} AS level, count(*) AS pairs FROM random_gammas WHERE gamma_{n} >= 0 GROUP BY 2"
        for n in ALL
    ),
    "u_probs": "SELECT comparison, level, pairs, pairs / sum(pairs) OVER (PARTITION BY comparison) AS u_prob FROM random_levels",
    "u_wide": "SELECT " + ", ".join(
        f"least({1 - FLOOR}, greatest({FLOOR}, coalesce(max(u_prob) FILTER (comparison = '{n}' AND level = {i}), 0))) AS u_{n}_{i}"
        for n in ALL for i in range(TOP[n] + 1)
    ) + " FROM u_probs",
}


def pick(name: str, value) -> str:
    """Value of the level a pair has reached, 1 where a side is missing."""
    cases = " ".join(f"WHEN {i} THEN {value(i)}" for i in range(TOP[name] + 1))
    return f"CASE gamma_{name} {cases} ELSE 1 END"


ROUNDS = 25
SESSIONS = {
    "email": ("l.email = r.email", ["name", "postcode", "phone", "dob"]),
    "postcode+last_name": ("l.postcode = r.postcode AND l.last_name = r.last_name", ["email", "phone", "dob"]),
}
_em = {session: f"em{i}" for i, session in enumerate(SESSIONS)}
for _session, (_cond, _names) in SESSIONS.items():
    _id = _em[_session]
    CTES[f"{_id}_patterns"] = f"""SELECT {', '.join(f'gamma_{n}' for n in _names)}, count(*) AS pairs FROM (SELECT {gamma_columns(_names)}
        FROM (SELECT {BOTH_SIDES} FROM records l JOIN records r ON {_cond} AND l.record_id < r.record_id)) GROUP BY ALL"""
    CTES[f"{_id}_0"] = "SELECT CAST(0.5 AS DOUBLE) AS share, " + ", ".join(
        f"CAST({p!r} AS DOUBLE) AS m_{n}_{i}" for n in _names for i, p in enumerate(starting_m(TOP[n]))
    )
    _hit = "share * " + " * ".join(f"({pick(n, lambda i, n=n: f'm_{n}_{i}')})" for n in _names)
    _miss = "(1 - share) * " + " * ".join(f"({pick(n, lambda i, n=n: f'u_{n}_{i}')})" for n in _names)
    for _round in range(1, ROUNDS + 1):
        _levels = ", ".join(
            f"least({1 - FLOOR}, greatest({FLOOR}, coalesce(sum(e) FILTER (gamma_{n} = {i}), 0) / sum(e) FILTER (gamma_{n} >= 0))) AS m_{n}_{i}"
            for n in _names for i in range(TOP[n] + 1)
        )
        CTES[f"{_id}_{_round}"] = f"""SELECT least({1 - FLOOR}, greatest({FLOOR}, sum(e) / sum(pairs))) AS share, {_levels}
            FROM (SELECT *, pairs * hit / (hit + miss) AS e FROM
              (SELECT *, {_hit} AS hit, {_miss} AS miss FROM {_id}_patterns, {_id}_{_round - 1}, u_wide))"""


def _averaged(name: str, level: int) -> str:
    held = [f"{_em[s]}.m_{name}_{level}" for s, (_, names) in SESSIONS.items() if name in names]
    return f"({' + '.join(held)}) / {len(held)}"


CTES["m_wide"] = "SELECT " + ", ".join(
    f"{_averaged(n, i)} AS m_{n}_{i}" for n in ALL for i in range(TOP[n] + 1)
) + " FROM " + ", ".join(f"{i}_{ROUNDS} {i}" for i in _em.values())


def scored_sql(m, u, prior: str, extra: str = "") -> str:
    weights = {n: f"log2(({pick(n, lambda i: m(n, i))}) / ({pick(n, lambda i: u(n, i))}))" for n in ALL}
    columns = ", ".join(f"{w} AS bf_{n}" for n, w in weights.items())
    total = f"log2({prior} / (1 - {prior})) + " + " + ".join(f"bf_{n}" for n in ALL) + " + bf_tf_phone"
    return f"""SELECT *, 1 / (1 + pow(2, -match_weight)) AS match_probability FROM (
        SELECT *, {total} AS match_weight FROM (
          SELECT g.*, {columns}, CASE WHEN gamma_phone = 1 THEN log2({u('phone', 1)} / tf_phone) ELSE 0 END AS bf_tf_phone{', prior' if extra else ''}
          FROM gammas g LEFT JOIN tf ON g.phone_l = tf.phone{extra}))"""


CTES["given_all"] = scored_sql(
    lambda n, i: repr(GIVEN_MODEL.m[n][i]), lambda n, i: repr(GIVEN_MODEL.u[n][i]), repr(GIVEN_MODEL.prior)
)
CTES["scored"] = "SELECT * FROM given_all WHERE match_probability >= 0.8"
CTES["learned_all"] = scored_sql(
    lambda n, i: f"m_{n}_{i}", lambda n, i: f"u_{n}_{i}", "prior", ", m_wide, u_wide, (SELECT prior FROM prior) AS learned_prior"
)
for _kind in ("given", "learned"):
    CTES |= {
        f"{_kind}_links": f"SELECT record_id_l AS a, record_id_r AS b FROM {_kind}_all WHERE match_probability >= 0.9",
        f"{_kind}_both": f"SELECT a, b FROM {_kind}_links UNION ALL SELECT b, a FROM {_kind}_links",
        f"{_kind}_spread(id, label)": f"""SELECT record_id, record_id FROM records UNION
            SELECT e.b, s.label FROM {_kind}_spread s JOIN {_kind}_both e ON e.a = s.id WHERE s.label < e.b""",
        f"{_kind}_map": f"SELECT id AS record_id, min(label) AS golden_id FROM {_kind}_spread GROUP BY id",
    }

_BARE = {key.split("(")[0]: key for key in CTES}


def compose(final: str) -> str:
    """``final`` with the subqueries it mentions, and those they mention, in front."""
    order: list[str] = []

    def need(sql: str, inside: str | None = None) -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN|,)\s+([a-z_0-9]+)", sql)):
            if word in _BARE and word != inside and word not in order:
                need(CTES[_BARE[word]], word)
                order.append(word)

    need(final)
    parts = [
        f"{_BARE[w]} AS {'' if '(' in _BARE[w] else 'MATERIALIZED '}({CTES[_BARE[w]]})" for w in order
    ]
    return f"WITH RECURSIVE {', '.join(parts)} {final}" if parts else final


def _compression(of: str) -> str:
    return f"""SELECT count(*) AS records, count(DISTINCT golden_id) AS golden_guests,
        round(count(*) / count(DISTINCT golden_id), 4) AS compression,
        (SELECT count(DISTINCT true_id) FROM guests_raw) AS true_guests FROM {of}"""


def _quality(of: str) -> str:
    return f"""SELECT count(*) AS true_groups, round(avg(CASE WHEN n = 1 THEN 1 ELSE 0 END) * 100, 1) AS pct_true_groups_fully_merged
        FROM (SELECT true_id, count(DISTINCT golden_id) AS n FROM guests_raw JOIN {of} USING (record_id) GROUP BY true_id)"""


def _pair_quality(of: str) -> str:
    return f"""SELECT round(hits / nullif(found, 0), 6) AS precision, round(hits / nullif(real, 0), 6) AS recall FROM (SELECT
        (SELECT count(*) FROM guests_raw a JOIN guests_raw b ON a.true_id = b.true_id AND a.record_id < b.record_id
         JOIN {of} g ON g.record_id = a.record_id JOIN {of} h ON h.record_id = b.record_id AND h.golden_id = g.golden_id) AS hits,
        (SELECT count(*) FROM {of} g JOIN {of} h ON h.golden_id = g.golden_id AND g.record_id < h.record_id) AS found,
        (SELECT count(*) FROM guests_raw a JOIN guests_raw b ON a.true_id = b.true_id AND a.record_id < b.record_id) AS real)"""


def _em_rows() -> str:
    parts = []
    for session, (_, names) in SESSIONS.items():
        parts += [(session, f"{_em[session]}_{ROUNDS}", n) for n in names]
    parts += [("model", "m_wide", n) for n in ALL]
    return " UNION ALL ".join(
        f"""SELECT '{session}' AS session, '{n}' AS comparison, CAST({i} AS INT) AS level,
            round(m_{n}_{i}, 5) AS m_prob, round(u_{n}_{i}, 9) AS u_prob FROM {source}, u_wide"""
        for session, source, n in parts for i in range(TOP[n] + 1)
    )


FINAL: dict[str, str] = {
    "guests_raw": "SELECT * FROM guests_raw",
    "bookings": "SELECT * FROM bookings",
    "party_members": "SELECT * FROM party_members",
    "transactions": "SELECT * FROM transactions",
    "members_golden": "SELECT * FROM members",
    "edges_attended": "SELECT * FROM attended",
    "edges_paid": "SELECT * FROM paid",
    "edges_all": "SELECT * FROM edges",
    "triplets": "SELECT * FROM triplets",
    "triplets_confidence": """SELECT g.record_id AS subject_id, g.golden_id AS object_id, 'kinweave' AS source_agent,
          round(coalesce(b.best, CAST(0.95 AS DOUBLE)), 6) AS confidence
        FROM guests_resolved g LEFT JOIN (SELECT id, max(match_probability) AS best FROM
          (SELECT record_id_l AS id, match_probability FROM scored UNION ALL SELECT record_id_r, match_probability FROM scored) GROUP BY id) b
        ON b.id = g.record_id""",
    "predicate_profile": "SELECT predicate, count(*) AS edges FROM triplets GROUP BY predicate ORDER BY edges DESC, predicate",
    "guest_names": "SELECT * FROM names",
    "edges_labeled": "SELECT * FROM labeled",
    "node_degree": "SELECT * FROM companions",
    "top_degree": """SELECT guest_id, name, degree FROM companions LEFT JOIN names ON golden_id = guest_id
        ORDER BY degree DESC, guest_id LIMIT 10""",
    "graph_vertices": "SELECT * FROM visit_vertices",
    "graph_size": "SELECT (SELECT count(*) FROM visit_vertices) AS vertices, (SELECT count(*) FROM visited) AS edges",
    "cohorts": "SELECT * FROM cohorts",
    "top_cohorts": "SELECT cohort_id, count(*) AS cohort_size FROM cohorts GROUP BY 1 ORDER BY cohort_size DESC, cohort_id LIMIT 10",
    "pagerank": "SELECT * FROM ranks",
    "top_influence": "SELECT * FROM ranks ORDER BY pagerank DESC, id LIMIT 10",
    "communities": "SELECT id, label FROM votes WHERE round = 5",
    "degree": "SELECT id, count(*) AS degree FROM (SELECT src AS id FROM visited UNION ALL SELECT dst FROM visited) GROUP BY id",
    "centrality": """SELECT id, degree, pagerank FROM visit_ranks JOIN
        (SELECT src AS id, 2 * count(*) AS degree FROM visited GROUP BY src) USING (id)""",
    "triangles": "SELECT v.id, count(c.id) AS count FROM visit_vertices v LEFT JOIN corners c ON c.id = v.id GROUP BY v.id",
    "triangles_coloured": "SELECT v.id, count(c.id) AS count FROM visit_vertices v LEFT JOIN corners c ON c.id = v.id GROUP BY v.id",
    "motif": """SELECT a.src AS a_id, a.dst AS b_id, p.dst AS c_id FROM visited a JOIN paid_edges p ON p.src = a.dst
        WHERE a.src <> p.dst AND p.src IN (SELECT id FROM visit_vertices) AND p.dst IN (SELECT id FROM visit_vertices)""",
    "khop": "SELECT depth, count(*) AS guests_reached FROM walk GROUP BY depth ORDER BY depth",
    "khop_paths": """SELECT depth, count(*) AS guests_reached FROM (SELECT * FROM walk
          UNION SELECT 4, d.dst FROM from_seed a JOIN visited b ON b.src = a.dst JOIN visited c ON c.src = b.dst JOIN visited d ON d.src = c.dst
          WHERE b.dst <> a.src AND c.dst <> a.src AND c.dst <> a.dst AND d.dst <> a.src AND d.dst <> a.dst AND d.dst <> b.dst)
        GROUP BY depth ORDER BY depth""",
    "cohorts_in_batches": "SELECT id, cohort_id FROM cohorts",
    "cohorts_resumed": "SELECT id, cohort_id FROM cohorts",
    "khop_paths_deep": "SELECT depth, count(DISTINCT guest) AS guests_reached FROM paths GROUP BY depth ORDER BY depth",
    "hop_histogram_sketched": """SELECT hops, count(*) AS pairs FROM (
          SELECT src, dst, min(hops) AS hops FROM apart GROUP BY src, dst) WHERE hops > 0 GROUP BY hops ORDER BY hops""",
    "khop_distance": """SELECT depth, count(*) AS guests_reached FROM
        (SELECT guest_id, min(depth) AS depth FROM walk GROUP BY guest_id) GROUP BY depth ORDER BY depth""",
    "two_hop": "SELECT * FROM hops",
    "two_hop_histogram": "SELECT hops, count(*) AS pairs FROM hops GROUP BY hops ORDER BY hops",
    "txn_cohort": "SELECT * FROM txn",
    "pass_holders": "SELECT * FROM pass_holders",
    "pass_holders_murmur": "SELECT * FROM murmur_holders",
    "predicate_glossary": """SELECT predicate, meaning, count(*) AS edges FROM triplets
        JOIN (VALUES ('VISITED_WITH', 'shared a party with'), ('PAID_FOR', 'paid a booking of'), ('RESOLVES_TO', 'is a record of'))
        AS glossary(predicate, meaning) USING (predicate) GROUP BY predicate, meaning""",
    "replaced_cohort_spend": """SELECT cohort_id, cohort_members AS members_before, cohort_members AS members, total_spend_gbp
        FROM cohort_spend""",
    "published_comments": "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, '{text}' AS column_comment, '{COHORT_VALUE_COMMENT}' AS view_comment, count({column}) AS known, "
        f"count(DISTINCT {column}) AS different FROM cohort_spend" for column, text in COHORT_VALUE_COLUMNS.items()
    ) + ")",
    "cohort_spend": "SELECT * FROM cohort_spend",
    "segment_summary": """SELECT segment, count(*) AS cohorts, round(avg(total_spend_gbp), 2) AS avg_cohort_spend_gbp,
        round(avg(total_spend_gbp / nullif(cohort_members, 0)), 2) AS avg_spend_per_member_gbp
        FROM cohort_spend GROUP BY segment ORDER BY segment""",
    "cohort_value": "SELECT cohort_id, segment, cohort_members, total_spend_gbp FROM cohort_spend",
    "published_cohort_value": """SELECT cohort_id, segment, cohort_members, total_spend_gbp, n AS guests
        FROM cohort_spend JOIN members_per_cohort USING (cohort_id)""",
    "metric_spend_grains": """SELECT CASE WHEN grouping(park) = 0 THEN 'park,year' WHEN grouping(year) = 0 THEN 'year' ELSE 'all' END AS grain,
          park, year, round(sum(amount_gbp), 2) AS spend_gbp, count(*) AS transactions, count(DISTINCT golden_id) AS guests,
          count(DISTINCT cohort_id) AS cohorts, true AS sketch_holds
        FROM (SELECT *, substr(txn_date, 1, 4) AS year FROM transactions JOIN guests_resolved USING (record_id) JOIN cohorts ON id = golden_id) t
        GROUP BY GROUPING SETS ((park, year), (year), ())""",
    "metric_cohort_value": """SELECT segment, round(sum(total_spend_gbp), 2) AS total_spend_gbp,
        count(DISTINCT cohort_id) AS cohorts, CAST(sum(cohort_members) AS BIGINT) AS members FROM cohort_spend GROUP BY segment""",
    "run_summary": """SELECT 'raw_source_records' AS stage, count(*) AS rows FROM guests_raw
        UNION ALL SELECT 'golden_guests', count(DISTINCT golden_id) FROM guests_resolved
        UNION ALL SELECT 'activity_cohorts', count(DISTINCT cohort_id) FROM cohorts
        UNION ALL SELECT 'cohort_spend_rows', count(*) FROM cohort_spend""",
    "er_candidates": "SELECT record_id_l, record_id_r, match_key FROM candidates",
    "er_name_similarity": " UNION ".join(
        f"""SELECT '{c}' AS field, least({c}_l, {c}_r) AS name_a, greatest({c}_l, {c}_r) AS name_b,
        round({similarity(f'{c}_l', f'{c}_r')}, 6) AS similarity FROM candidates""" for c in ("first_name", "last_name")
    ),
    "er_alike_in_district": f"""SELECT l.record_id AS record_id_l, r.record_id AS record_id_r, split_part(l.postcode, ' ', 1) AS district
        FROM guests_raw l JOIN guests_raw r ON split_part(l.postcode, ' ', 1) = split_part(r.postcode, ' ', 1)
          AND l.record_id < r.record_id
        WHERE {similarity('l.first_name', 'r.first_name')} >= 0.9 AND {similarity('l.last_name', 'r.last_name')} >= 0.9""",
    "er_gammas": f"SELECT record_id_l, record_id_r, {', '.join(f'gamma_{n}' for n in ALL)} FROM gammas",
    "er_term_freq": "SELECT phone, round(tf_phone, 9) AS tf_phone FROM tf",
    "er_prior": "SELECT rule_pairs, records, round(prior, 9) AS prior FROM prior",
    "er_u_probs": "SELECT comparison, level, pairs, round(u_prob, 9) AS u_prob FROM u_probs",
    "er_scored": f"""SELECT record_id_l, record_id_r, match_key, {', '.join(f'gamma_{n}' for n in ALL)},
        round(match_weight, 4) AS match_weight, round(match_probability, 6) AS match_probability FROM scored""",
    "er_explain": " UNION ALL ".join(
        f"""SELECT record_id_l, record_id_r, '{n}' AS comparison, gamma_{n} AS level,
        round(bf_{n}{' + bf_tf_phone' if n == 'phone' else ''}, 4) AS bits FROM scored""" for n in ALL
    ),
    "er_clusters": "SELECT * FROM given_map",
    "er_compression": _compression("given_map"),
    "er_quality": _quality("given_map"),
    "er_pair_quality": _pair_quality("given_map"),
    "er_em": _em_rows(),
    "er_learned_clusters": "SELECT * FROM learned_map",
    "er_learned_compression": _compression("learned_map"),
    "er_learned_quality": _quality("learned_map"),
    "q_spend_by_park": """SELECT park, year(CAST(txn_date AS DATE)) AS year, round(sum(amount_gbp), 2) AS total_spend_gbp
        FROM transactions GROUP BY 1, 2""",
    "q_pass_cohort_rank": """SELECT c.cohort_id, count(*) AS pass_holders, s.cohort_members, s.total_spend_gbp
        FROM pass_holders p JOIN cohorts c ON c.id = p.golden_id JOIN cohort_spend s ON s.cohort_id = c.cohort_id
        GROUP BY 1, 3, 4 ORDER BY s.total_spend_gbp DESC, c.cohort_id""",
    "q_influencers_top_cohorts": """SELECT * FROM (SELECT c.cohort_id, t.total_spend_gbp, c.id AS guest_id, r.pagerank,
          row_number() OVER (PARTITION BY c.cohort_id ORDER BY r.pagerank DESC, c.id) AS place
        FROM (SELECT * FROM cohort_spend ORDER BY total_spend_gbp DESC, cohort_id LIMIT 5) t
        JOIN cohorts c ON c.cohort_id = t.cohort_id JOIN ranks r ON r.id = c.id) WHERE place <= 3""",
    "q_within_two_hops": "SELECT * FROM hops WHERE guest_id = (SELECT seed FROM top_guest)",
    "q_companions_of_top": """SELECT src AS guest_id, dst AS companion_id, name AS companion_name
        FROM visited LEFT JOIN names ON golden_id = dst WHERE src = (SELECT seed FROM top_guest)""",
    "q_paid_for": """SELECT subject_id AS payer_id, subject_name AS payer_name, object_id AS guest_id, object_name AS guest_name
        FROM labeled WHERE predicate = 'PAID_FOR'""",
    "q_uplift": """SELECT round(avg(total_spend_gbp) FILTER (segment = 'has_pass_holder'), 2) AS avg_with_pass_gbp,
        round(avg(total_spend_gbp) FILTER (segment = 'no_pass_holder'), 2) AS avg_without_pass_gbp,
        round(avg(total_spend_gbp) FILTER (segment = 'has_pass_holder') - avg(total_spend_gbp) FILTER (segment = 'no_pass_holder'), 2) AS uplift_gbp
        FROM cohort_spend""",
    "q_spend_by_home_park": """SELECT home_park, count(*) AS spending_records, round(sum(spend), 2) AS total_spend_gbp, round(avg(spend), 2) AS avg_spend_gbp
        FROM (SELECT record_id, sum(amount_gbp) AS spend FROM transactions GROUP BY record_id) JOIN guests_raw USING (record_id) GROUP BY home_park""",
}

ORACLES = {name: compose(sql) for name, sql in FINAL.items()}
