import hashlib
import random
import re

from helpers import collected

from shelfcast.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def base(text):
    def digits(s):
        return re.sub(r"[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_match_the_patterns():
    rng = random.Random(4)
    seen = 0
    for _ in range(20_000):
        t = "".join(rng.choice(("a", "b", ".", "@", "-", "+", " ", "1", "25", "0", "4111 1111 1111 1111", "é", "(")) for _ in range(rng.randrange(25)))
        assert P.base_spans(t) == base(t), t
        seen += bool(base(t))
    assert seen > 1000
    assert P.base_spans("1.2.3." + "0" * 5000 + "9") == [(0, 1, 5007)]


def names(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    seeds = [(i, f"please call the office line +1 (5{i:02}) 555-01{i:02} before noon {i}", "x") for i in range(8)]
    unseen = [(20, "please call the office line 555 867 5309 before noon", "x"), (21, "the weight was 555 867 9999 grams", "x")]
    odd = [(30, None, "x"), (31, "", "x"), (32, "é mail me@example.org", "x"), (32, "é mail me@example.org", "x")]
    docs = spark.createDataFrame(seeds + unseen + odd, "doc_id long, text string, spans string").repartition(3)
    got = collected(P.personal_data(docs))
    for i, t, _ in seeds + unseen + odd:
        spans = base(t or "")
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(names(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[1] for s in spans) for k in range(4)]
        if i != 20:
            assert r.spans == names(spans)
    start = unseen[0][1].index("555")
    assert got[20].spans == f"phone:{start}:{start + 12}"


def test_one_trusted_context_is_enough_and_accepted_identifiers_are_seeds(spark):
    seeds = [(i, f"please call the office line +1 (5{i:02}) 555-01{i:02} before noon {i}") for i in range(8)]
    # another word on the right, and a value that also occurs elsewhere
    near = [(20 + i, f"please call the office line 555 867 530{i} soon") for i in range(4)] + [(30, "odd weight was 555 867 5300 grams")]
    # four values found by their first context support a second one
    hop = [(40 + i, f"my desk number 555 867 530{i} today") for i in range(4)] + [(50, "my desk number 555 444 3322 always"), (51, "some other number 555 444 3399 always")]
    docs = spark.createDataFrame(seeds + near + hop, "doc_id long, text string").repartition(3)
    got = collected(P.personal_data(docs))
    for i, t in near + hop:
        start = t.index("555")
        assert got[i].spans == ("" if i == 51 else f"phone:{start}:{start + 12}"), t


def test_long_text_and_empty_table(spark):
    text = "word " * 200_000 + "a@b.cd " + "9" * 100_000 + " " + "x" * 100_000 + "@"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = P.personal_data(docs).first()
    assert r.n_email == 1 and r.spans == "email:1000000:1000006"
    assert P.personal_data(docs.limit(0)).count() == 0


def test_units_and_patterns_around_a_span():
    t = 'let me set token = "ab12cd" now, tel:555 9\n$$$ 7'
    a = t.index("ab12cd")
    assert P.units(t, a, -1, 3) == ['"', "= ", "token "] and P.units(t, a + 6, 1, 1) == ['"']
    # of '= "_', '"_"', '= "_"' and this one only this one has a word
    assert P.patterns(t, a, a + 6) == ['token = "_']
    b = t.index("555")
    assert P.patterns(t, b, b + 3) == ["tel:_", ", tel:_", "tel:_ 0"]
    c = t.index("7")
    assert P.units(t, c, -1, 3) == ["$$$ ", "0 ", "0 "] and P.patterns(t, c, c + 1) == []
    assert P.units("w" * 500 + "7", 500, -1, 3) == ["w" * 500]


def test_candidates_are_whole_tokens():
    def found(t):
        return sorted(t[a:b] for a, b in P.candidates(t))
    assert found('x "04dbebab91ab85687d33eeaa" y') == ["04dbebab91ab85687d33eeaa"]
    assert found("call (017) 555-7713, or 12 of it.") == ["(017) 555-7713", "12"]
    assert found("id=AB-99/7. end") == ["id=AB-99/7"]
    long = "u" * 80 + "(at)" + "v" * 90 + " w"
    assert found(long) == [long[:-2]] and found("a" * 300 + "@" + "b" * 300) == ["a" * 300 + "@" + "b" * 300]
    assert P.key_spans("k " + "a1" * 16 + " " + "a1" * 65 + " " + "7" * 40 + " " + "z" * 40) == [(2, 4, 34)]


def accepted_by_hand(edges, rounds=P.ROUNDS, confidence=P.CONFIDENCE, support=P.SUPPORT):
    """The scoring of the docstring over dictionaries."""
    kinds = range(len(P.KINDS))
    seeds, open_ = {}, {}
    for p, v, k in edges:
        (seeds if k >= 0 else open_).setdefault(p, set()).add((v, k))
    values = {}
    for p, some in open_.items():
        for v, _ in some:
            values.setdefault(v, set()).add(p)

    def fits(v, k):
        if k == 0:
            return "@" in v or re.search(r"[\[(]at[\])]", v) is not None
        if k == P.SECRET:
            return len(v) >= 8 and not re.search(r"[\s@]", v)
        return len(re.findall("[0-9]", v)) >= 6 and not any(c.isalpha() or c == "@" for c in v)
    accepted = {}
    while True:
        scores = {v: [float(k == found) for k in kinds] for v, found in accepted.items()}
        for _ in range(rounds):
            trusted = {}
            for p, some in open_.items():
                own = seeds.get(p, set())
                sums = [sum(scores.get(v, [0.0] * len(P.KINDS))[k] for v, _ in some) + sum(s == k for _, s in own) for k in kinds]
                sup = [sum(accepted.get(v) == k for v, _ in some) + sum(s == k for _, s in own) for k in kinds]
                if max(sup) >= support:
                    trusted[p] = [sums[k] / (len(some) + len(own)) if sup[k] >= support else 0.0 for k in kinds]
            new = {v: [sum(trusted[p][k] for p in ps if p in trusted) / n for k in kinds] for v, ps in values.items() if (n := sum(p in trusted for p in ps))}
            scores = {**new, **{v: [float(k == found) for k in kinds] for v, found in accepted.items()}}
        more = dict(accepted)
        for v, s in scores.items():
            best = max(kinds, key=lambda k: (s[k], k))
            if v not in accepted and s[best] >= confidence and fits(v, best):
                more[v] = best
        if len(more) == len(accepted):
            return accepted
        accepted = more


def test_scoring_against_plain_python(spark):
    rng = random.Random(12)
    kinds = ["me{}@host", "10.0.0.{}", "41111111{}", "+1 555 010 {}", "deadbeef00{}"]
    edges = set()
    for k in range(5):
        for i in range(12):                                     # seeds in a few contexts
            edges.add((f"c{k}{rng.randrange(2)} _", kinds[k].format(1000 + i), k))
        for i in range(10):                                     # candidates, some in contexts of another kind
            v = kinds[k].format(2000 + i) if k else f"you{i}@localhost"
            edges |= {(f"c{k if rng.random() < 0.9 else (k + 1) % 5}{rng.randrange(2)} _", v, -1), (f"d{k}{i // 6} _", v, -1)}
        for i in range(3):                                      # a second hop
            edges.add((f"d{k}{i % 2} _", kinds[k].format(3000 + i) if k else f"they{i}@there", -1))
    edges |= {("c00 _", "nothing1", -1), ("alone _", "x9", -1), ("seed only _", "z@z", 0)}
    want = accepted_by_hand(edges)
    df = spark.createDataFrame(sorted(edges), "pattern string, value string, kind int").repartition(3)
    got = {r.v: r.found for r in P.confident_instances(df).collect()}
    assert got == want and len(set(want.values())) == 5 and any(v.endswith("3000") for v in want)
    # frequent values and patterns are joined apart, to the same end
    import shelfcast.llm.common as common
    before, common.frequent.__defaults__ = common.frequent.__defaults__, (100, 2)
    try:
        assert {r.v: r.found for r in P.confident_instances(df).collect()} == want
    finally:
        common.frequent.__defaults__ = before


def test_secrets_are_seeds_and_their_context_finds_others(spark):
    rng = random.Random(3)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(6)]
    seeds = [(i, f'w{rng.random():.0f} some token = "{h}" words') for i, h in enumerate(hexes)]
    unseen = [(20, 'other token = "short-9x77" here'), (21, 'the size = "short-9x78" here'), (22, "no (at) at all"), (23, "mail to someone(at)example for it")]
    got = collected(P.personal_data(spark.createDataFrame(seeds + unseen, "doc_id long, text string").repartition(2)))
    for i, t in seeds:
        a = t.index(hexes[i])
        assert got[i].spans == f"secret:{a}:{a + 40}" and got[i].n_spans == 1
    a = unseen[0][1].index("short")
    assert got[20].spans == f"secret:{a}:{a + 10}" and got[21].spans == got[22].spans == got[23].spans == ""
