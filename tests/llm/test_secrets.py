import hashlib
import random
import re

from helpers import awkward, docs_of

from keelson.llm import secrets as sc

AWS = "AKIA" + "Q1" * 8
CASES = [
    (20, "password=hunter2hunter2, Passwd: 'abcdefgh' TOKEN := \"x\" and token: secret: abcdefghijk"),
    (21, "AKIA1 " + AWS + "ZZ é " + "ab" * 20 + " " + "0f" * 15),
    (22, "Secret=" + AWS + " api_key = '" + "9e" * 16 + "' paſsword=abcdefgh12 toKen=abcdefgh12"),
    (23, 'part = "gH7kLm2Qx9Zt"\ndb.connectionPwd = part + "Ww81vvP0"\nfirst_name = "Jonathan Peterson"\n'),
    (24, '{"client_secret": "d8Fk2jLq0PzX7Yw", "note": "nothing to see here"}\nprivate-key: Zx81kPq0Vb72LmQa\n'),
    (25, "run --auth-token q8Zk2LmX0pWv91Tt --verbose\nkey = value\npassword: ${DB_PASSWORD}\n"),
    (26, "token token=abcdefgh12: xyzabcdefgh"),
]


def brute(text):
    text = text or ""
    both = "".join
    alternatives = "|".join(both(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(f"""({alternatives})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def test_base_spans_against_brute_force(spark):
    docs = awkward() + CASES
    got = sc.op3(docs_of(spark, docs)).collect()
    want = []
    for i, t in docs:
        b = brute(t)
        want.append((i, *(sum(k == kind for k, _, _ in b) for kind in ("assign", "access", "hex")),
                     hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    for r in got:  # base spans stay among all spans
        own = [x for x in r["spans"].split(",") if x and not x.startswith("literal")]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r["base_sha256"]


def test_lexer_finds_assigned_and_propagated_literals():
    found = lambda t: {t[s:e] for _, s, e in sc.lexed_spans(t, 0.45)}
    assert found(CASES[3][1]) == {"gH7kLm2Qx9Zt", "Ww81vvP0"}
    assert found(CASES[4][1]) == {"d8Fk2jLq0PzX7Yw", "Zx81kPq0Vb72LmQa"}
    assert found(CASES[5][1]) == {"q8Zk2LmX0pWv91Tt"}
    assert not found("The token: a word. My key = value; monkey: banana")


def test_redaction_leaves_no_base_span(spark):
    docs = awkward() + CASES
    for r in sc.scan_secrets(docs_of(spark, docs)).collect():
        assert (r["clean"] is None) == (not r["spans"])
        assert not brute(r["clean"])
    assert sc.op3(docs_of(spark, docs).limit(0)).count() == 0


def test_chained_constants_cost_no_more_than_their_lines():
    doubled = "key = 'aB3dE6gH9'\n" + "key = key + key\n" * 300 + "password = key\n"
    assert [doubled[s:e] for _, s, e in sc.lexed_spans(doubled, 0.45)] == ["aB3dE6gH9"]
    grown = "part = 'aB3$'\n" + "".join(f"part = part + 'x{i}Qz'\n" for i in range(20_000)) + "api_key = part\n" * 20_000
    assert len(sc.lexed_spans(grown, 0.45)) == 20_001


def test_a_literal_adds_up_as_its_text_does():
    rng = random.Random(2)
    pieces = ["", " ", "x", "X" * 40, "a b", "your ", "<tag", ">", "${A}", "9zQ$", "line\n", "....", "**", "pass word", "{{", "}}", "q7" * 50]
    for _ in range(3000):
        some = [rng.choice(pieces) for _ in range(rng.randrange(1, 7))]
        whole = sc.Literal.of("".join(some), 0, 1)
        added = sc.Literal.of(some[0], 0, 1)
        for p in some[1:]:
            added = added + sc.Literal.of(p, 0, 1)
        assert whole._replace(parts=()) == added._replace(parts=(), counts=sc.Counter(added.counts))
        value = "".join(some)
        assert added.placeholder() == bool(sc.PLACEHOLDER.match(value)) or len(value) > sc.HEAD and "\n" in value
