import hashlib
import random
import re

import pytest

from pitlane.llm import pii as P

from .conftest import EDGES
from .llm_data import texts


def digits(s):
    return re.sub("[^0-9]", "", s)


def brute(t):
    """The contract's patterns as they stand."""
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in digits(m.group())][::-1]
        luhn = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d))
        if 14 <= len(d) <= 19 and luhn % 10 == 0:
            out.append((m.start(), "card", m.end()))
    out += [(m.start(), "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], P.KINDS.index(s[1])))


def test_base_equals_the_patterns(spark):
    rows = texts("sf0.01")
    got = {r.doc_id: r for r in P.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = brute(t)
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in want)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and got[i].spans == joined
        assert [got[i][f"n_{k}"] for k in P.KINDS] == [sum(s[1] == k for s in want) for k in P.KINDS]


def test_base_equals_the_patterns_on_random_strings():
    r = random.Random(4)
    for _ in range(20_000):
        t = "".join(r.choice("a1.@+- (25a0.") for _ in range(r.randint(0, 40)))
        assert P.detect(t) == brute(t), t


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("write john.doe [at] mail [dot] example (dot) com now", "email", "john.doe [at] mail [dot] example (dot) com"),
        ("mail jane at mail dot example dot com today", "email", "jane at mail dot example dot com"),
        ("x ｊｏｅ＠mail．com y", "email", "ｊｏｅ＠mail．com"),
        ("by jоhn＠mаil.com", "email", "jоhn＠mаil.com"),
        ("plus one two zero two five five five zero one four seven, thanks", "phone", "plus one two zero two five five five zero one four seven"),
        ("at one two seven dot zero dot zero dot one, locally", "ip", "one two seven dot zero dot zero dot one"),
        ("karte ４０００ 0000 0000 0002 ok", "card", "４０００ 0000 0000 0002"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, part):
    base, every = P.spans(text)
    assert (text.index(part), kind, text.index(part) + len(part)) in every
    assert base == brute(text) and set(base) <= set(every)


@pytest.mark.parametrize("text", ["Meet me at noon, or look at example.com", "one two three", "un deux dans la rue", "at the dot", "see you at 10.0.0.1 then"])
def test_prose_adds_nothing(text):
    base, every = P.spans(text)
    assert every == base == brute(text)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "@" * 100_000, "1." * 100_000, "one " * 40_000, "+1 " + "(" * 100_000, " dot " * 40_000])
def test_long_runs_stay_linear(text):
    P.spans(text)


@pytest.mark.parametrize("tail", ["now", "now (today)"])
@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("call plus 49 30 1234 5678 ", "phone", "plus 49 30 1234 5678"),
        ('"plus 1 202 555 0147" ', "phone", "plus 1 202 555 0147"),
        ("by ,PLUS\t49-30-1234-5678. ", "phone", "PLUS\t49-30-1234-5678"),
        ("mail jane at lapointe.com ", "email", "jane at lapointe.com"),
        ("at one two seven dot zero dot zero dot ſıx, ", "ip", "one two seven dot zero dot zero dot ſıx"),
    ],
)
def test_disguises_do_not_depend_on_other_characters(text, kind, part, tail):
    at = text.index(part)
    assert P.spans(text + tail) == ([], [(at, kind, at + len(part))])


def test_the_gate_loses_nothing(monkeypatch):
    """spans() with the gate equals spans() without it."""
    r = random.Random(5)
    words = [*P._NUMBERS, "plus", "Plus", "dot", "punkt", "point", "at", "arroba", "jane", "lapointe.com", "mydot.org", "mail", "com", "49", "30 1234 5678", "10.0.0", "ONE", "ſix", "fıve", "x"]
    gaps = [" ", " ", " ", " ", "-", "  ", ", ", ".", '"', "\n", "", "/", "\u3000", " ("]
    rows = ["".join(r.choice(words) + r.choice(gaps) for _ in range(r.randint(1, 9))) for _ in range(30_000)]
    rows += [t for _, t in texts("sf0.01")]
    gated = [P.spans(t) for t in rows]
    monkeypatch.setattr(P, "_may_hide", lambda t: True)
    assert gated == [P.spans(t) for t in rows] and any(len(every) > len(base) for base, every in gated)


def test_edges(edge_docs, no_docs):
    got = P.find_pii(edge_docs).collect()
    assert len(got) == edge_docs.count() and P.find_pii(no_docs).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[0].spans == "" and by[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert all(by[k].base_sha256 == hashlib.sha256(P.joined(brute(t or "")).encode()).hexdigest() for k, t in enumerate(EDGES))
