import hashlib
import random
import re

import numpy as np
from loamflow.llm import pii as P
from loamflow.llm import secrets as S

DOCS = "doc_id long, text string, base string, found int, n_chars long"
SLOW = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def slow_patterns(text):
    out = []
    for kind, pattern in SLOW.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0,
                    "card": 14 <= len(digits) <= 19 and P.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return P.in_order(out)


def card(rnd):
    d = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
    return d + next(c for c in "0123456789" if P.luhn(d + c))


def test_patterns_match_the_plain_regexes():
    rnd = random.Random(1)
    bits = ["a", "b.c", "@", "@x.y", ".", "1", "12", "255", "256", "1.2.3.4", " ", "-", "+", "+1 (555) 555-0100", "é", "00", "x@y.z@w.v",
            "@-.-", "4111 1111 1111 1111", "4111111111111111", "(", ")", "%", "\n"]
    for _ in range(4000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))
        assert P.patterns(t) == slow_patterns(t), t
    assert P.patterns("0" * 6000 + "1.2.3.4")[0] == ("ip", 0, 6007)
    assert P.patterns("a" * 300_000 + "1" * 300_000) == []


def test_gradient():
    rnd = np.random.default_rng(2)
    net = P.Network.fresh()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    cls, tags = rnd.integers(0, P.CLASSES, (3, 6)).astype(np.int8), rnd.integers(0, P.TAGS, (3, 6)).astype(np.int8)
    _, grad = net.loss(cls, tags)
    for name, g in grad.items():
        i = tuple(rnd.integers(0, s) for s in g.shape) if name != "embed" else (int(cls[0, 0]), 1)
        keep = net.p[name][i]
        at = []
        for step in (1e-3, -1e-3):
            net.p[name][i] = keep + step
            at.append(net.loss(cls, tags)[0])
        net.p[name][i] = keep
        assert abs((at[0] - at[1]) / 2e-3 - g[i]) < 1e-3 * max(1, abs(g[i])), name


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(3)
    net = P.Network.fresh()
    net.p["trans"] = rnd.normal(0, 2, (P.TAGS, P.TAGS)).astype(np.float32)
    cls = rnd.integers(0, P.CLASSES, (1, 3)).astype(np.int8)
    e, _ = net.emissions(cls)
    score = lambda y: net.p["first"][y[0]] + sum(e[i, 0, y[i]] for i in range(3)) + sum(net.p["trans"][y[i], y[i + 1]] for i in range(2))
    best = max(((a, b, c) for a in range(P.TAGS) for b in range(P.TAGS) for c in range(P.TAGS)), key=score)
    assert tuple(net.decode(cls)[0][0]) == best


def test_windows_and_reconciling():
    c = P.classes("x" * 500 + "7" + "y" * 500)
    starts = P.window_starts(c)
    assert any(s <= 500 < s + P.WINDOW for s in starts) and all(s % P.STRIDE == 0 for s in starts) and len(starts) <= 4
    got = P.reconcile([("ip", 10, 20, 3.0, False), ("ip", 5, 20, 9.0, True), ("card", 18, 30, 4.0, True), ("card", 40, 50, 1.0, True)])
    assert got == [("ip", 5, 20, 9.0), ("card", 40, 50, 1.0)]


def corpus(n=320, seed=4):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghinorst") for _ in range(rnd.randint(1, 8)))
    make = [lambda: f"{word()}.{rnd.randrange(99)}@mail{rnd.randrange(9)}.example.com", lambda: ".".join(str(rnd.randrange(256)) for _ in range(4)),
            lambda: card(rnd), lambda: f"+1 ({rnd.randrange(100, 999)}) 555-{rnd.randrange(1000, 9999)}", lambda: str(rnd.randrange(10**6))]
    docs = []
    for i in range(n):
        w = [word() for _ in range(rnd.randint(10, 90))]
        for _ in range(rnd.randint(0, 2)):
            w.insert(rnd.randrange(len(w)), rnd.choice(make)())
        docs.append((i, " ".join(w)))
    return docs


def test_network_learns_the_spans(spark):
    docs = corpus()
    net = P.train(spark.createDataFrame([(t,) for _, t in docs], "text string"), 400)
    hit = total = extra = 0
    for _, text in corpus(120, seed=9):
        c = P.classes(text)
        starts = P.window_starts(c)
        spans = []
        if len(starts):
            w, sizes = P.windows(c, starts)
            tags, margin = net.decode(w)
            for k in range(len(starts)):
                spans += P.window_spans(tags[k], margin[k], int(starts[k]), int(sizes[k]), int(starts[k] + sizes[k]) == len(c))
        got = {s[:3] for s in P.reconcile(spans)}
        want = set(P.patterns(text))
        hit, total, extra = hit + len(got & want), total + len(want), extra + len(got - want)
    assert total > 60 and hit >= 0.85 * total and extra <= 0.2 * total, (hit, total, extra)


def test_operator(spark):
    docs = [*corpus(150), (500, None), (501, ""), (None, "mail x.1@mail1.example.com"), (3, corpus(4)[3][1]), (502, "word " * 40_000 + "10.0.0.1")]
    df = spark.createDataFrame([(*d, "b", 1, 2) for d in docs], DOCS).repartition(3)
    got = S.digest_columns(P.find_personal_data(df, 200), P.KINDS).collect()
    text = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    want = sorted((str(i), *(sum(s[0] == k for s in P.patterns(t or "")) for k in P.KINDS),
                   hashlib.sha256(text(P.patterns(t or "")).encode()).hexdigest()) for i, t in docs)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    by = {r.doc_id: r.spans.split(",") for r in got}
    assert all(set(text([s]) for s in P.patterns(t or "")) <= set(by[i]) for i, t in docs)
    assert P.find_personal_data(df.limit(0)).collect() == []
    assert {r.spans for r in S.digest_columns(P.find_personal_data(df.where("doc_id = 501")), P.KINDS).collect()} == {""}


def test_sample_holds_every_kind_where_other_digits_are_common(spark):
    rnd = random.Random(8)
    rare = ["mail x.1@mail1.example.com now", "host 10.20.30.40 up", f"paid {card(rnd)} once", "call +1 (555) 555-0100 today"]
    logs = [("\n" * rnd.randrange(9)).join(f"{rnd.randrange(1, 99999)}{rnd.choice(';:,/_')}{'ab' * rnd.randrange(9)}" for _ in range(60))
            for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in logs + rare * 2], "text string").repartition(3)
    drawn = P.draw(df, 40)
    rows = P.choose(drawn, 40)
    kinds = [k for _, tags in rows for k in P.strata(np.frombuffer(tags, np.int8))]
    assert set(kinds) == {0, 1, 2, 3, 4} and len(rows) == len(set(rows)) <= 40 and kinds.count(0) == 20
    assert len(drawn[0]) == 40 and all(drawn[1:])
    assert P.train(df, 40) is not None and P.train(df.where("text like '%;%'").limit(0), 40) is None
