"""Operators, whole queries and stages against plain Python and DuckDB."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helixframe.llm import chat, components, jaccard, langid, mixing, ordinal, packing, pii, quality_rules, queries, topk, toxicity
from helixframe.llm.features import Rows, sigmoid
from helixframe.llm.words import Words

D = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(t):
    return WORD.findall(t or "")


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, name):
    df = queries.QUERIES[name](spark, D)
    con = duckdb.connect()
    for p in Path(D).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cur = con.execute(queries.SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(([plain(v) for v in r] for r in df.select(*names).collect()), key=repr) == sorted(([plain(v) for v in r] for r in cur.fetchall()), key=repr)


# --- quality rules ---------------------------------------------------------------------------


def rules_of(text):
    t = text or ""
    w = words(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(win)
    covered = {i + o for i, x in enumerate(win) if many[x] > 1 for o in range(3)}
    n, rep, chars, sym = len(w), len(covered), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t)
    base = n < 50 or 100 * rep > 50 * n
    return (n, chars, sym, dup, rep), base, 10 * sym > n or 3 * rep > n or chars < 2 * n or chars > 15 * n or 50 * dup > n


def strict_hosts(rows):
    per = defaultdict(list)
    for host, text in rows:
        _, base, soft = rules_of(text)
        per[host].append(base or soft)
    raw = [sum(x) / len(x) for x in per.values()]
    m = sum(raw) / len(raw)
    v = sum((r - m) ** 2 for r in raw) / len(raw)
    k = min(max(m * (1 - m) / v - 1, 1.0), 1e9) if v > 0 else 1e9
    return {h for h, x in per.items() if (sum(x) + m * k) / (len(x) + k) > m + quality_rules.SPREAD * math.sqrt(m * (1 - m) / (k + 1))}


def test_rules_and_host_verdicts_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    strict = strict_hosts([(r.source, r.text) for r in rows])
    want = {}
    for r in rows:
        numbers, base, soft = rules_of(r.text)
        want[r.doc_id] = (*numbers, base, not base and not (soft and r.source in strict))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality_rules.judge(spark, docs).collect()}
    assert got == want
    # the host's verdict acts, and not everywhere
    assert strict and len(strict) < len({r.source for r in rows})
    assert any(not base and not kept for *_, base, kept in want.values())
    kept = corpus_pipeline.rules(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, x in want.items() if x[-1])


# --- Jaccard join ----------------------------------------------------------------------------


def components_of(rows, k, num):
    """Smallest id reachable by links, all pairs compared."""
    sets = {}
    for i, t in rows:
        w = words((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("power", range(3, 17))
def test_words_of_structure_differ(power):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << power))
    two = one.translate(str.maketrans("ab", "ba"))
    h = Words([x.encode() for x in (one, two, one.upper(), one + "a", "a" + one)]).hashes()
    assert h[0] == h[2] and len(set(h.tolist())) == 4


def test_texts_of_structure_do_not_link(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    two = one.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"x {one} y z"), (4, f"x {two} y z"), (5, one.upper())], "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark, docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def hot_docs():
    """A phrase in every text, groups of near copies, a hub with many near copies."""
    rng = np.random.default_rng(3)
    rows, phrase = [], "the same five words here again"
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(60)]
        for _ in range(12 if g else 60):
            w = list(base)
            w[int(rng.integers(60))] = f"r{rng.integers(10**9)}"
            rows.append((len(rows), f"{phrase} {' '.join(w)} {phrase}"))
    rows += [(len(rows) + i, f"{phrase} only {i} {phrase}") for i in range(40)]
    return rows


@pytest.mark.parametrize("hot,copies", [(1024, 1024), (4, 3)])
def test_hot_shingles_and_hubs(spark, monkeypatch, hot, copies):
    monkeypatch.setattr(components, "HOT", hot)
    monkeypatch.setattr(jaccard, "COPY_PAIRS", copies)
    rows = hot_docs()
    got = jaccard.jaccard_components(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components_of(rows, 3, 80)


def test_signatures_that_collide_are_replaced():
    texts = [f"a b c {i}".encode() for i in range(50)]
    size, sig, other = jaccard._signatures(50, *Words(texts).shingles(3))
    assert len(set(sig.tolist())) == len(set(other.tolist())) == 50
    settled = jaccard._settled(np.full(50, 7), other, np.array([7]))
    assert (settled == other).all() and (jaccard._settled(sig, other, np.array([7])) == sig).all()


def test_join_with_colliding_signatures(spark, monkeypatch):
    """First signatures of two bits: the second ones tell the sets apart, also in the stage."""
    docs = spark.createDataFrame([(i, f"w{i // 2} x{i // 2} y{i // 2} z") for i in range(24)], "doc_id bigint, text string")
    real = jaccard._signatures

    def few(n, doc, h):
        size, sig, other = real(n, doc, h)
        return size, np.where(size > 0, sig & 3, 0), other

    monkeypatch.setattr(jaccard, "_signatures", few)
    try:
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark, docs).collect()}
    finally:
        monkeypatch.undo()
    assert got == {i: i // 2 * 2 for i in range(24)}


def test_components_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT", 5)
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000, 1001 + i) for i in range(30)] + [(2000 + i, 2001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            u, v = find(a), find(b)
            root[max(u, v)] = min(u, v)
    got = {r.node: r.root for r in components.components(spark, spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in root}


# --- chat ------------------------------------------------------------------------------------


def fold(events):
    """The log of one conversation, event by event: {(turn, message): [role, text]} in order."""
    said, opened = {}, Counter()
    for _, turn, kind, role, text in sorted(events, key=lambda e: e[0]):
        if kind == "regenerate":
            for key in [k for k in said if k[0] > turn]:
                del said[key]
            for t in [t for t in opened if t > turn]:
                del opened[t]
        if kind == "message":
            opened[turn] += 1
        key = (turn, opened[turn])
        if key not in said:
            said[key] = [role or "", ""]
        said[key][1] = (said[key][1] if kind == "delta" else "") + (text or "")
    return [tuple(said[k]) for k in sorted(said)]


def test_event_logs_by_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for conv in range(40):
        for seq in range(int(rng.integers(1, 30))):
            kind = ("message", "delta", "delta", "edit", "regenerate")[int(rng.integers(5))]
            rows.append((conv, seq, int(rng.integers(0, 4)), kind, ("user", "assistant", None)[int(rng.integers(3))], (f"{seq}<s>\\", None, "[INST]é🙂")[int(rng.integers(3))]))
    df = chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, seq int, turn int, kind string, role string, text string")).persist()
    by = defaultdict(list)
    for c, *e in rows:
        by[c].append(e)
    want = {c: fold(e) for c, e in by.items()}
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in df.select("conv_id", chat.parse(F.col("formatted")).alias("turns")).collect()}
    assert got == want
    loss = defaultdict(list)
    for r in chat.masked_texts(df).orderBy("conv_id", "at").collect():
        loss[r.conv_id].append(r.text)
    assert {c: x for c, x in loss.items()} == {c: x for c in want if (x := [t for role, t in want[c] if role == "assistant"])}
    for r in df.collect():
        for s in r.loss_spans:
            assert "<s>" not in r.formatted[s.start : s.start + s.length]


def test_long_conversation(spark):
    n = 20_000
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("abc "), 38).alias("text"))
    df = chat.format_chats(chat.event_log(rows)).persist()
    assert df.select(F.size("loss_spans")).first()[0] == n // 2
    assert chat.masked_texts(df).where(F.col("text") == "abc " * 38).count() == n // 2


# --- language --------------------------------------------------------------------------------


def test_filters_against_direct_convolution():
    rng = np.random.default_rng(2)
    net = langid.ByteCNN(["a", "b", "c"], seed=4)
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (1, 2, 3, 511, 512, 513, 1500, 4000)]
    got = net.predict(texts, net.tables(), step=1000)
    for t, p in zip(texts, got):
        raw = np.frombuffer(t + b"\0" * 8, np.uint8)
        parts = []
        for lo in range(0, len(t), langid.WINDOW):
            at = np.arange(lo, min(lo + langid.WINDOW, len(t)))
            top = np.concatenate([sum(c[k][raw[at + k]] for k in range(len(c))).max(0) for c in net.conv])
            parts.append(langid.softmax((np.maximum(top + net.bias, 0) @ net.out + net.out_bias)[None])[0])
        assert np.allclose(p, np.mean(parts, 0), atol=1e-5)


def test_gradients_of_the_network():
    rng = np.random.default_rng(6)
    net = langid.ByteCNN(["a", "b"], seed=1)
    x, y = rng.integers(97, 105, (5, 40)).astype(np.uint8), np.array([0, 1, 0, 1, 1])

    def loss():
        top = [sum(c[k][x[:, k : x.shape[1] - len(c) + 1 + k]] for k in range(len(c))).max(1) for c in net.conv]
        p = langid.softmax(np.maximum(np.concatenate(top, 1) + net.bias, 0) @ net.out + net.out_bias)
        return -np.log(p[np.arange(5), y]).mean()

    for p, g in zip(net.params(), net.gradients(x, y)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = p[at], 1e-2
        p[at] = old + e
        up = loss()
        p[at] = old - e
        down = loss()
        p[at] = old
        assert math.isclose((up - down) / (2 * e), g[at], rel_tol=0.15, abs_tol=1e-3)


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op2_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    assert len(got) > 100 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_languages_under_repeated_ids_and_many_languages(spark):
    rows = [(0, f"der und die {i} das nicht ein", "de") for i in range(3000)] + [(i, f"the and of {i} that is not", "en") for i in range(500)]
    x, names = langid.sample(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    per = Counter(names)
    assert per["de"] == langid.PER_LANG * langid.WINDOWS and set(per) == {"de", "en"} and len(x) == len(names)
    many = spark.createDataFrame([(i, f"text {i} of its own", f"l{i % 700}") for i in range(4200)], "doc_id bigint, text string, lang string")
    _, names = langid.sample(spark, many, total=1400)
    assert len(set(names)) == 700 and max(Counter(names).values()) <= 2 * langid.WINDOWS
    copies = spark.createDataFrame([(i, "one text", "aa") for i in range(300)], "doc_id bigint, text string, lang string")
    assert len(langid.sample(spark, copies)[0]) == langid.WINDOWS


# --- classifiers -----------------------------------------------------------------------------


def test_risk_of_positive_unlabelled_learning():
    """The weights minimize prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), computed here anew."""
    rng = np.random.default_rng(0)
    size, prior = 1 << toxicity.BITS, 0.2

    def text(toxic):
        return np.unique(np.append(rng.integers(0, 200, 20), 1000 + np.flatnonzero(rng.random(6) < (0.7 if toxic else 0.02))))

    p = [text(True) for _ in range(200)]
    u = [text(rng.random() < prior) for _ in range(800)]
    model = toxicity.fit(p, u, prior)

    def risk(weight, bias):
        z = lambda rows: np.array([weight[r].sum() + bias for r in rows])
        soft = lambda v: np.logaddexp(0, v).mean()
        return prior * soft(-z(p)) + max(0.0, soft(z(u)) - prior * soft(z(p)))

    w = np.zeros(size)
    w[:] = model.weight
    here = risk(w, model.bias)
    assert here < 0.8 * risk(np.zeros(size), math.log(prior / (1 - prior)))
    assert min(risk(0.5 * w, model.bias), risk(w, model.bias - 1), risk(w, model.bias + 1)) > here
    assert (w[1000:1006] > 0).all()


def test_ordinal_likelihood_thresholds_and_grades():
    rng = np.random.default_rng(1)
    n = 300
    rows = [np.unique(rng.integers(0, 30, 5)) for _ in range(n)]
    x = Rows(rows, [np.ones(len(r)) for r in rows])
    true = rng.normal(0, 1, 30)
    z = np.array([true[r].sum() for r in rows])
    y = np.digitize(z + rng.logistic(0, 0.3, n), [-1.0, 0.0, 1.0])
    m = ordinal.fit(x, y, [0, 1, 2, 3])
    assert (np.diff(m.thresholds) > 0).all()

    def nll(weight, cut):
        tail = np.concatenate([np.ones((n, 1)), sigmoid(x.dot(weight)[:, None] - cut[None]), np.zeros((n, 1))], 1)
        return -np.log(np.maximum(tail[np.arange(n), y] - tail[np.arange(n), y + 1], 1e-12)).mean()

    w = m.weight.astype(float)
    here = nll(w, m.thresholds)
    assert here < 0.75 * nll(np.zeros_like(w), np.array([-1.0, 0.0, 1.0]))
    for i in range(3):
        for step in (-0.5, 0.5):
            moved = m.thresholds.copy()
            moved[i] += step
            assert nll(w, moved) > here - 1e-4
    tail = sigmoid(x.dot(w)[:, None] - m.thresholds[None])
    assert np.corrcoef(tail.sum(1), y)[0, 1] > 0.8


def test_grades_of_unknown_toxicity(spark):
    text = lambda good, i: " ".join(f"{'fine' if good else 'junk###'}{i % 7} word{j}" for j in range(30))
    docs = spark.createDataFrame([(i, text(i % 2, i)) for i in range(200)], "doc_id bigint, text string")
    ratings = spark.createDataFrame([(i, i % 2 * 2) for i in range(200)], "doc_id bigint, grade int")
    got = {r.doc_id: r for r in ordinal.rate(docs, ordinal.train(spark, docs, ratings)).collect()}
    assert np.mean([got[i].kept == bool(i % 2) for i in got]) > 0.95
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in got.values())


# --- personal data ---------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_of(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in EMAIL.finditer(t)], "ip": [m.span() for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(t) if 13 <= len(digits(m[0])) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits(m[0])))) % 10 == 0],
        "phone": [m.span() for m in PHONE.finditer(t) if 9 <= len(digits(m[0])) <= 15],
    }


def test_pii_query_by_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    got = pii.op9_pii(spark, D).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    kinds = Counter()
    for r in got:
        base = base_of(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(v) for v in base.values())
        line = ",".join(f"{k}:{a}:{b}" for k, v in base.items() for a, b in v)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert spans[: line.count(":") // 2] == [s for s in line.split(",") if s] and len(spans) == len([s for s in r.scores.split(",") if s])
        kinds.update(s.split(":")[0] for s in spans)
    assert kinds["email"] and kinds["card"]


@pytest.mark.parametrize(
    "text,kind,score",
    [
        ("DE89 3704 0044 0532 0130 00 2024", "iban", 0.7), ("DE89 3704 0044 0532 0130 00 is my bank account", "iban", 1.0), ("a sample: DE89370400440532013000", "iban", None),
        ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "secret", 0.6), ('"04dbebab91ab85687d33eeaaf9ac699e1188f962"', "secret", None), ("api key=abcdefghij0123456789xyz", "secret", 0.6),
        ("GB82 WEST 1234 5698 7654 32 EUR 100", "iban", 0.7), ("ssn 219-09-9999", "ssn", 0.6), ("219-09-9999 is the ssn", "ssn", 0.6), ("219-09-9999", "ssn", None), ("mail x@example.com token: 1234567890abcdefghij", "secret", 0.6),
    ],
)
def test_context_decides(text, kind, score):
    found = pii.all_spans(text)[kind]
    assert [pii.score(kind, text, *s) for s in found] == ([] if score is None else [score])


def test_redaction_leaves_no_span(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in corpus_pipeline.personal_data(spark, docs, D).collect():
        t = texts[r.doc_id]
        spans = sorted(s for v in pii.all_spans(t or "").values() for s in v)
        if not spans:
            assert r.text == t
            continue
        assert not any(t[a:b] in r.text for a, b in spans if b - a > 12) and r.n_chars == len(r.text)


# --- mixing ----------------------------------------------------------------------------------


def mixed(rows, weights=(5, 2, 1), most=3.0):
    """(id, source, text) to taken words per row, by sorting every source."""
    size = {}
    for s in {s for _, s, _ in rows}:
        size[s] = sum(len(words(t)) for _, x, t in rows if x == s)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, target, open_ = sum(size.values()), {}, set(order)
    left = total
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * size[s]}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = most * size[s]
        left -= sum(most * size[s] for s in full)
        open_ -= full
    out, seen = [], Counter()
    for s in order:
        mine = []
        for i, x, t in rows:
            if x == s:
                n = len(words(t))
                digest = hashlib.md5(t.encode()).hexdigest() if t is not None else ""
                seen[i, x, t] += 1
                u = int(hashlib.md5(f"mix:{'' if i is None else i}:{digest}:{seen[i, x, t]}".encode()).hexdigest()[:13], 16) / 2**52
                mine.append([i, n, (n.bit_length() if n else 0) + mixing.FLOOR, u])
        lo, hi = 0.0, 3.0 / mixing.FLOOR
        for _ in range(200):  # the level by bisection
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(most, mid * c) * n for _, n, c, _ in mine) < target[s] else (lo, mid)
        expected = [min(most, lo * c) for _, _, c, _ in mine]
        whole = [int(e + 1e-9) for e in expected]
        rest = target[s] - sum(k * n for k, (_, n, _, _) in zip(whole, mine))
        ranked = sorted((u / (1 - u) / ((e - k) / (1 - e + k)), j) for j, (e, k, (_, n, _, u)) in enumerate(zip(expected, whole, mine)) if n and e - k > 1e-9)
        used, extra = 0, set()
        for _, j in ranked:
            if used + mine[j][1] / 2 > rest:
                break
            used += mine[j][1]
            extra.add(j)
        out += [(i, n, round(target[s], 4), (k + (j in extra)) * n) for j, (k, (i, n, _, _)) in enumerate(zip(whole, mine))]
    return sorted(out, key=repr)


def test_mix_by_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "source", "text")
    rows = [tuple(r) for r in docs.collect()] + [(None, "src1", "same words in all"), (None, "src1", "same words in all"), (100_007, None, "one two three"), (100_008, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = sorted(((r.doc_id, r.size, round(r.target, 4), r.taken) for r in mixing.mix(spark, df).collect()), key=repr)
    assert got == mixed(rows)
    taken = Counter(r.doc_id for r in mixing.apply_mix(spark, df).collect() if r.text is not None)
    assert taken == Counter({i: sum(t // n for j, n, _, t in got if j == i and n) for i in {g[0] for g in got}}) - Counter()


def test_probabilities_differ_within_a_source(spark):
    rows = [(i, f"s{i % 3}", " ".join(["w"] * (2 if i % 2 else 900))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    units, _ = mixing.sized(spark, df)
    per = mixing.class_plan(units).where("source = 's1'").collect()
    expected = {r["class"]: r.whole + r.pi for r in per}
    assert len(expected) == 2 and expected[10] > expected[2] > 0
    assert math.isclose(sum(expected[r["class"]] * r.words for r in per), per[0].target, rel_tol=1e-9)


@pytest.mark.parametrize("repeats", [4096, 64])
def test_rows_without_ids_are_no_block(spark, monkeypatch, repeats):
    monkeypatch.setattr(mixing, "REPEATS", repeats)
    rows = [(None, "a", "same twenty words " * 7) for _ in range(1000)] + [(i, s, f"w{i} " * 21) for s in "bc" for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = [tuple(r) for r in mixing.mix(spark, df).select("source", "size", "target", "taken").collect()]
    for s in "abc":
        mine = [g for g in got if g[0] == s]
        assert len(mine) == 1000 and abs(sum(g[3] for g in mine) - mine[0][2]) <= 21
    again = mixing.mix(spark, df.repartition(3)).select("source", "size", "target", "taken").collect()
    assert sorted(map(tuple, again)) == sorted(got)
    out = mixing.apply_mix(spark, df).groupBy("source").count().collect()
    assert {r["source"]: r["count"] * 21 for r in out} == {s: sum(g[3] for g in got if g[0] == s) for s in "abc"}


# --- search and packing ----------------------------------------------------------------------


@pytest.mark.parametrize("scale", [1.0, 1e15])
def test_topk_selection(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "GROUP_BYTES", 400)
    monkeypatch.setattr(topk, "QUERY_BYTES", 50)
    rng = np.random.default_rng(0)
    rows = [(i % 90, [float(x) * scale for x in rng.integers(-2, 3, 3)]) for i in range(120)]
    got = defaultdict(list)
    for r in topk.top_k(spark, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 7, 20).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    v = [(i, [math.floor(64 * x) for x in e]) for i, e in rows]
    hold = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    for q in {i for i, _ in v if i % 20 == 0}:
        vectors = [x for i, x in v if i == q]
        if len(vectors) == 1:
            best = sorted((-hold(sum(a * b for a, b in zip(vectors[0], e))), i) for i, e in v if i != q)[:7]
            assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


def test_long_blanks_at_the_edge():
    from tokenizers import Tokenizer

    import public_tokenizers

    slow, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder(packing.ranks_path())
    for n in (packing.LONG_BLANK - 1, packing.LONG_BLANK, packing.LONG_BLANK + 1):
        t = "a" + " " * n + "b"
        assert fast(t) == slow.encode(t, add_special_tokens=False).ids


def test_evolution_improves_on_best_fit():
    """Items that largest-first best fit cannot place well: offspring need no more bins, and some fewer."""
    better = 0
    for seed in range(12):
        rng = np.random.default_rng(seed)
        lengths = rng.integers(200, 500, 60)
        a = np.full(60, -1, np.int32)
        packing.best_fit(lengths, np.argsort(-lengths, kind="stable"), a, [], 1024)
        got = packing.evolve(lengths, [], seed)[0]
        assert np.bincount(got, lengths).max() <= 1024 and got.max() <= a.max()
        better += packing.fitness(lengths, got) < packing.fitness(lengths, a)
    assert better


# --- the pipeline ----------------------------------------------------------------------------


def test_pipeline_by_brute_force(spark):
    """Every stage of run(), row by row: rules, one row of each component, redaction, mix, pieces."""
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    strict = strict_hosts([(s, t) for _, s, t in rows])
    rows = [(i, s, t) for i, s, t in rows if not (x := rules_of(t))[1] and not (x[2] and s in strict)]
    found = components_of([(i, t) for i, _, t in rows], 5, 80)
    rows = [(i, s, pii.redact(t)) for i, s, t in rows if found[i][1] == i]
    copies = {i: taken // n for i, n, _, taken in mixed(rows)}
    want = Counter()
    encode = packing.encoder(packing.ranks_path())
    for i, _, t in rows:
        n = len(encode(t)) + 1
        want[i, n] += copies[i]
    got = corpus_pipeline.run(spark, D).collect()
    total = defaultdict(int)
    for r in got:
        total[r.doc_id] += r.length
    assert dict(total) == {i: n * c for (i, n), c in want.items() if c}
    fill = defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, r.length))
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
