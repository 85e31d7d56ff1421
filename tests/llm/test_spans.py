"""Personal data and secrets against plain regular expressions and small planted cases."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ordersight.llm import pii, secrets
from ordersight.llm.queries import op2_pii, op7_secrets

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    values = [int(c) for c in digits[::-1]]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(values)) % 10 == 0


def _plain_pii(text):
    number = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), m.end(), 2) for m in CARD.finditer(text) if 12 <= len(number(m[0])) <= 19 and _luhn(number(m[0]))]
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= len(number(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def _plain_secrets(text):
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], s[2]))


PARTS = ["a.b", "@", "mail.example.com", "x", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111", "+1 (017) 555-7713", "+", "0", "255", " ", "-", "é", "%", "٣", "01", "00000000001"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_pii_base_equals_plain_patterns(text):
    assert pii.base_spans(text) == _plain_pii(text)


SECRET_PARTS = ["token", "TOKEN", "api_key", "apiKey", "paſſword", "password", "passwd", "secret", " = ", ":", '"', "'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "abc", "xyz123", " ", "=", "\n"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(SECRET_PARTS), max_size=14).map("".join))
def test_secret_base_equals_plain_patterns(text):
    assert sorted((a, b, k) for a, b, k, _ in secrets.base_spans(text)) == sorted(_plain_secrets(text))


def _digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()


def _corpus(n=400):
    """Texts with phones, cards and mails; order numbers of 16 digits that fail the check digit."""
    rng = random.Random(3)
    texts = []
    for i in range(n):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        body = [str(rng.randint(10**14, 10**15 - 1)) for _ in range(2)]
        card = next(f"{body[0]}{d}" for d in range(10) if _luhn(f"{body[0]}{d}"))
        order = next(f"{body[1]}{d}" for d in range(10) if not _luhn(f"{body[1]}{d}"))
        some = [phone, card, order, order, f"u{i}@mail.example.com", f"{rng.randint(1, 250)}.2.3.{rng.randint(1, 250)}", phone, card]
        rng.shuffle(some)
        texts.append(" lorem ipsum ".join(some[: rng.randint(2, 8)]))
    return texts


def test_skip_edges_carry_labels_to_look_alikes():
    graphs = [pii.mentions(t, pii.base_spans(t), plain_ones=True) for t in _corpus()]
    model = pii.train(graphs)
    card = "411111111111111"
    card += str(next(d for d in range(10) if _luhn(card + str(d))))
    dotted = ".".join(card[i : i + 4] for i in range(0, 16, 4))
    cases = {
        f"card {card} and far away {dotted} again": [(dotted, 2)],
        "call +1 (212) 555-7713 or 212-555-7713 today": [("212-555-7713", 3)],
        "write to bob.smith@mail.example.com or bob.smith@intranet": [("bob.smith@intranet", 0)],
        f"order {dotted[:-1]}{(int(dotted[-1]) + 1) % 10} and nothing else": [],
        "1234567890123456 was ordered, 1234567890123456 shipped, +1 (212) 555-7713": [],
        f"call +1 (826) 555-4081 {card}": [("+1 (826) 555-4081", 3), (card, 2)],
        f"numbers 1234567890123456 {card} side by side": [(card, 2)],
        'token = "04dbebab91ab85687d33eeaaf9ac6991188962120099"': [],
        f"numbers 7536784127813051 {card} and 7536784127813051": [(card, 2)],
        "version 999.1.2.3 of 20240101 and 20240101": [],
    }
    for text, want in cases.items():
        g = pii.mentions(text, pii.base_spans(text))
        assert [(text[a:b], k) for a, b, k in pii.added_spans(model, [g])[0]] == want, text


def test_messages_equal_brute_force_on_a_tree():
    rng = np.random.default_rng(1)
    model = pii.Model(rng.normal(size=(len(pii.FEATURES), pii.LABELS)), np.stack([(m + m.T) / 2 for m in rng.normal(size=(3, pii.LABELS, pii.LABELS))]))
    g = pii.Mentions([(0, 1, 0), (2, 3, 2), (4, 5, 0), (6, 7, 0)], [[0, 2], [0, 3], [0, 1, 8], [0, 9]], [(0, 1, 0), (1, 2, 1), (1, 3, 2)])
    x, y, edges = pii._joined([g])
    p = np.zeros((4, pii.LABELS))
    for labels in np.ndindex(*[pii.LABELS] * 4):
        if labels[1] == 2:
            score = sum((x[i] @ model.unary)[v] for i, v in enumerate(labels) if i != 1) + sum(model.pair[s][labels[a], labels[b]] for a, b, s in edges)
            for i, v in enumerate(labels):
                p[i, v] += np.exp(score)
    got = pii.marginals(model, [g], rounds=60)
    assert np.allclose(got, p / p.sum(1, keepdims=True), atol=1e-3)


def test_pii_query_on_odd_rows(spark, tmp_path):
    texts = [*_corpus(60), None, "", "+1 " * 40_000, "é 4111 1111 1111 1111 é", "a@b.c" * 500]
    rows = [(i % 50 if i % 7 else None, t, "x") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, spans string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op2_pii(spark, str(tmp_path)).collect()
    want = []
    for i, t, _ in rows:
        base = _plain_pii(t or "")
        want.append((i, *(sum(k == j for _, _, k in base) for j in range(4)), _digest(base, pii.KINDS)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:6]) for r in got)
    by_base = {_digest(_plain_pii(t or ""), pii.KINDS): _plain_pii(t or "") for _, t, _ in rows}
    for r in got:
        assert {f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in by_base[r["base_sha256"]]} <= set(r["spans"].split(","))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_personal_data(empty, "doc_id", "text", pii.fit(empty, "text")).count() == 0


def test_masking_keeps_clean_rows(spark):
    rows = [(1, "clean text 123", 14), (2, None, None), (3, "x a@b.cc, +1 (212) 555-7713!", 3), (None, "", 0)]
    df = spark.createDataFrame(rows, "doc_id int, text string, base int")
    got = {r["doc_id"]: r for r in pii.mask_personal_data(df, "text", pii.Model.untrained()).collect()}
    assert [got[i]["text"] for i in (1, 2, 3, None)] == ["clean text 123", None, "x [EMAIL], [PHONE]!", ""]
    assert got[3]["base"] == 3


def test_secret_query_counts_owners(spark, tmp_path):
    live, shared = "Zk93jfKs02LmQx7TbV1w4", "Aq81mZpRs55TnXy2KcW9e"
    rows = [(i, f"see {shared} here", f"s{i}") for i in range(6)]
    rows += [(10, f"only {live} mine", "s1"), (11, f"again {live}", "s1"), (12, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', None), (13, None, "s2"), (None, "", "s2"), (13, "supercalifragilisticexpialidocious", None)]
    rows += [(20 + i, "api_key: EXAMPLEEXAMPLE", f"s{i}") for i in range(4)] + [(30, "secret=abc" * 30_000, "s9")]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, owner int").write.parquet(str(tmp_path / "documents.parquet"))
    got = op7_secrets(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = sorted(str((i, *(sum(k == j for _, _, k in _plain_secrets(t or "")) for j in range(3)), _digest(_plain_secrets(t or ""), secrets.KINDS))) for i, t, _ in rows)
    assert want == sorted(str(tuple(r)[:5]) for r in got)
    spans = {r["doc_id"]: r["spans"] for r in got}
    assert spans[10] == f"owned:5:{5 + len(live)}" and spans[11] == f"owned:6:{6 + len(live)}" and spans[0] == ""
    by = {r["doc_id"]: r for r in got}
    assert by[12]["n_live"] == 2 and by[12]["n_example"] == 0
    assert by[20]["n_example"] == 1 and by[20]["n_live"] == 0
    assert secrets.find_secrets(spark.createDataFrame([], "a long, b string, c string"), "a", "b", "c").count() == 0


def test_copies_inside_one_source_are_examples(spark):
    copied, own, again, nameless = "Zk93jfKs02LmQx7TbV1w4", "Aq81mZpRs55TnXy2KcW9e", "Wd47bNcVt36HgJf8RzP0q", "Ym52xLqDs90KvBw6TnC3h"
    rows = [(i, f"see {copied} and token={copied}", "s1") for i in range(secrets.MAX_REPOSITORIES + 1)]
    rows += [(100 + i, f"only {own} mine {i}", "s1") for i in range(secrets.MAX_REPOSITORIES)]
    rows += [(200, f"row {i} of one document: {again}", "s1") for i in range(20)]
    rows += [(None, f"no id {nameless}", "s2") for _ in range(secrets.MAX_REPOSITORIES + 1)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "a long, b string, c string"), "a", "b", "c").collect()
    kinds = {}
    for r in got:
        kinds.setdefault(None if r["a"] is None else r["a"] // 100, set()).add((tuple(secrets.KINDS[s["kind"]] for s in r["spans"]), r["n_live"], r["n_example"]))
    assert kinds == {0: {(("assign",), 0, 1)}, 1: {(("owned",), 0, 0)}, 2: {(("owned",), 0, 0)}, None: {((), 0, 0)}}


def _mentioned(text):
    return [text[a:b] for a, b, _ in pii.mentions(text, pii.base_spans(text), plain_ones=True).spans]


def test_grouped_cards_beside_other_numbers_are_mentions():
    visa, master, amex, phone = "4111 1111 1111 1111", "5500 0000 0000 0004", "3782 822463 10005", "+1 (212) 555-7713"
    cases = {
        f"{visa} {master}": [visa, master],
        f"{visa}. {master}) {amex} 2024": [visa, master, amex],
        f"id 20240101 {visa}": ["20240101", visa],
        f"{phone} {visa}": [phone, visa],
        f"{phone} 20240101 {visa}": [phone, "20240101", visa],
        f"{phone} 20240101": [phone, "20240101"],
        f"212 555 7713 {visa}": ["212 555 7713", visa],
        f"{visa} 123": [visa],
        f"2024 {amex}": [amex],
        "212 555 7713 or 99 212 555 7713 12": ["212 555 7713", "212 555 7713"],
        f"call {phone}, {phone} 2024 17": [phone, phone],
        "12 34 56 78 90 12 34 56 78 90 12 34 56 78": [],
        "+1 (212) 555-7713 1234567890123": [phone, "1234567890123"],
    }
    for text, want in cases.items():
        assert _mentioned(text) == want, text
    model = pii.train([pii.mentions(t, pii.base_spans(t), plain_ones=True) for t in _corpus()])
    for text, want in {f"{visa} {master}": [(visa, 2), (master, 2)], f"{phone} {visa}": [(phone, 3), (visa, 2)], f"id 20240101 {visa}": [(visa, 2)], f"{visa} 123": [(visa, 2)]}.items():
        assert [(text[a:b], k) for a, b, k in pii.added_spans(model, [pii.mentions(text, pii.base_spans(text))])[0]] == want, text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("0123456789", min_size=1, max_size=8), st.sampled_from([" ", "  ", "-", ". "])), min_size=1, max_size=12))
def test_runs_count_most_and_hold_check_digits(groups):
    text = "".join(g + sep for g, sep in groups) + "7"
    parts = [m.span() for m in re.finditer(r"[^ ]+", text)]
    digits = re.sub("[^0-9]", "", text)
    size = lambda i, j: re.sub("[^0-9]", "", text[parts[i][0] : parts[j - 1][1]])
    runs = pii._runs(text, parts, digits, set(), set())
    assert all(i < j and 12 <= len(size(i, j)) <= 19 and _luhn(size(i, j)) for i, j in runs) and all(x[1] <= y[0] for x, y in zip(runs, runs[1:]))
    for i in range(len(parts)):
        for j in range(i + 1, len(parts) + 1):
            if (i, j) != (0, len(parts)) and 12 <= len(d := size(i, j)) <= 19 and _luhn(d) and all(len(size(k, k + 1)) >= 3 for k in range(i, j - 1)):
                assert any(x < j and i < y for x, y in runs)


def test_labels_reach_the_end_of_long_chains():
    n, weak, strong = 120, np.zeros((pii.LABELS, pii.LABELS)), 6 * np.eye(pii.LABELS)
    model = pii.Model(np.zeros((len(pii.FEATURES), pii.LABELS)), np.stack([weak, weak, strong]))
    long = pii.Mentions([(2 * i, 2 * i + 1, 3 if i == 0 else 0) for i in range(n)], [[0]] * n, [(i, i + 1, 2) for i in range(n - 1)])
    short = pii.Mentions([(0, 1, 3), (2, 3, 0)], [[0]] * 2, [(0, 1, 2)])
    step = np.exp(strong) / np.exp(strong).sum(1, keepdims=True)
    want = [np.eye(pii.LABELS)[3]]
    for _ in range(n - 1):
        want.append(want[-1] @ step)
    got = pii.marginals(model, [short, long, short])
    assert np.allclose(got[2 : n + 2], want, atol=1e-2) and np.allclose(got[[1, -1]], want[1], atol=1e-3)
    assert got[n + 1].argmax() == 3


def test_copies_count_once_in_the_training_sample(spark):
    texts = [f"number {i} of 4111 1111 1111 1111" for i in range(40)]
    copied = spark.createDataFrame([(t,) for t in texts] + [(t,) for t in texts[:20]] * 50, "text string").repartition(4)
    got = pii.training_graphs(copied, "text", docs=30)
    assert len(got) == 30 and len({repr(g) for g in pii.training_graphs(copied.limit(0), "text")}) == 0
    once = spark.createDataFrame([(t,) for t in texts], "text string")
    assert sorted(map(repr, got)) == sorted(map(repr, pii.training_graphs(once, "text", docs=30)))
    assert len(pii.training_graphs(copied, "text")) == 40
