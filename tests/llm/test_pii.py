import hashlib
import math
import random
import re

from llm_rows import ODD, documents, prose

from strata.llm import pii
from strata.llm.queries import QUERIES


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(2)
    bits = ["a", "b.c", "@", "@x.y", ".", "-", "+1", "+", "12", "255", "256", "1.2.3.4", "1.2.3", " ", "  ", "(", ")", "%",
            "4111111111111111", "4111 1111-1111 1111", "é", "\n", "0000", "٣"]
    for _ in range(20000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        assert pii.entities(text) == brute(text), text


def test_long_runs_are_read_once():
    assert pii.entities("1" * 300_000 + "a" * 300_000 + "@" * 1000 + "0" * 5000 + ".0.0.1") == [("ip", 601_000, 606_006)]


def test_terms_that_give_an_entity_away(spark):
    rows = []
    for i in range(6):
        w = prose(i, 60)
        rows.append((i, " ".join([*w[:20], f"zebedee writes from zeb@example.com {w[50]} common", *w[20:]])))
    for i in range(6, 60):
        rows.append((i, " ".join(["common", *prose(i, 80)])))
    rows.append((60, "someone saw Zebedee here, and common people"))
    rows += [(70 + i, " ".join([*prose(99, 20), "onlycopies of one@example.org", *prose(98, 20)])) for i in range(9)]
    docs = documents(spark, rows)
    terms = {r["term"] for r in pii.disclosing_terms(docs.select("text")).collect()}
    assert {"zebedee", "writes"} <= terms and "common" not in terms and "onlycopies" not in terms
    found = pii.find_personal_data(docs)
    by_id = {r["doc_id"]: [(s["kind"], rows[60][1][s["start"]:s["end"]]) for s in r["spans"]]
             for r in found.collect() if r["doc_id"] == 60}
    assert by_id[60] == [("term", "Zebedee")]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[60] == "someone saw  here, and common people"
    assert "<EMAIL>" in clean[0] and "zeb@" not in clean[0]


def test_copies_of_one_context_do_not_hide_terms(spark):
    # three in ten of its places are near the entity, in 30 contexts; one context has 300 copies
    near = [f"{' '.join(prose(i, 9))} zebedee zeb@example.com {' '.join(prose(500 + i, 9))}" for i in range(30)]
    far = [" ".join([*prose(1000 + i, 30), "zebedee", *prose(3000 + i, 200)]) for i in range(70)]
    copies = [f"{' '.join(prose(77, 9))} zeb@example.com {' '.join(prose(78, 9))}"] * 300
    rows = list(enumerate(near + far + copies + [" ".join(prose(5000 + i, 300)) for i in range(300)]))
    texts = documents(spark, rows).select("text")
    found = {r["term"]: r["disclosure"] for r in pii.disclosing_terms(texts, disclosure=0.0).collect()}
    words = sum(len(pii.TERM.findall(t)) for _, t in rows)
    p = 330 * 2 * pii.WINDOW / words
    assert abs(found["zebedee"] - math.log(0.3 / p) / math.log(1 / p)) < 1e-9


def test_odd_rows_and_empty_table(spark):
    out = pii.find_personal_data(documents(spark, ODD))
    assert out.count() == len(ODD)
    assert pii.find_personal_data(documents(spark, [])).count() == 0
    clean = pii.sanitise(documents(spark, ODD))
    assert clean.columns == documents(spark, []).columns
    assert sorted(map(repr, clean.collect())) == sorted(map(repr, documents(spark, ODD).collect()))


def test_sanitise_needs_no_ids(spark):
    rows = [(None, "mail me at zeb@example.com now"), (5, "a long text with no data"), (5, "write to bob@example.org"),
            (5, "write to bob@example.org"), (None, None), (7, "call +4111 1111 1111 1111 11 or 4111111111111111")]
    docs = documents(spark, rows)
    out = sorted((repr(r["doc_id"]), r["text"] or "", r["id"], r["spans"]) for r in pii.sanitise(docs).collect())
    assert out == sorted([("None", "mail me at <EMAIL> now", "x", "x"), ("5", "a long text with no data", "x", "x"),
                          ("5", "write to <EMAIL>", "x", "x"), ("5", "write to <EMAIL>", "x", "x"), ("None", "", "x", "x"),
                          ("7", "call +4111 1111 1111 1111 11 or <CARD>", "x", "x")])


def test_overlapping_spans_go_as_one():
    from strata.llm.common import rewritten
    assert rewritten("0123456789", [(2, 5, "<A>"), (4, 8, "<B>"), (8, 9, "<C>")]) == "01<A><C>9"
    assert rewritten("0123456789", [(4, 6, "<B>"), (2, 8, "<A>")]) == "01<A>89"


def brute_terms(texts, window=pii.WINDOW, support=pii.SUPPORT, disclosure=pii.DISCLOSURE):
    """The disclosing terms, counted text by text."""
    windows, words = [], []
    for text in texts:
        spans = brute(text)
        own = {text[s:e] for _, s, e in spans}
        words += pii.TERM.findall(text)
        for k, s, e in spans:
            around = text[:s].split()[-window:] + text[e:].split()[:window]
            windows.append(((k, text[s:e]), sorted(t.lower() for w in around if w not in own for t in pii.TERM.findall(w))))
    total, found = {t: 0 for t in map(str.lower, words)}, set()
    for t in map(str.lower, words):
        total[t] += 1
    for entity in {e for e, _ in windows}:
        mine = [terms for e, terms in windows if e == entity]
        p = min(sum(map(len, mine)) / len(words), 0.5)
        for term in {t for terms in mine for t in terms}:
            having = [terms for terms in mine if term in terms]
            if len({tuple(terms) for terms in having}) >= support:
                given = min(len(having) / total[term], 1)
                if math.log(given / p) / math.log(1 / p) >= disclosure:
                    found.add(term)
    return found


def test_term_spans_and_clean_texts_of_a_table(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for k in range(120):
        words = prose(k, 40)
        for _ in range(rng.randint(0, 2)):
            who = rng.randrange(4)
            words.insert(rng.randrange(len(words)), f"{['anna', 'Boris', 'chloe', 'Dmitri'][who]} u{who}@example.com "
                         f"{rng.choice(['often', 'wrote'])} p{'q' * 70}")
        rows.append((k if k % 7 else None, " ".join([*words, rng.choice(["Anna left", "often", "chloe", ""])])))
    rows += [rows[5]] * 4
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = sorted((repr(r["doc_id"]), r["spans"], r["n_term"], r["clean_sha256"])
                 for r in QUERIES["op10_disclosure"](spark, str(tmp_path)).collect())
    terms, want = brute_terms([t for _, t in rows]), []
    assert {"boris", "dmitri"} <= terms and not {"often", "anna"} & terms
    for doc, text in rows:
        spans = brute(text)
        own = [(s, e) for _, s, e in spans]
        spans += [("term", *m.span()) for m in pii.TERM.finditer(text)
                  if m[0].lower() in terms and not any(s < m.end() and m.start() < e for s, e in own)]
        clean, at = "", 0
        for kind, s, e in sorted(spans, key=lambda x: x[1]):
            clean, at = clean + text[at:s] + ("" if kind == "term" else f"<{kind.upper()}>"), e
        want.append((repr(doc), ",".join(f"{k}:{s}:{e}" for k, s, e in spans), sum(k == "term" for k, *_ in spans),
                     hashlib.sha256((clean + text[at:]).encode()).hexdigest()))
    assert out == sorted(want)


def test_stored_contexts_hold_no_entity(spark):
    docs = documents(spark, [(1, "write to zeb@example.com today please")]).select("text")
    rows = pii.contexts(docs, 8).collect()
    assert {r["term"] for r in rows} == {"write", "today", "please"}
    assert not any("zeb" in r["entity"] or "@" in r["entity"] for r in rows)


def test_query_digest(spark):
    from conftest import SF_SMALL
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = QUERIES["op10_disclosure"](spark, SF_SMALL).collect()
    assert len(out) == len(texts)
    for r in out:
        spans = brute(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"].startswith(joined)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
