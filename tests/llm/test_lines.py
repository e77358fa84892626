import random
from collections import defaultdict

import pytest
from llm_rows import ODD, documents, prose

from strata.llm.lines import dedup_lines
from strata.llm.queries import QUERIES


def brute(docs, least):
    """Lines in common with an earlier place, as runs of ``least`` words."""
    lines, where = {}, defaultdict(list)
    for doc, text in docs:
        lines[doc] = [(n, s.strip(" \t\x0b\x0c\r")) for n, s in enumerate((text or "").split("\n"))
                      if s.strip(" \t\x0b\x0c\r")]
        for at, (_, s) in enumerate(lines[doc]):
            where[s].append((doc, at))
    out = {}
    for doc, text in docs:
        gone = set()
        for at, (_, s) in enumerate(lines[doc]):
            for other, there in where[s]:
                if (other, there) >= (doc, at):
                    continue
                n = 0
                while (at + n < len(lines[doc]) and there + n < len(lines[other])
                       and lines[doc][at + n][1] == lines[other][there + n][1]):
                    n += 1
                if sum(len(x.split()) for _, x in lines[doc][at:at + n]) >= least:
                    gone.update(k for k, _ in lines[doc][at:at + n])
        out[doc] = None if text is None else "\n".join(s for k, s in enumerate(text.split("\n")) if k not in gone)
    return out


@pytest.mark.parametrize("least", [1, 5, 10])
def test_random_lines_match_brute_force(spark, least):
    rng = random.Random(least)
    stock = ["a", "b c", "d e f", "g h i j", "k l m n o p", "", "  ", " a ", *(" ".join(prose(i, i)) for i in range(1, 9))]
    rows = [(i, "\n".join(rng.choices(stock, k=rng.randint(0, 12)))) for i in range(60)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(documents(spark, rows), min_words=least).collect()}
    assert got == brute(rows, least)


def test_query_matches_brute_force(spark):
    from conftest import SF_SMALL
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = {r["doc_id"]: r["text"] for r in QUERIES["op7_line_runs"](spark, SF_SMALL).collect()}
    assert got == brute(rows, 10)


def test_long_passages_go_but_for_the_first(spark):
    passage = "\n".join(" ".join(prose(100 + i, 15)) for i in range(6))
    rows = [(i, " ".join(prose(i, 30)) + "\n" + passage + "\n" + " ".join(prose(50 + i, 30))) for i in range(20)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(documents(spark, rows)).collect()}
    assert [i for i in got if passage in got[i]] == [0]
    assert all(got[i].count("\n") == 1 for i in range(1, 20))


def test_odd_rows_and_empty_table(spark):
    docs = documents(spark, ODD)
    out = dedup_lines(docs, out_col="told")
    assert out.columns == [*docs.columns, "told"]
    rows = out.collect()
    assert len(rows) == len(ODD)
    texts = {r["doc_id"]: r["text"] for r in rows}
    assert texts[1] is None and texts[2] == "" and texts[3] == " \n\t\n "
    # from the second line on, every two lines repeat the two before
    assert texts[7].split("\n").count("a b c d e") == 1
    assert texts[4] == texts[5] == "word"
    assert dedup_lines(documents(spark, [])).count() == 0
