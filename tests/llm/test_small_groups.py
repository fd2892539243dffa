"""Fertility bands of groups with few texts."""

import random

from kestrel.llm import quality
from tests.llm import reference as R


def test_groups_with_few_texts_are_tested(spark):
    r = random.Random(2)
    words = ("time people water house garden morning letter number window music "
             "river market stone bread winter summer door light field road").split()
    plain = [(i, " ".join(r.choice(words) for _ in range(150)) + f" {i}", "en") for i in range(80)]
    junk, much = (" ".join("".join(r.choice("qxzjkvw#%") for _ in range(5)) for _ in range(n)) for n in (60, 540))
    longer = " ".join(r.choice(words) for _ in range(200))
    rows = plain + [(100, junk, "en"), (101, junk + " 1", "xx"), (102, junk + " 2", None), (103, much, "en"),
                    (104, longer, "en"), (105, " ".join(r.choice(words) for _ in range(150)), "yy")]
    got = {x.doc_id: x for x in quality.rate(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), [R.PIECES]).collect()}
    assert len(got) == len(rows)
    assert not any(got[i].base_failed for i in range(100, 106))
    assert [got[i].kept for i in range(100, 106)] == [False, False, False, False, True, True]
    few = {x.doc_id: x.n_outside for x in quality.rate(
        spark.createDataFrame(plain[:20] + rows[80:81], "doc_id long, text string, lang string"), [R.PIECES]).collect()}
    assert few[100] > 0 and sum(few[i] > 0 for i in range(20)) == 0
