"""What the line dedup writes and compares grows with what it finds."""

import random

from pyspark.sql import functions as F

from kestrel.llm import lines


def test_line_buckets_keep_no_keys_and_few_texts(spark, monkeypatch):
    """Before, the keys of all lines were written, and all lines moved with every join of texts."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(6))
    alone = [" ".join(word() for _ in range(14)) for _ in range(300)]
    pair = [" ".join(word() for _ in range(14)) for _ in range(5)]
    rows = list(enumerate(alone + pair + [p[:-1] + "Z" for p in pair]))
    written, stored = {}, lines.stored

    def kept(df, name, *args):
        written[name] = stored(df, name, *args)
        return written[name]

    monkeypatch.setattr(lines, "stored", kept)
    links = lines.line_links(spark.createDataFrame(rows, "id long, line string"), 2, 64)
    got = {tuple(sorted((x.a, x.b))) for x in links.collect()}
    assert got == {(300 + i, 305 + i) for i in range(5)}
    assert "line-keys" not in written and written["line-texts"].count() == 10


def test_letter_counts_keep_all_near_pairs(spark):
    r = random.Random(8)
    pairs = []
    for i in range(400):
        a = [r.choice("eatn ox é") for _ in range(r.randrange(3, 40))]
        b = list(a)
        for _ in range(i % 3):
            at, kind = r.randrange(len(b)), r.randrange(3)
            b[at:at + (kind < 2)] = r.choice("eatn oz") if kind else ""
        pairs.append(("".join(a), "".join(b), i % 3))
    pairs.append(("e" * 30, "a" * 30, 9))
    d = spark.createDataFrame(pairs, "a string, b string, edits int")
    near = [lines.letters_near(lines.letters(F.col("a")), lines.letters(F.col("b")), t) for t in (1, 2)]
    for x in d.select("edits", near[0].alias("one"), near[1].alias("two")).collect():
        assert (x.one or x.edits > 1) and (x.two or x.edits > 2) and not (x.edits == 9 and x.two)


def test_letters_come_before_characters(spark, monkeypatch):
    """Before, verifying repeated the test by characters, which the optimizer
    put before all other conditions of the join, so every pair paid for it."""
    plans, stored = [], lines.stored

    def kept(df, name, *args, **kw):
        if name == "line-pairs":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, name, *args, **kw)

    monkeypatch.setattr(lines, "stored", kept)
    same = "the first part of all these lines is the same in every one of them"
    rows = [(i, f"{same} {w * 12}") for i, w in enumerate(("abcde", "fghij", "klmno", "pqrst"))]
    rows += [(4, rows[3][1][:-1] + "Z")]
    links = lines.line_links(spark.createDataFrame(rows, "id long, line string"), 2, 64)
    assert {(x.a, x.b) for x in links.collect()} == {(3, 4)}
    condition = plans[-1].split("Join Inner")[1]  # the star's pairs come first
    assert 0 < condition.index(".n0") < condition.index("transform(")


def test_no_text_moves_to_the_classes(spark, monkeypatch):
    """Before, the texts of all lines moved with the join to their classes."""
    plans, stored = {}, lines.stored

    def kept(df, name, *args, **kw):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stored(df, name, *args, **kw)

    monkeypatch.setattr(lines, "stored", kept)
    texts = ["short", "b" * 30, "c" * 70, "c" * 69 + "d"]
    docs = spark.createDataFrame([(1, "\n".join(texts)), (2, "\n".join(texts[1:] + ["own"]))], "doc_id long, text string")
    out = lines.drop_repeated(docs, one_edit_chars=24).orderBy("doc.doc_id").collect()
    assert [r.doc.text for r in out] == ["\n".join(texts[:3]), "own"]
    assert "xxhash64(line" in plans["line-places"].split("Join LeftOuter")[1]  # hashed below the join
