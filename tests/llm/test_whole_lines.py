"""Line dedup keeps one of every line: cases that earlier versions lost."""

import corpus_pipeline
from kestrel.llm import lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def line_stage(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    return [(r.doc_id, r.text) for r in corpus_pipeline.line_dedup(spark, docs, "").collect()]


def test_every_different_line_stays_once(spark):
    body = [f"{w} is line number {i} of a document that is told at length" * 3
            for i, w in enumerate("alpha bravo carol delta early fancy given hotel".split())]
    passage = "a passage that many documents share, first held by a copy"
    rows = [(1, "\n".join(body)), (5, "\n".join([*body, passage]))]
    rows += [(i, f"document {w} says something else before it\n{passage}")
             for i, w in ((6, "sixty-six"), (7, "seventy"), (8, "eighty-eight"))]
    rows += [(9, "\n".join(body))]
    out = line_stage(spark, rows)
    left = sorted(line for _, t in out for line in t.split("\n"))
    assert left == sorted({line for _, t in rows for line in t.split("\n")})
    assert 9 not in dict(out)


def test_edits_of_very_long_lines(spark):
    def with_edits(n, *places):
        text = list("abcdefghij" * (n // 10))
        for p in places:
            text[p] = "Z"
        return "".join(text)

    rows = [(n + len(at), with_edits(n), with_edits(n, *at)) for n, at in (
        (10, (5,)), (131080, (65540,)), (262200, (131100,)), (300000, (150000,)), (400000, (1, 399998)),
        (200000, (150000, 160000)), (300000, (100000, 150000, 200000)))]
    pairs = spark.createDataFrame(rows, "i int, line_a string, line_b string")
    assert {r.i for r in lines.verified(pairs, 2).collect()} == {i for i, *_ in rows} - {300003}


def test_rows_without_or_with_one_doc_id_are_separate(spark):
    shared = "this line is shared by all of the documents here"
    own = {w: f"{w} is what only this row has to say about it" for w in ("first", "second", "third", "fourth")}
    rows = [(1, shared), (None, f"{shared}\n{own['first']}"), (None, f"{own['second']}\n{shared}"),
            (7, f"{shared}\n{own['third']}"), (7, f"{own['fourth']}\nwith one more line of its own text")]
    alike = "both rows without a name hold this line at number zero"
    rows += [(None, alike + "\nthe one row goes on like this"), (None, alike + "\nwhile the other ends otherwise")]
    out = line_stage(spark, rows)
    left = sorted(line for _, t in out for line in t.split("\n"))
    assert left == sorted({line for _, t in rows for line in t.split("\n")})
    assert len(out) == len(rows)


def test_quality_rules_reject_by_row(spark):
    good = " ".join(f"{a}{b}" for a in "time water house music letter".split() for b in "abcdefghijklmno")
    rows = [(None, good), (None, "too short"), (3, good), (3, "short too"), (4, "short")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    out = corpus_pipeline.quality_rules(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [("3", good), ("None", good)]


def test_short_lines(spark):
    rows = [(1, "Contents\n---\nyes 1\nthe sea was calm in the morning\n日本語の文章はここに続きます。長い文章ですから切らない。"),
            (2, "Contents\n---\nyes 2\nthe sea was calm in the mornings\n日本語の文章はここに続きます。長い文章ですから切らなぃ。"),
            (3, "the sea is calm in the evenings\nyes 1\nown line\n\n---"),
            (4, "x" * 40 + "abc" * 8 + "\n" + "y" * 63), (5, "x" * 40 + "abc" * 7 + "zzz\n" + "y" * 64)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    got = {r.doc.doc_id: r.doc.text for r in lines.drop_repeated(docs, one_edit_chars=lines.ONE_EDIT_CHARS).collect()}
    assert got == {1: rows[0][1], 2: "---\nyes 2", 3: "the sea is calm in the evenings\nown line\n\n---",
                   4: rows[3][1], 5: "x" * 40 + "abc" * 7 + "zzz"}
    assert dict(line_stage(spark, rows[:1] + [(2, "Contents\n---\n" + rows[0][1])])) == dict(rows[:1])
