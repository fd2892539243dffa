"""The pipeline's stages against brute-force versions, each on its own input,
and the registered queries' entry points."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kestrel.llm import lines, quality
from kestrel.llm.tables import stored
from tests.llm import reference as R

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Short documents of the small test table, copies and near copies of
    some, and the odd cases."""
    src = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    some = [tuple(r) for r in src.where("length(text) BETWEEN 300 AND 1500").orderBy("doc_id").limit(24).collect()]
    rows = list(some)
    for i, r in enumerate(some[:6]):
        rows.append((5000 + i, r[1], "en", "copies", r[4]))                               # exact copy
        rows.append((6000 + i, r[1].replace("a", "o", 1) + " end", "en", "near", r[4]))   # near copy
    own = " ".join(reversed(max((r[1] for r in some), key=lambda t: len(set(t.split()))).split()))
    rows += [(7000, own + '\npassword = "kJ83hs92Lmq01"', "en", "s1", 1), (7001, None, None, None, None),
             (7002, "", "en", "s2", 0), (None, some[9][1], "en", "s3", 5), some[3]]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def steps(spark, corpus):
    """(name, input rows, output rows) of every stage."""
    docs, out = spark.read.parquet(f"{corpus}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = stored(stage(spark, docs, corpus), "t")
        out.append((docs, made))
        docs = made
    return out


def ids(df):
    return sorted((r.doc_id is None, r.doc_id) for r in df.select("doc_id").collect())


def test_all_but_the_last_stage_return_documents(steps):
    assert all(made.columns == COLUMNS for _, made in steps[:-1])


def test_quality_stage_drops_what_the_rules_reject(steps):
    before, after = steps[0]
    kept = {r.doc_id for r in quality.rate(before, corpus_pipeline.fertility_vocabularies()).where("kept").collect()}
    assert ids(after) == [x for x in ids(before) if x[1] in kept]
    assert 7001 not in kept and 7002 not in kept


def counted(line):
    """Lines that go when repeated: not empty, and no short marks."""
    return len(line) >= 24 or any(unicodedata.category(c)[0] in "LN" for c in line)


def linked(a, b):
    """Equal, one edit from 24 characters on, or two from 64."""
    least, apart = min(len(a), len(b)), abs(len(a) - len(b))
    return a == b or (least >= 24 and apart <= 1 and R.edits(a, b) <= 1) or (
        least >= 64 and apart <= 2 and R.edits(a, b) <= 2)


def test_line_stage_keeps_first_lines(steps):
    before, after = steps[1]
    rows = before.collect()
    name = lambda r: lines.LAST_ID if r.doc_id is None else r.doc_id
    places = sorted({(name(r), n, s) for r in rows for n, s in enumerate(r.text.split("\n")) if counted(s)})
    g = R.Groups({p[2] for p in places})
    different = sorted(g.up)
    for i, a in enumerate(different):
        for b in different[i + 1:]:
            if linked(a, b):
                g.link(a, b)
    first = {}
    for d, n, s in places:
        first.setdefault(g.find(s), (d, n))
    want = []
    for r in rows:
        kept = [s for n, s in enumerate(r.text.split("\n")) if not counted(s) or first[g.find(s)] == (name(r), n)]
        if "\n".join(kept) == r.text or any(map(counted, kept)):
            want.append((name(r), "\n".join(kept)))
    assert sorted(want) == sorted((name(r), r.text) for r in after.collect())
    assert len(want) < len(rows)


def test_near_stage_keeps_one_of_each_group(steps):
    before, after = steps[2]
    rows = before.collect()
    fp = [R.simhash(r.text) for r in rows]
    g = R.Groups(range(len(rows)))
    for i, a in enumerate(fp):
        for j in range(i):
            if (a ^ fp[j]).bit_count() <= 3:
                g.link(i, j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(g.find(i), []).append((r.doc_id is None, r.doc_id))
    assert ids(after) == sorted(min(x, key=str) for x in groups.values())


def test_no_text_is_lost(spark):
    """Different texts under one doc_id or none, and repeated rows."""
    r = random.Random(8)
    words = ("time people water house garden morning letter number window music river market stone bread winter "
             "summer door light field road").split()
    texts = [" ".join(r.choice(words) + str(r.randrange(300)) for _ in range(120)) for _ in range(6)]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (2, texts[4]), (2, texts[4]),
            (None, texts[0]), (None, texts[3]), (3, texts[5]), (4, texts[5] + " end")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").withColumn(
        "row", F.lit("clash")).withColumn("doc", F.lit(1))
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((str(x.doc_id), x.text) for x in out.collect()) == sorted(
        [("1", texts[0]), ("1", texts[1]), ("None", texts[2]), ("None", texts[3]), ("2", texts[4]), ("3", texts[5])])
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, kept, ""), "t")
    assert sorted(x.text for x in kept.collect()) == sorted(texts)


@pytest.mark.parametrize("texts", [[""], [None], ["", "word " * 300_000], [None, "", " \n"]])
def test_texts_without_tokens(spark, texts):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    rated = {r.doc_id: r for r in quality.rate(docs, corpus_pipeline.fertility_vocabularies()).collect()}
    assert len(rated) == len(texts) and not any(r.kept for r in rated.values())
    assert all(rated[i].entropy_0 == 0.0 for i, t in enumerate(texts) if not (t or "").strip() and not t)
    assert corpus_pipeline.quality_rules(spark, docs, "").count() == 0


def test_secret_stage_masks_and_keeps_documents(steps):
    before, after = steps[3]
    assert ids(before) == ids(after)
    text = {r.doc_id: r.text for r in after.collect()}
    assert "kJ83hs92Lmq01" not in text[7000]
    for r in before.collect():
        if not R.secret_spans(r.text):
            assert text[r.doc_id] == r.text


def test_packing_stage_places_every_token(steps):
    before, after = steps[4]
    want = sum(map(len, R.token_ids([r.text for r in before.collect()])))
    assert after.agg(F.sum("length")).first()[0] == want
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")
                                            ).where("n <> m OR n > 1024").count() == 0


def test_run_equals_the_stages(spark, corpus, steps):
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert corpus_pipeline.run(spark, corpus).select(keys).exceptAll(steps[-1][1].select(keys)).count() == 0


def test_pipeline_of_no_documents(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, corpus), "t")
    assert docs.count() == 0
