"""Secret scan with corpus-wide ownership.

Method: patterns find candidates in every whole text; each candidate value's
hash is counted over the corpus by distinct repositories (documents) and
owners.  A value that many owners hold is a widely copied example.  One that
few hold is a live credential if it stands after a key word, or if it looks
random: if its entropy has at least ``MIN_SHARE`` of the most that its length
and its kind's alphabet allow.  Pattern kinds of ``EXTRA`` are only reported
where their value is live.  DataFrame functions
only: matches and the gaps between them give the places, as code points.

Defined cases: a null text has no spans; a null owner counts as an owner of
its own; repeated rows are separate documents with equal results; a null
doc_id is kept.  Columns besides the named ones are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.tables import stored

#: kind -> (pattern, group with the value, least characters of the value).
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # whole runs of 24 and more: leftmost and greedy
}
_RUN = "[A-Za-z0-9+/_=-]"
EXTRA = {
    # a long run with digits and letters of both cases
    "mixed": (rf"(?<!{_RUN})(?={_RUN}*[0-9])(?={_RUN}*[a-z])(?={_RUN}*[A-Z]){_RUN}{{32,}}", 0, 32),
    "private_key": (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]+", 0, 64),
}
KINDS = {**BASE, **EXTRA}
EXAMPLE_OWNERS = 3       # a value held by so many owners is an example
MIN_SHARE = 0.6          # of the possible entropy, in a live-looking value
#: Characters that values of a kind are made of; kinds not named stand after a key word.
ALPHABET = {"access": 36, "hex": 16, "mixed": 64, "private_key": 64}
SUM_BLOCK = 256          # numbers that a running result is worked out over at a time


def _random(value: Column, kind_no: Column) -> Column:
    """Does a value look random, or does its kind not ask for it?"""
    chars = F.split(value, "")
    n = F.size(chars).cast("double")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    letters = F.get(F.array(*[F.lit(float(ALPHABET.get(k, 0))) for k in KINDS]), kind_no)
    return F.when(letters == 0, True).otherwise(entropy >= MIN_SHARE * F.log2(F.least(n, letters)))


def _running(numbers: Column, start: int, step) -> Column:
    """For each number the fold ``step`` of those before it, from ``start``.
    Arrays only grow by copying, so the folds run inside blocks and over the
    blocks' results."""
    none = F.array().cast("array<int>")

    def fold(xs, first):
        return F.aggregate(xs, first, step)

    def folds(xs, first):
        return F.aggregate(xs, F.struct(first.alias("at"), none.alias("out")), lambda acc, x: F.struct(
            step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    def whole(xs):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / SUM_BLOCK).cast("int")),
                           lambda b: F.slice(xs, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK)))

    def of_blocks(blocks):
        heads = folds(F.transform(blocks, lambda xs: fold(xs, F.lit(start))), F.lit(start))
        return F.flatten(F.zip_with(blocks, heads, folds))

    return F.when(F.size(numbers) > 0, _let(numbers, lambda xs: _let(whole(xs), of_blocks))).otherwise(none)


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _matches(text: Column, number: int, kind: str) -> Column:
    """array<struct<start, kind_no, end, value>> of one pattern."""
    pattern, group, least = KINDS[kind]
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # a match begins where the gaps and matches before it end
    parts = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    sized = F.transform(parts, lambda x: F.struct(
        F.length(x["gap"]).alias("gap"), F.coalesce(F.length(x["hit"]), F.lit(0)).alias("hit"), x["value"].alias("value")))
    found = _let(sized, lambda xs: F.zip_with(
        xs, _running(F.transform(xs, lambda x: x["gap"] + x["hit"]), 0, lambda a, x: a + x),
        lambda x, before: F.struct(
            (before + x["gap"]).alias("start"), F.lit(number).alias("kind_no"),
            (before + x["gap"] + x["hit"]).alias("end"), x["value"].alias("value"))))
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), F.filter(found, lambda m: F.length(m["value"]) >= least)).otherwise(none)


def candidates(text: Column) -> Column:
    """All candidates of a text by (start, kind): start, kind_no, end, hash of
    the value, and whether it looks random."""
    found = F.array_sort(F.concat(*[_matches(text, i, k) for i, k in enumerate(KINDS)]))
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["end"].alias("end"),
        F.sha2(x["value"], 256).alias("hash"), _random(x["value"], x["kind_no"]).alias("random")))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, repositories, owners) from rows (repository, owner, hash)."""
    each = found.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = each.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def _judged(rows: DataFrame) -> DataFrame:
    """(row, spans) for stored rows (row, owner, found): spans with the
    verdict ``live`` or ``example``, extra kinds only if live."""
    flat = rows.select("row", "owner", F.explode("found").alias("c")).select("row", "owner", "c.*")
    held = ownership(flat.select(F.col("row").alias("repository"), "owner", "hash"))
    live = F.col("random") & (F.col("owners") < EXAMPLE_OWNERS)
    return (flat.join(held, "hash").withColumn("live", live)
            .where((F.col("kind_no") < len(BASE)) | F.col("live"))
            .groupBy("row").agg(F.array_sort(F.collect_list(  # one document's spans
                F.struct("start", "kind_no", "end", "live", "owners", "repositories"))).alias("spans")))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """One row a document: doc_id, spans (array of start, kind_no, end, live,
    owners, repositories), n_<base kind>, base_sha256, n_live, n_example."""
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(owner).alias("owner"),
                        candidates(F.coalesce(F.col(text), F.lit(""))).alias("found"))
    rows = stored(found.withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    out = rows.select("row", "doc_id").join(_judged(rows), "row", "left").withColumn(
        "spans", F.coalesce("spans", F.array()))
    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE))

    def count(test):
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(number):
        return lambda s: s["kind_no"] == number

    return out.select(
        "doc_id", *[count(of_kind(i)).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans_text"), "spans",
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_example"))


def mask(docs: DataFrame, text: str = "text", owner: str = "source", tag: str = "[secret]") -> DataFrame:
    """``docs`` with live-looking spans replaced by ``tag``; widely copied
    examples stay.  Only documents with candidates are shuffled."""
    found = candidates(F.coalesce(F.col(text), F.lit("")))
    hit = F.lit(False)
    for pattern, *_ in KINDS.values():
        hit = hit | F.coalesce(F.col(text).rlike(pattern), F.lit(False))
    with_hits = stored(docs.where(hit).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(owner).alias("owner"),
        found.alias("found"), F.monotonically_increasing_id().alias("row")), "secret-documents")
    judged = _judged(with_hits).select("row", F.filter("spans", lambda s: s["live"]).alias("live"))
    body = F.struct(F.encode(F.col(f"doc.`{text}`"), "UTF-32").alias("wide"), F.col("live"))

    def masked_text(x):  # four bytes a character, so that a place is found at once
        part = lambda a, n: F.decode(F.substring(x["wide"], 4 * a + 1, 4 * n), "UTF-32")
        done = _running(F.transform(x["live"], lambda s: s["end"]), 0, lambda a, b: F.greatest(a, b))
        apart = F.filter(F.zip_with(x["live"], done, lambda s, d: F.struct(s["start"].alias("start"), d.alias("done"))),
                         lambda s: s["start"] >= s["done"])     # what earlier spans cover is gone
        pieces = F.transform(apart, lambda s: part(s["done"], s["start"] - s["done"]))
        tail = part(F.array_max(F.transform(x["live"], lambda s: s["end"])), F.length(x["wide"]))
        return F.array_join(F.concat(pieces, F.array(tail)), tag)

    whole = _let(body, masked_text)
    masked = with_hits.join(judged, "row", "left").select(
        F.when(F.size("live") > 0, F.col("doc").withField(f"`{text}`", whole)).otherwise(F.col("doc")).alias("doc"))
    masked = masked.select("doc.*")
    return docs.where(~hit).unionByName(masked)
