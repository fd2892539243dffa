"""Line dedup by a segment-partition edit join.

Method: two lines are linked if equal, or if both have ``near_chars``
characters and at most ``threshold`` edits turn one into the other, or if both
have ``one_edit_chars`` and one edit does.  Each
distinct line is cut into threshold + 1 segments; by the pigeonhole principle
one of them stays whole in any line within the threshold.  Lines probe the
segments of lines as long or up to ``threshold`` shorter with the substrings
at the places that the edits on either side can shift a segment to.  What
shares a segment is verified with a bit-parallel automaton over the band of
2 * threshold + 1 diagonals.  Linked lines form classes; only a class's first
line (smallest doc_id, then line number) stays.  DataFrame functions only.

Lines shorter than ``min_chars`` always stay, and so do marks: lines without
a letter or digit that are shorter than ``MARK_CHARS``.

Defined cases: a null text stays null and has no lines; rows with the same
doc_id and text (repeated rows) count as one document, whose first lines stay
in all its rows; other rows are documents of their own, also under one doc_id
(then in the order of their texts' hashes) and without a doc_id (these come
after all others, in the order of their stored row numbers); a document that loses all its
lines keeps the empty text.  Columns besides the two named are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.components import components
from kestrel.llm.tables import stored

THRESHOLD = 2
MIN_CHARS = 1
MARK_CHARS = 24
NEAR_CHARS = 64
ONE_EDIT_CHARS = 24
LAST_ID = (1 << 63) - 1
LETTERS = " eaniotrsh"     # counted before two lines are compared


# -- verification ---------------------------------------------------------------

def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _shared(a: Column, b: Column) -> Column:
    """Characters that two texts share at their start, by halving steps from
    the highest power of two in the shorter length."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])

    def count(limit):
        bits = F.length(F.bin(limit))
        return F.aggregate(F.slice(steps, F.lit(32) - bits, bits), F.lit(0), lambda n, s: F.when(
            (n + s <= limit) & (F.substring(a, n + 1, s) == F.substring(b, n + 1, s)), n + s).otherwise(n))

    return _let(F.least(F.length(a), F.length(b)), count)


def _rests(a: Column, b: Column, then) -> Column:
    """``then`` of a struct (x, y): what differs once the shared start and end
    are cut off, read backwards."""
    def cut(text, n):
        return F.substring(text, n + 1, F.length(text))

    return _let(_shared(a, b), lambda head: _let(
        F.struct(F.reverse(cut(a, head)).alias("x"), F.reverse(cut(b, head)).alias("y")), lambda p: _let(
            _shared(p["x"], p["y"]), lambda tail: _let(
                F.struct(cut(p["x"], tail).alias("x"), cut(p["y"], tail).alias("y")), then))))


def plausible(a: Column, b: Column, threshold: int) -> Column:
    """False only if more than ``threshold`` edits lie between two texts; cheap
    enough for a join's condition.  What is left after the shared ends are cut
    off begins and ends with an edit, so of a longer rest everything else must
    agree when there are but two."""
    def test(p):
        x, y = p["x"], p["y"]
        m, n = F.length(x), F.length(y)
        ok = F.greatest(m, n) <= threshold
        if threshold == 2:
            edit = ((1, 1), (0, 1), (1, 0))  # characters of x and y that one edit takes
            for first in edit:
                for last in edit:
                    u, v = first[0] + last[0], first[1] + last[1]
                    ok = ok | ((m >= u) & (m - u == n - v) & (F.substring(x, F.lit(1 + first[0]), m - u)
                                                              == F.substring(y, F.lit(1 + first[1]), n - v)))
        return ok if threshold <= 2 else F.lit(True)

    return (F.abs(F.length(a) - F.length(b)) <= threshold) & _rests(a, b, test)


def _automaton(xs: str, ys: str, threshold: int) -> Column:
    """The diagonals on which at most ``threshold`` edits lead from the
    characters ``xs`` to ``ys``.  Bit d of row e says: on diagonal
    d - threshold, so far with at most e edits.  One character of ``ys`` is a
    step; ``eq`` holds the diagonals whose next character of ``xs`` equals it."""
    band = (1 << (2 * threshold + 1)) - 1
    start = [1 << threshold]
    for _ in range(threshold):
        start.append((start[-1] | start[-1] << 1) & band)

    def step(acc, j):
        y = F.get(F.col(ys), j)
        eq = F.lit(0)
        for d in range(2 * threshold + 1):
            same = F.coalesce(F.get(F.col(xs), j + (d - threshold)) == y, F.lit(False))
            eq = eq.bitwiseOR(F.when(same, 1 << d).otherwise(0))
        rows = [acc["r0"].bitwiseAND(eq)]
        for e in range(1, threshold + 1):
            old = acc[f"r{e - 1}"]  # replaced, inserted, or (from the new row) left out
            rows.append(acc[f"r{e}"].bitwiseAND(eq).bitwiseOR(old).bitwiseOR(F.shiftright(old, 1)).bitwiseOR(
                F.shiftleft(rows[-1], 1).bitwiseAND(F.lit(band))))
        return F.struct(*[r.alias(f"r{e}") for e, r in enumerate(rows)])

    first = F.struct(*[F.lit(v).alias(f"r{e}") for e, v in enumerate(start)])
    places = F.transform(F.col(ys), lambda y, j: j)
    return F.aggregate(places, first, step)[f"r{threshold}"]


def verified(pairs: DataFrame, threshold: int, a: str = "line_a", b: str = "line_b") -> DataFrame:
    """The pairs whose texts ``a`` and ``b`` are within ``threshold`` edits."""
    return banded(pairs.where(plausible(F.col(a), F.col(b), threshold)), threshold, a, b)


def banded(pairs: DataFrame, threshold: int, a: str = "line_a", b: str = "line_b") -> DataFrame:
    """As ``verified``, of pairs that are ``plausible``: a second test above a
    join would be put before the join's other conditions and so meet all its
    pairs.  What the texts share at their ends is cut off first (that changes
    no distance); the rest goes through the banded automaton."""
    # split gives one empty string for an empty text
    chars = lambda t: F.filter(F.split(t, ""), lambda ch: ch != "")
    p = pairs.withColumn("_r", _rests(
        F.col(a), F.col(b), lambda r: F.struct(chars(r["x"]).alias("x"), chars(r["y"]).alias("y"))))
    # written, so that the optimizer doesn't put these expressions into the
    # automaton's steps
    p = stored(p.withColumns({"_x": F.col("_r.x"), "_y": F.col("_r.y")}).drop("_r", a, b), "line-pairs")
    few = F.greatest(F.size("_x"), F.size("_y")) <= threshold
    bit = F.get(F.array(*[F.lit(1 << d) for d in range(2 * threshold + 1)]), F.size("_x") - F.size("_y") + threshold)
    return p.where(F.when(few, True).otherwise(_automaton("_x", "_y", threshold).bitwiseAND(bit) != 0)
                   ).drop("_x", "_y")


# -- candidates -------------------------------------------------------------------

def segment_keys(lines: DataFrame, threshold: int) -> DataFrame:
    """(id, key, own): the hashes of every substring with which a line can
    meet a segment of a line as long or up to ``threshold`` shorter; ``own``
    marks the line's own segments (its entries in the index)."""
    parts = threshold + 1
    # (segment, how much shorter the indexed line is, shift): edits before a
    # segment shift it by at most its number, edits after it by at most the
    # rest of the threshold against the end
    places = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(short).alias("short"), F.lit(shift).alias("shift"))
        for short in range(threshold + 1) for i in range(parts)
        for shift in range(max(-i, short - (threshold - i)), min(i, short + threshold - i) + 1)])
    # four bytes a character, so that a place in the line is found at once; one
    # row a place, so that the key is one compiled expression
    wide = lines.select("id", F.encode("line", "UTF-32").alias("wide"), F.length("line").alias("chars"))
    each = wide.select("id", "wide", "chars", F.explode(places).alias("p")).select("id", "wide", "chars", "p.*")
    size = F.col("chars") - F.col("short")   # length of the indexed line
    longer = size % parts                    # so many last segments have one more
    least = ((size - longer) / parts).cast("int")
    first_longer = F.lit(parts) - longer
    width = least + (F.col("i") >= first_longer).cast("int")
    begin = least * F.col("i") + F.greatest(F.col("i") - first_longer, F.lit(0)) + F.col("shift")
    return each.select("id", F.xxhash64("i", size, F.substring("wide", 4 * begin + 1, 4 * width)).alias("key"),
                       ((F.col("short") == 0) & (F.col("shift") == 0)).alias("own"))


def letters(line: Column) -> Column:
    """How often each of a few common characters stands in a line."""
    return F.struct(*[(F.length(line) - F.length(F.replace(line, F.lit(c)))).alias(f"n{i}")
                      for i, c in enumerate(LETTERS)])


def letters_near(a: Column, b: Column, threshold: int) -> Column:
    """False only if more than ``threshold`` edits lie between two lines (an
    edit changes at most two of the counts, by one each); a few instructions,
    for the many pairs of a bucket whose test by characters can be spared."""
    return sum((F.abs(a[f"n{i}"] - b[f"n{i}"]) for i in range(len(LETTERS))), F.lit(0)) <= 2 * threshold


def line_links(distinct: DataFrame, threshold: int, near_chars: int, most_chars: int | None = None) -> DataFrame:
    """Links (a, b) between ids of ``distinct`` (id, line), with the classes
    that all links within the threshold give, of lines with ``near_chars`` to
    ``most_chars`` characters.

    Every line is first verified against the first indexed line of its
    bucket; only lines that this leaves apart meet the others of the bucket,
    and only those of other classes.  No group's pairs are listed."""
    long_lines = distinct.where(F.length("line") >= near_chars)
    if most_chars is not None:
        long_lines = long_lines.where(F.length("line") <= most_chars)
    # the keys move once: buckets are counted and joined where they lie, most go there
    rows = segment_keys(long_lines, threshold).repartition("key")
    heads = rows.groupBy("key").agg(F.min(F.when(F.col("own"), F.col("id"))).alias("first"),
                                    F.min("id").alias("lo"), F.max("id").alias("hi"))
    heads = heads.where("first IS NOT NULL AND lo < hi").select("key", "first")
    shared = stored(rows.join(heads.hint("shuffle_hash"), "key").distinct(), "line-buckets")
    # few lines are in a bucket: only these are joined to pairs
    met = stored(long_lines.join(shared.select("id").distinct().hint("shuffle_hash"), "id", "left_semi"), "line-texts")

    def texts(pairs: DataFrame) -> DataFrame:
        return (pairs.join(met.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
                .join(met.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b"))

    pairs = shared.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    star = stored(verified(texts(pairs), threshold).select("a", "b"), "line-star")
    label = stored(components(star), "line-star-labels")
    linked = star.select(F.col("a").alias("first"), F.col("b").alias("id"), F.lit(True).alias("linked"))
    marked = shared.join(linked, ["first", "id"], "left").join(label, "id", "left").select(
        "key", "id", "own", (F.coalesce("linked", F.lit(False)) | (F.col("id") == F.col("first"))).alias("linked"),
        F.coalesce("component", "id").alias("component"))
    several = marked.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    opened = stored(marked.join(several.select("key"), "key", "left_semi")
                    .join(met.withColumn("letters", letters(F.col("line"))), "id"), "line-open-buckets")
    # of two lines that are both apart from the first, one meets the other
    a, b = opened.where("NOT linked").alias("a"), opened.alias("b")
    rest = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component"))
                  & (F.col("a.own") | F.col("b.own")) & (F.col("b.linked") | (F.col("a.id") < F.col("b.id")))
                  & letters_near(F.col("a.letters"), F.col("b.letters"), threshold)
                  & plausible(F.col("a.line"), F.col("b.line"), threshold))
    rest = rest.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.line").alias("line_a"),
                       F.col("b.line").alias("line_b"))
    return star.union(banded(rest, threshold).select("a", "b").distinct())


# -- the operator -------------------------------------------------------------------

def counts(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """Whether a line is one of those that go when repeated."""
    return (F.length(line) >= min_chars) & ((F.length(line) >= MARK_CHARS) | line.rlike(r"[\p{L}\p{N}]"))


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, part, whole): every row as a struct ``whole`` with the name of its
    document: the doc_id and the text's hash, or the largest long and a stored
    row number for a null doc_id."""
    named = F.col(f"`{doc_id}`").cast("long")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    unnamed = docs.where(named.isNull()).select(
        F.lit(LAST_ID).alias("doc"), F.monotonically_increasing_id().alias("part"), whole)
    return docs.where(named.isNotNull()).select(
        named.alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("part"), whole).union(stored(unnamed, "line-unnamed"))


def removals(rows: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS,
             one_edit_chars: int | None = None, text: str = "text") -> DataFrame:
    """(doc, part, removed): the lines that go, per document of ``keyed`` rows,
    as an array of (line_no, first_doc, first_line), line numbers from 0."""
    lines = rows.select("doc", "part", F.posexplode(F.split(F.col(f"whole.`{text}`"), "\n")).alias("line_no", "line")).where(
        counts(F.col("line"), min_chars))
    counted = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    distinct = stored(counted.withColumn("id", F.monotonically_increasing_id()), "distinct-lines")
    links = line_links(distinct.select("id", "line"), threshold, near_chars)
    if one_edit_chars is not None:  # a line of near_chars may be one edit from a shorter one
        links = links.union(line_links(distinct.select("id", "line"), 1, one_edit_chars, near_chars))
    classes = stored(components(links).withColumnRenamed("component", "class"), "line-classes")
    # 128 bits name a line from here on; no text moves with the joins
    name = [F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2")]
    repeated = (distinct.select("id", "n", *name).join(classes.hint("shuffle_hash"), "id", "left")
                .where("class IS NOT NULL OR n > 1").select("h1", "h2", F.coalesce("class", "id").alias("class")))
    seen = stored(lines.select("doc", "part", "line_no", *name).join(repeated.hint("shuffle_hash"), ["h1", "h2"])
                  .drop("h1", "h2"), "line-places")
    first = seen.groupBy("class").agg(F.min(F.struct("doc", "part", "line_no")).alias("first"))
    gone = (seen.join(first, "class").where(F.struct("doc", "part", "line_no") != F.col("first")).distinct()
            .select("doc", "part", F.struct("line_no", F.col("first.doc").alias("first_doc"),
                                    F.col("first.line_no").alias("first_line")).alias("line")))
    return gone.groupBy("doc", "part").agg(F.array_sort(F.collect_list("line")).alias("removed"))  # one document's lines


def drop_repeated(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS,
                  near_chars: int = NEAR_CHARS, one_edit_chars: int | None = None, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """One row a document: ``doc`` (a struct of all its columns, the text
    without the repeated lines), ``removed`` (array of line_no, first_doc,
    first_line) and ``chars_before`` (characters of the whole text)."""
    rows = keyed(docs, doc_id, text)
    gone = stored(removals(rows, threshold, min_chars, near_chars, one_edit_chars, text), "line-removals")
    joined = rows.join(gone, ["doc", "part"], "left").select(F.col("whole").alias("doc"), "removed")
    body = F.col(f"doc.`{text}`")
    numbers = F.transform("removed", lambda r: r["line_no"])
    kept = F.array_join(F.filter(F.split(body, "\n"), lambda line, i: ~F.array_contains(numbers, i)), "\n")
    return joined.select(
        F.when(F.col("removed").isNull(), F.col("doc")).otherwise(F.col("doc").withField(f"`{text}`", kept)).alias("doc"),
        F.coalesce("removed", F.array()).alias("removed"), F.length(body).alias("chars_before"))
