"""Quality rules by tokeniser fertility.

Method: public vocabularies measure every whole text: characters per token,
share of tokens that only spell bytes of a character, and entropy of the
text's token ids.  Each measure must lie in its *band*: the centre and spread
(median, inter-quartile range) of the texts of the same language (script,
where the language is unknown) and length class, widened by ``WIDTH``.  Bands
come from counts over the whole corpus on a fixed grid, so they are the same
however the rows are split; texts with equal figures count once, so a large
group of copies doesn't set them.  Two base rules come first: too few words,
or too many words in repeated three-word windows.

Defined cases: a null text has no words (base rules reject it); a null
language uses the text's script; groups with fewer than ``MIN_TEXTS``
different texts take the band of the first wider group that has as many (see
``_pools``), at last that of all texts; repeated rows get equal
verdicts.  Columns besides the named ones are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm import pieces as P
from kestrel.llm.sentencepieces import encoder
from kestrel.llm.tables import stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
WIDTH = 4.0           # spreads allowed on either side of the median
MIN_TEXTS = 30        # different texts that a group's own band needs
#: Measure -> (grid step of its counts, least spread, sides that reject).
MEASURES = {
    "chars_per_token": (0.005, 0.06, "both"),
    "fallback_share": (0.001, 0.01, "high"),
    "entropy": (0.01, 0.20, "both"),
}
#: First code points of blocks whose letters tell a script (fixed values of Unicode).
SCRIPTS = ((0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"),
           (0x600, "arabic"), (0x900, "indic"), (0xE00, "thai"), (0x1100, "hangul"), (0x1200, "other"),
           (0x1E00, "latin"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"),
           (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"))

CELL = ["grp", "script", "size_class"]
LAST_POOL = 5         # all texts

BASE = ("doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long")


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def dup_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += bool(line.split())
        seen.add(line)
    return n


def script_of(text: bytes) -> str:
    """Script of most letters of the whole text."""
    s = text.decode("utf-8", "replace")
    if s.isascii():
        return "latin"
    code = np.frombuffer(s.encode("utf-32-le", "replace"), dtype="<u4")
    block = np.searchsorted([c for c, _ in SCRIPTS], code, side="right") - 1
    names = Counter()
    letters = block[(code >= 0x41) & ~((code > 0x7A) & (code < 0xC0))]
    for b, n in enumerate(np.bincount(letters, minlength=1).tolist()):
        names[SCRIPTS[b][1]] += n
    return max(sorted(names), key=names.get) if any(names.values()) else "other"


def _fertility(vocabulary: str):
    """texts -> (tokens, chars per token, fallback share, entropy) arrays."""
    if vocabulary.endswith(".model"):
        enc = encoder(vocabulary)
        lonely = enc.is_byte

        def ids(texts):
            flat, per, _ = enc.ids(texts)
            return flat, per
    else:
        memo = P.byte_bpe(vocabulary)
        lonely = P.byte_bpe_partial(vocabulary)

        def ids(texts):
            flat, per, *_ = memo.encode(texts)
            return flat, per

    def measure(texts: list[bytes], chars: np.ndarray):
        flat, per = ids(texts)
        n = np.maximum(per, 1)
        row = np.repeat(np.arange(len(texts)), per)
        key, times = np.unique((row << 32) | flat, return_counts=True)
        share = times / n[key >> 32]
        # sums over no token at all come out as whole numbers
        entropy = np.bincount(key >> 32, weights=-share * np.log2(share), minlength=len(texts)).astype(np.float64)
        alone = np.bincount(row, weights=lonely[flat], minlength=len(texts)) / n
        return per, chars / n, alone, entropy

    return measure


def measure(docs: DataFrame, vocabularies: list[str], doc_id: str = "doc_id", text: str = "text",
            lang: str = "lang") -> DataFrame:
    """One row a document: ``BASE`` columns, and for each vocabulary i the
    columns ``n_tokens_i`` and ``<measure>_i``."""
    extra = "".join(f", n_tokens_{i} long" + "".join(f", {m}_{i} double" for m in MEASURES)
                    for i in range(len(vocabularies)))
    schema = BASE + extra
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        import pyarrow as pa
        fertility = [_fertility(v) for v in vocabularies]
        blank = np.zeros(256, dtype=bool)
        blank[[9, 10, 11, 12, 13, 32]] = True
        symbol = np.zeros(256, dtype=bool)
        symbol[list(SYMBOLS)] = True
        for batch in batches:
            for first, texts in P.text_batches(batch.column(1), 1 << 20):
                out = {n: [] for n in names[2:8]}
                chars = []
                for t in texts:
                    words = t.split()
                    raw = np.frombuffer(t, dtype=np.uint8)
                    chars.append(int(np.count_nonzero((raw & 0xC0) != 0x80)))
                    for n, v in zip(out, (script_of(t), len(words), chars[-1] - int(np.count_nonzero(blank[raw])),
                                          int(np.count_nonzero(symbol[raw])), dup_lines(t), repeat_words(words))):
                        out[n].append(v)
                cols = [batch.column(0).slice(first, len(texts)), batch.column(2).slice(first, len(texts)),
                        *(pa.array(v) for v in out.values())]
                for f in fertility:
                    per, *ms = f(texts, np.array(chars))
                    cols += [pa.array(per.astype(np.int64)), *(pa.array(np.round(m, 6)) for m in ms)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"), F.col(lang).cast("string")
                       ).mapInArrow(run, schema)


def bands(measured: DataFrame, vocabularies: int, width: float = WIDTH) -> DataFrame:
    """(grp, script, size_class, measure, low, high) from grid counts over all
    texts.  A group has at most as many grid rows as its measure has steps."""
    names = [f"{m}_{i}" for i in range(vocabularies) for m in MEASURES]
    different = measured.where("n_tokens_0 > 0").select(
        _group(), "script", _size_class(), "n_words", "word_chars", *names).distinct()
    steps = {f"{m}_{i}": s for i in range(vocabularies) for m, (s, *_) in MEASURES.items()}
    long = different.select(*CELL, F.explode(F.array(*[
        F.struct(F.lit(n).alias("measure"), F.round(F.col(n) / F.lit(steps[n])).cast("long").alias("step"))
        for n in names])).alias("m")).select(*CELL, "m.*")
    grid = stored(long.groupBy(*CELL, "measure", "step").agg(F.count(F.lit(1)).alias("n")), "fertility-grid")
    pooled = (grid.select(F.explode(_pools(1)).alias("pool"), "measure", "step", "n")
              .groupBy("pool", "measure", "step").agg(F.sum("n").alias("n")))
    own = Window.partitionBy("pool", "measure")
    cum = pooled.withColumn("upto", F.sum("n").over(own.orderBy("step"))).withColumn("all", F.sum("n").over(own))
    at = {q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("step"))) for q in (0.25, 0.5, 0.75)}
    out = cum.groupBy("pool", "measure").agg(
        *[v.alias(f"q{int(100 * q)}") for q, v in at.items()], F.first("all").alias("texts"))
    step, least, high_only = F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(False)
    for n in names:
        s, floor, sides = MEASURES[n.rpartition("_")[0]]
        here = F.col("measure") == n
        step, least = F.when(here, s).otherwise(step), F.when(here, floor).otherwise(least)
        high_only = F.when(here, sides == "high").otherwise(high_only)
    # a normal spread is its inter-quartile range over 1.349
    spread = F.greatest((F.col("q75") - F.col("q25")) * step / 1.349, least)
    middle = F.col("q50") * step
    out = out.where((F.col("texts") >= MIN_TEXTS) | (F.col("pool.level") == LAST_POOL)).select(
        "pool", "measure", F.when(high_only, F.lit(float("-inf"))).otherwise(middle - width * spread).alias("low"),
        (middle + width * spread).alias("high"))
    cells = grid.select(*CELL).distinct().select(*CELL, F.explode(_pools(0)).alias("pool"))
    return cells.join(out, "pool").groupBy(*CELL, "measure").agg(
        F.min(F.struct("pool.level", "low", "high")).alias("b")).select(*CELL, "measure", "b.low", "b.high")


def _pools(around: int):
    """The pools (level, of, size) that a cell takes its band from, first its
    own group; with ``around`` 1 those whose counts it is part of (the pools of
    neighbouring length classes too)."""
    def pool(level, of, size):
        return F.struct(F.lit(level).alias("level"), of.alias("of"), size.cast("int").alias("size"))

    grp, script, size, every = F.col("grp"), F.col("script"), F.col("size_class"), F.lit(-1)
    near = [size + d for d in range(-around, around + 1)]
    return F.array(pool(0, grp, size), *[pool(1, grp, s) for s in near], pool(2, grp, every),
                   *[pool(3, script, s) for s in near], pool(4, script, every), pool(LAST_POOL, F.lit(""), every))


def _group():
    return F.coalesce(F.col("lang"), F.concat(F.lit("script:"), F.col("script"))).alias("grp")


def _size_class():
    return F.floor(F.log2(F.greatest(F.col("n_tokens_0"), F.lit(1)))).cast("int").alias("size_class")


def verdicts(measured: DataFrame, band: DataFrame, vocabularies: int) -> DataFrame:
    """``measured`` with base_failed, n_outside (measures outside their band)
    and kept."""
    names = [f"{m}_{i}" for i in range(vocabularies) for m in MEASURES]
    wide = band.groupBy(*CELL).agg(*[
        F.max(F.when(F.col("measure") == n, F.col(side))).alias(f"{n}_{side}")
        for n in names for side in ("low", "high")])
    base_failed = ((F.col("n_words") < MIN_WORDS)
                   | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    outside = sum(F.coalesce(((F.col(n) < F.col(f"{n}_low")) | (F.col(n) > F.col(f"{n}_high"))).cast("int"),
                             F.lit(0)) for n in names)
    out = (measured.withColumns({"grp": _group(), "size_class": _size_class()})
           .join(wide, CELL, "left")
           .withColumns({"base_failed": base_failed, "n_outside": outside}))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("n_outside") == 0)).select(
        *measured.columns, "base_failed", "n_outside", "kept")


def rate(docs: DataFrame, vocabularies: list[str], **columns) -> DataFrame:
    """Measures and verdict of every document."""
    measured = stored(measure(docs, vocabularies, **columns), "fertility")
    return verdicts(measured, bands(measured, len(vocabularies)), len(vocabularies))
